"""From extractor answers and forms to rows of the property table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloyframe.functions.json import envelope_text, parsed, sound
from alloyframe.functions.text import abbreviation, or_default
from alloyframe.operators.figures import match_captions
from alloyframe.schema import TAXONOMY, taxonomy
from alloyframe.sources.sinks import append_uploads, image_link, write_binaries

CLASSES = tuple(TAXONOMY)


def parse_answers(answers: DataFrame) -> DataFrame:
    """(doc_id, doc) from (doc_id, answer): the document in a model's answer, null where there is none."""
    # a projection for each step, which the optimizer leaves apart, so that no text is parsed twice
    texts = answers.select("doc_id", envelope_text(F.col("answer")).alias("text"))
    return texts.select("doc_id", parsed(F.col("text")).alias("parsed")).select("doc_id", sound(F.col("parsed")).alias("doc"))


def _properties(docs: DataFrame) -> DataFrame:
    """A row for each property: doc_id, doc, _ord, p.

    The outer form keeps a filter on the array's size, which would parse each document once more, from being put below.
    """
    return docs.select("doc_id", "doc", F.posexplode_outer("doc.mechanical_properties").alias("_ord", "p")).where("_ord is not null")


def extract_rows(docs: DataFrame) -> DataFrame:
    """A row for each property of (doc_id, doc); what is missing or empty gets its default. No properties: no rows."""
    items = _properties(docs)
    name = or_default(F.col("doc.material_name"), "")
    return items.select(
        "doc_id", F.col("_ord").cast("long").alias("_ord"), name.alias("material_name"),
        F.coalesce(F.nullif(F.col("doc.material_abbreviation"), F.lit("")), abbreviation(name)).alias("material_abbreviation"),
        or_default(F.col("doc.trade_grade"), "").alias("trade_grade"), or_default(F.col("doc.manufacturer"), "").alias("manufacturer"),
        or_default(F.col("p.section"), "Mechanical").alias("section"), or_default(F.col("p.property_name"), "Unknown property").alias("property_name"), or_default(F.col("p.value"), "N/A").alias("value"),
        *[or_default(F.col(f"p.{c}"), "").alias(c) for c in ("unit", "english", "test_condition", "comments")],
    )


def extract_rows_plain(docs: DataFrame) -> DataFrame:
    """The older form: no defaults, and neither grade nor manufacturer."""
    items = _properties(docs)
    return items.select("doc_id", F.col("_ord").cast("long").alias("_ord"), "doc.material_name", "doc.material_abbreviation", "p.section", "p.property_name", "p.value", "p.unit", "p.english", "p.test_condition", "p.comments")


def classify_rows(rows: DataFrame, material_class: str, material_type: str | None = None) -> DataFrame:
    """Rows with the class that the user chose; other names than those of the taxonomy are refused."""
    if material_class not in CLASSES:
        raise ValueError(f"choose one of {', '.join(CLASSES)}")
    return rows.withColumns({"material_class": F.lit(material_class), "material_type": F.lit(material_type or material_class)})


def split_form(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Form rows to keep, and those to send back with a reason.

    A name and a value are asked for, and class, section and property must stand in the taxonomy. An empty
    abbreviation is made from the name.
    """
    known = F.broadcast(taxonomy(rows.sparkSession).select("material_class", "section", "property_name", F.lit(True).alias("_known")))
    judged = rows.join(known, ["material_class", "section", "property_name"], "left")
    filled = lambda c: F.length(F.coalesce(F.trim(F.col(c)), F.lit(""))) > 0
    reason = F.when(~filled("material_name"), "material_name is empty").when(~filled("value"), "value is empty").when(F.col("_known").isNull(), "not in the taxonomy")
    judged = judged.withColumn("reason", reason).drop("_known")
    good = judged.where("reason is null").drop("reason")
    return good.withColumn("material_abbreviation", F.coalesce(F.nullif(F.col("material_abbreviation"), F.lit("")), abbreviation(F.col("material_name")))), judged.where("reason is not null")


def submit_form(rows: DataFrame, store: str) -> tuple[int, DataFrame]:
    """Append the form rows that pass to the upload store; their number, and the others with the reason."""
    good, bad = split_form(rows)
    good = good.persist()
    try:
        n = good.count()
        if n:
            append_uploads(good, store, "form")
    finally:
        good.unpersist()
    return n, bad


def save_matched_images(rows: DataFrame, figures: DataFrame, folder: str) -> DataFrame:
    """Links (doc_id, material_abbreviation, property_name, caption, image_path) of the images that were written.

    Each figure in order takes the first property left that its caption fits, and its first image is saved under the
    abbreviation of the document's first row and that property. rows: doc_id, _ord, material_abbreviation,
    property_name; figures: doc_id, ord, caption, image_data.
    """
    matched = match_captions(figures, rows.select("doc_id", F.col("_ord").alias("ord"), "property_name"))
    abbreviation_of = rows.groupBy("doc_id").agg(F.min_by("material_abbreviation", "_ord").alias("material_abbreviation"))
    images = figures.where(F.size("image_data") > 0).groupBy("doc_id", "caption").agg(F.min_by(F.get("image_data", F.lit(0)), "ord").alias("image"))
    named = matched.join(images, ["doc_id", "caption"]).join(abbreviation_of, "doc_id").withColumn("image_path", image_link(F.col("material_abbreviation"), F.col("property_name")))
    # two documents may speak of the same material and property: the later one's image would replace the other
    last = named.groupBy("image_path").agg(F.max_by(F.struct("doc_id", "material_abbreviation", "property_name", "caption", F.col("image.bytes").alias("bytes")), "doc_id").alias("l")).select("image_path", "l.*")
    files = last.select(F.substring_index("image_path", "/", -1).alias("filename"), "bytes")
    written = write_binaries(files, folder)
    return last.drop("bytes").join(written.select(F.concat(F.lit("images/"), "filename").alias("image_path")), "image_path").select("doc_id", "material_abbreviation", "property_name", "caption", "image_path")


def ingest(rows: DataFrame, material_class: str, store: str, figures: DataFrame | None = None, folder: str | None = None) -> DataFrame | None:
    """Extracted rows into the upload store under the class that the user chose, their figures' images first.

    The class is checked before anything is written. Returns the links of the images, if figures were given.
    """
    classed = classify_rows(rows, material_class)
    links = None
    if figures is not None:
        links = save_matched_images(classed, figures, folder).persist()
        links.count()
    append_uploads(classed, store, "pdf")
    return links


def categories(rows: DataFrame, material_class: str) -> DataFrame:
    """The categories of a class in the order of the form; rows is any frame of the session."""
    own = taxonomy(rows.sparkSession).where(F.col("material_class") == material_class)
    return own.groupBy("section").agg(F.min("ord").alias("ord")).orderBy("ord")


def property_names(rows: DataFrame, material_class: str, section: str) -> DataFrame:
    return taxonomy(rows.sparkSession).where((F.col("material_class") == material_class) & (F.col("section") == section)).select("property_name", "ord").orderBy("ord")


def latest_links(links: DataFrame, changes: DataFrame) -> DataFrame:
    """Links (image_id, property_name, at) after changes: of each image the latest holds; a property may have many."""
    both = links.unionByName(changes)
    return both.groupBy("image_id").agg(F.max_by(F.struct("property_name", "at"), "at").alias("l")).select("image_id", "l.property_name", "l.at")


def without_removed(figures: DataFrame, removed: DataFrame) -> DataFrame:
    """Figures without the removed (doc_id, caption, filename) images; a null filename removes the whole figure.

    A figure whose images are all gone goes too.
    """
    whole = removed.where("filename is null").select("doc_id", "caption")
    single = removed.where("filename is not null").groupBy("doc_id", "caption").agg(F.collect_set("filename").alias("_gone"))
    left = figures.join(whole, ["doc_id", "caption"], "left_anti").join(single, ["doc_id", "caption"], "left")
    images = F.filter("image_data", lambda i: ~F.array_contains(F.coalesce(F.col("_gone"), F.array().cast("array<string>")), i["filename"]))
    return left.withColumn("image_data", images).where(F.size("image_data") > 0).drop("_gone").select(figures.columns)
