"""Reconciling a template of properties with the tables of materials."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from alloyframe.functions.text import strip
from alloyframe.functions.vectors import cosine
from alloyframe.plugins import Vectorizer, Verifier
from alloyframe.sources.extractors import embed
from alloyframe.sources.tables import template_columns

#: Template rows that are broadcast at most; a longer template is dealt over the partitions.
MOST_TEMPLATE_ROWS = 100_000
OUTPUT = ("Matched Property", "Value", "Unit", "English", "Comments")
MOST_CANDIDATES = 5


def _small(template: DataFrame) -> DataFrame:
    return F.broadcast(template) if template.count() <= MOST_TEMPLATE_ROWS else template


def template_rows(template: DataFrame) -> DataFrame:
    """(tpl_row, tpl_section, tpl_property) of a template with `_ord`; without a section column it is null."""
    section, prop = template_columns([c for c in template.columns if c != "_ord"])
    return template.select(F.col("_ord").alias("tpl_row"), (F.col(section).cast("string") if section else F.lit(None).cast("string")).alias("tpl_section"), F.col(prop).cast("string").alias("tpl_property"))


def for_every_table(template: DataFrame, materials: DataFrame) -> DataFrame:
    """The template's rows for every material table; a template is a sheet, and the names are a list of tables."""
    return materials.select("material_table").distinct().crossJoin(_small(template))


def exact_matches(wanted: DataFrame, materials: DataFrame) -> DataFrame:
    """Rows (material_table, tpl_row, ..., found) with the first property of the same section and name, else null.

    Letters' case does not count. The template's side is stripped, the table's is not; a null section of a table
    never matches, and a template without a section takes any.
    """
    key = lambda c: F.lower(strip(F.col(c)))
    firsts = materials.groupBy("material_table", F.lower("section").alias("_s"), F.lower("property_name").alias("_p")).agg(
        F.min_by(F.struct("property_name", "value", "unit", "english", "comments", "_ord"), "_ord").alias("found")
    )
    with_section = wanted.where("tpl_section is not null").withColumns({"_s": key("tpl_section"), "_p": key("tpl_property")})
    without = wanted.where("tpl_section is null").withColumn("_p", key("tpl_property"))
    anywhere = firsts.groupBy("material_table", "_p").agg(F.min_by("found", "found._ord").alias("found"))
    return with_section.join(firsts, ["material_table", "_s", "_p"], "left").drop("_s", "_p").unionByName(without.join(anywhere, ["material_table", "_p"], "left").drop("_p"))


def nearest_names(wanted: DataFrame, materials: DataFrame, vectorizer: Vectorizer, most: int = MOST_CANDIDATES) -> DataFrame:
    """(material_table, tpl_row, tpl_property, rank, found) of the most similar names of the same section.

    Every distinct name is embedded once.
    """
    names = wanted.select(F.col("tpl_property").alias("name")).unionAll(materials.select("property_name")).distinct()
    vectors = names.withColumn("vector", embed(F.col("name"), vectorizer))
    left = wanted.withColumn("_s", F.lower(strip(F.col("tpl_section")))).join(vectors.withColumnsRenamed({"name": "tpl_property", "vector": "_a"}), "tpl_property")
    right = materials.select("material_table", F.lower("section").alias("_t"), F.struct("property_name", "value", "unit", "english", "comments", "_ord").alias("found"), F.col("property_name").alias("_name"))
    right = right.join(vectors.withColumnsRenamed({"name": "_name", "vector": "_b"}), "_name").drop("_name")
    same = left.where("_s is not null").withColumn("_t", F.col("_s")).join(right, ["material_table", "_t"])
    anywhere = left.where("_s is null").join(right, "material_table")  # a template without sections takes names of any
    pairs = same.unionByName(anywhere)
    scored = pairs.withColumn("sim", cosine(F.col("_a"), F.col("_b")))
    rank = F.row_number().over(W.partitionBy("material_table", "tpl_row").orderBy(F.desc("sim"), "found._ord"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= most).select("material_table", "tpl_row", "tpl_property", "rank", "sim", "found")


def first_verified(candidates: DataFrame, verifier: Verifier) -> DataFrame:
    """Of each template row's candidates the first that the verifier accepts; each pair of names is asked once."""
    pairs = candidates.select("tpl_property", F.col("found.property_name").alias("name")).distinct()

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(same=[bool(verifier(x, y)) for x, y in zip(b["tpl_property"], b["name"], strict=True)])

    told = pairs.mapInPandas(ask, "tpl_property string, name string, same boolean").where("same")
    good = candidates.withColumn("name", F.col("found.property_name")).join(told, ["tpl_property", "name"], "left_semi")
    return good.groupBy("material_table", "tpl_row").agg(F.min_by("found", "rank").alias("found"))


def reconcile(template: DataFrame, materials: DataFrame, vectorizer: Vectorizer, verifier: Verifier, search: Callable = nearest_names) -> DataFrame:
    """The template's rows for every material with five columns of what was found; exact names first, then similar.

    template has `_ord`; materials: material_table, section, property_name, value, unit, english, comments, _ord.
    """
    wanted = for_every_table(template_rows(template), materials)
    exact = exact_matches(wanted, materials)
    open_rows = exact.where("found is null").drop("found")
    similar = first_verified(search(open_rows, materials, vectorizer), verifier)
    both = exact.where("found is not null").unionByName(open_rows.join(similar, ["material_table", "tpl_row"], "left"))
    cols = [F.col(f"found.{c}").alias(n) for c, n in zip(("property_name", "value", "unit", "english", "comments"), OUTPUT, strict=True)]
    extra = template.withColumnRenamed("_ord", "tpl_row")
    return both.select("material_table", "tpl_row", *cols).join(_small(extra), "tpl_row")
