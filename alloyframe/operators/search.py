"""Faceted search over the property table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alloyframe.functions.classify import fiber_of, matrix_of
from alloyframe.operators.order import numbered_by

ALL = "All"


def union_uploads(base: DataFrame, uploads: DataFrame, material_class: str | None = None) -> DataFrame:
    """Base rows and the uploads of a class, by column name; what one side lacks is null."""
    if material_class is not None:
        uploads = uploads.where(F.col("material_class") == material_class)
    return base.unionByName(uploads, allowMissingColumns=True)


def first_distinct(rows: DataFrame, *columns: str, order: str = "_ord") -> DataFrame:
    """Distinct values in the order in which they first come; `_ord` is where."""
    return rows.groupBy(*columns).agg(F.min(order).alias("_ord")).orderBy("_ord")


def numbered(rows: DataFrame, *order: str, name: str = "row") -> DataFrame:
    """Rows numbered from 0 in an order that the columns decide."""
    return numbered_by(rows, [], order, name)


def material_list(facts: DataFrame, mode: str = "parity") -> DataFrame:
    """(material_abbreviation, material_name, _ord, matrix, fiber), null names as empty."""
    named = facts.select(F.coalesce("material_abbreviation", F.lit("")).alias("material_abbreviation"), F.coalesce("material_name", F.lit("")).alias("material_name"), "_ord")
    listed = named.groupBy("material_abbreviation", "material_name").agg(F.min("_ord").alias("_ord"))
    return listed.withColumns({"matrix": matrix_of(F.col("material_abbreviation"), mode), "fiber": fiber_of(F.col("material_abbreviation"), mode)})


def facet_options(materials: DataFrame, facet: str) -> DataFrame:
    """The values of a facet that occur, sorted."""
    return materials.select(facet).where(F.col(facet).isNotNull()).distinct().orderBy(facet)


def _chosen(column: str, value: str | None) -> Column | None:
    return None if value in (None, "", ALL) else F.col(column) == value


def filter_materials(materials: DataFrame, material_class: str, matrix: str | None = ALL, fiber: str | None = ALL) -> DataFrame:
    """Materials with the chosen facets; the matrix is a facet of composites only."""
    for cond in (_chosen("matrix", matrix) if material_class == "Composite" else None, _chosen("fiber", fiber)):
        materials = materials if cond is None else materials.where(cond)
    return materials


def measured(facts: DataFrame, abbreviation: str | None = None) -> DataFrame:
    """Rows with a property and a value, of a material if one is chosen."""
    out = facts.where(F.col("material_abbreviation") == abbreviation) if abbreviation else facts
    return out.where(F.col("value").isNotNull() & F.col("property_name").isNotNull())


def list_sections(facts: DataFrame, abbreviation: str | None = None) -> DataFrame:
    """Sections in order of first appearance; a null section is no option, since it could not be chosen."""
    return first_distinct(measured(facts, abbreviation).where(F.col("section").isNotNull()), "section")


def list_properties(facts: DataFrame, section: str, abbreviation: str | None = None) -> DataFrame:
    return first_distinct(measured(facts, abbreviation).where(F.col("section") == section), "property_name", "section")


def search(facts: DataFrame, abbreviation: str, prop: str, links: DataFrame | None = None) -> DataFrame:
    """Rows of a material's property that have a value, and with links the image of each.

    links has material_abbreviation, property_name and image_path, one row for each pair.
    """
    if not abbreviation or not prop:
        raise ValueError("choose a material and a property")
    found = facts.where((F.col("material_abbreviation") == abbreviation) & (F.col("property_name") == prop) & F.col("value").isNotNull())
    return found if links is None else with_images(found, links)


def with_images(facts: DataFrame, links: DataFrame) -> DataFrame:
    """Facts with image_path, null where no image is linked."""
    return facts.join(links.select("material_abbreviation", "property_name", "image_path"), ["material_abbreviation", "property_name"], "left")


def transposed(rows: DataFrame, key: str = "_ord") -> DataFrame:
    """(key, field, value): a result field by field, as it is shown; values as text."""
    others = [c for c in rows.columns if c != key]
    return rows.select(key, *[F.col(c).cast("string").alias(c) for c in others]).unpivot([key], others, "field", "value")


def wide_transposed(rows: DataFrame, key: str = "_ord") -> DataFrame:
    """A field a row and a column for each row of a small result."""
    others = [c for c in rows.columns if c != key]
    return rows.select(key, *[F.col(c).cast("string").alias(c) for c in others]).transpose(key)


def class_of_label(rows: DataFrame, labels: dict[str, str], label: str = "label") -> DataFrame:
    """Rows with the class that a label stands for; the dictionary is a few entries."""
    dim = rows.sparkSession.createDataFrame(sorted(labels.items()), f"{label} string, material_class string")
    return rows.join(F.broadcast(dim), label, "left")


def row_at(rows: DataFrame, number: int, *order: str) -> DataFrame:
    """The row of this number, from 0, in an order."""
    return numbered(rows, *order, name="_row").where(F.col("_row") == number).drop("_row")
