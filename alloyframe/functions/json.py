"""Decoding of extractor answers and building of metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from alloyframe.schema import ENVELOPE, EXTRACTION


def envelope_text(answer: Column) -> Column:
    """The text of the first part of the first candidate that starts as a JSON object; null if there is none."""
    parts = F.get(F.from_json(answer, ENVELOPE)["candidates"], F.lit(0))["content"]["parts"]
    return F.get(F.filter(F.transform(parts, lambda p: F.regexp_replace(p["text"], r"(?U)^\s+|\s+$", "")), lambda t: t.startswith("{")), F.lit(0))


def extraction(text: Column) -> Column:
    """A parsed extraction document; null where the text is no JSON object."""
    return sound(parsed(text))


def parsed(text: Column) -> Column:
    """An extraction document with _bad, which is the text where it is no JSON object."""
    return F.from_json(text, f"{EXTRACTION}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})


def sound(doc: Column) -> Column:
    """A parsed document; null where its text was no JSON object."""
    return F.when(doc["_bad"].isNull(), doc)


def figure_metadata(caption: Column, page: Column, images: Column, names: bool = False) -> Column:
    """{caption, page, image_count} as JSON, with the file names if asked for."""
    cols = [caption.alias("caption"), page.alias("page"), F.size(images).alias("image_count")]
    if names:
        cols.append(F.transform(images, lambda i: i["filename"]).alias("images"))
    return F.to_json(F.struct(*cols))
