"""Columns that injected models make: extraction answers, embeddings, text blocks and boxes of pages."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alloyframe.functions.text import file_stem
from alloyframe.plugins import Extractor, Vectorizer


def extract_answers(files: DataFrame, extractor: Extractor) -> DataFrame:
    """(doc_id, answer) for binary files; an extractor that fails gives null for that file alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for content, name in zip(batch["content"], batch["path"], strict=True):
                try:
                    out.append(extractor(content, name))
                except Exception:  # the model's own errors are part of its answer: none
                    out.append(None)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "answer": pd.Series(out, dtype=object)})

    return files.select("path", "content", file_stem(F.col("path")).alias("doc_id")).mapInPandas(run, "doc_id string, answer string")


def embed(texts: Column, vectorizer: Vectorizer) -> Column:
    """Embeddings of a text column; a null text is an empty one."""

    @F.pandas_udf("array<float>")
    def run(batch: pd.Series) -> pd.Series:
        return pd.Series(list(vectorizer(batch.fillna("").tolist())))

    return run(texts)


def embed_items(items: DataFrame, vectorizer: Vectorizer, image_vectorizer: Callable | None = None) -> DataFrame:
    """Items (text, image) with an embedding; an item that has neither is an error, as a model would refuse it."""
    checked = F.when(F.col("text").isNull() & F.col("image").isNull(), F.raise_error(F.lit("an item needs a text or an image")).cast("string")).otherwise(F.coalesce("text", F.base64("image")))
    return items.withColumn("embedding", embed(checked, vectorizer))


def page_blocks(files: DataFrame, reader: Callable[[bytes], list[tuple]]) -> DataFrame:
    """Text blocks (doc_id, page, ord, x0, y0, x1, y1, text) by a reader of (page, x0, y0, x1, y1, text) rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(d, b[0], i, *b[1:]) for d, c in zip(batch["doc_id"], batch["content"], strict=True) for i, b in enumerate(reader(c))]
            yield pd.DataFrame(rows, columns=["doc_id", "page", "ord", "x0", "y0", "x1", "y1", "text"])

    return files.select("content", file_stem(F.col("path")).alias("doc_id")).mapInPandas(run, "doc_id string, page int, ord int, x0 double, y0 double, x1 double, y1 double, text string")


def page_images(files: DataFrame, reader: Callable[[bytes], Iterable[tuple[int, bytes]]]) -> DataFrame:
    """(doc_id, page, png, page_w, page_h) by a reader of (page, PNG bytes) rasters; the size is in the PNG's head."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc, content in zip(batch["doc_id"], batch["content"], strict=True):
                for page, png in reader(content):  # a page at a time, since a page may be large
                    width, height = struct.unpack(">II", png[16:24])
                    yield pd.DataFrame({"doc_id": [doc], "page": [page], "png": [png], "page_w": [width], "page_h": [height]})

    return files.select("content", file_stem(F.col("path")).alias("doc_id")).mapInPandas(run, "doc_id string, page int, png binary, page_w int, page_h int")


def page_tables(files: DataFrame, reader: Callable[[bytes], list[tuple]], first_page: int = 1) -> DataFrame:
    """Cells (doc_id, page, table_idx, row_idx, col_idx, cell) by a reader of (page, rows) tables.

    Pages are counted from 1 here; first_page is the number that the reader gives the first. A file whose reader fails
    gives no cells.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, content in zip(batch["doc_id"], batch["content"], strict=True):
                try:
                    tables = list(reader(content))
                except Exception:  # as in a scan of many files: a broken one has no tables
                    tables = []
                rows += [(doc, page + 1 - first_page, t, r, c, cell) for t, (page, body) in enumerate(tables) for r, line in enumerate(body) for c, cell in enumerate(line)]
            yield pd.DataFrame(rows, columns=["doc_id", "page", "table_idx", "row_idx", "col_idx", "cell"])

    return files.select("content", file_stem(F.col("path")).alias("doc_id")).mapInPandas(run, "doc_id string, page int, table_idx int, row_idx int, col_idx int, cell string")
