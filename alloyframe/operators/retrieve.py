"""Retrieval: tables as text, chunks, and nearest neighbours over embeddings."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from alloyframe.operators.order import numbered_by
from alloyframe.plugins import Generator

K = 5
#: Numbers in the query vectors of a block, 64 MB of them, and rows of results that are broadcast at most.
MOST_NUMBERS, MOST_BROADCAST = 8_000_000, 500_000
#: Items that are compared at a time, and numbers that this takes at most.
BLOCK_ITEMS, BLOCK_NUMBERS = 512, 2_000_000


def promote_header(cells: DataFrame) -> DataFrame:
    """Cells with the first row of their table as column names, without that row."""
    head = cells.where("row_idx = 0").select("doc_id", "page", "table_idx", "col_idx", F.col("cell").alias("col_name"))
    return cells.where("row_idx > 0").join(head, ["doc_id", "page", "table_idx", "col_idx"], "left")


def table_text(cells: DataFrame) -> DataFrame:
    """(doc_id, page, table_idx, text): cells with bars between, rows on lines, the header left out, null as nan."""
    rows = cells.where("row_idx > 0").groupBy("doc_id", "page", "table_idx", "row_idx").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("col_idx", F.coalesce("cell", F.lit("nan")).alias("cell")))), lambda c: c["cell"]), " | ").alias("line")
    )
    return rows.groupBy("doc_id", "page", "table_idx").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row_idx", "line"))), lambda r: r["line"]), "\n").alias("text"))


def table_items(cells: DataFrame) -> DataFrame:
    """Tables as items (page, type, text, path, image) for embedding."""
    path = F.format_string("%s_table_%d_%d.txt", "doc_id", "page", "table_idx")
    return table_text(cells).select("page", F.lit("table").alias("type"), "text", path.alias("path"), F.lit(None).cast("binary").alias("image"))


def chunks(docs: DataFrame, size: int = 700, overlap: int = 200) -> DataFrame:
    """(doc_id, chunk, start, text): whole texts in pieces of so many characters that overlap; a null gives none."""
    step = size - overlap
    last = F.greatest(F.lit(0), F.ceil((F.length("text") - size) / step))
    cut = docs.where(F.length("text") > 0).select("doc_id", "text", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("chunk"))
    return cut.select("doc_id", "chunk", (F.col("chunk") * step).alias("start"), F.substring("text", F.col("chunk") * step + 1, F.lit(size)).alias("text"))


def type_counts(items: DataFrame, kinds: tuple[str, ...] = ("text", "table", "image", "page")) -> DataFrame:
    return items.agg(*[F.count_if(F.col("type") == k).alias(k) for k in kinds])


def running_counts(items: DataFrame, kind: str = "type", order: str = "ord") -> DataFrame:
    """Items with how many of their kind have come, themselves included."""
    return numbered_by(items, [kind], [order], "seen", 1)


class _Nearest:
    """The k nearest items of each query so far, by squared distance and then id, in double precision."""

    def __init__(self, asked: np.ndarray, k: int):
        self.asked, self.k = asked, k
        self.d2 = np.full((len(asked), 0), np.inf)
        self.ids = np.zeros((len(asked), 0), np.int64)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        step = max(1, BLOCK_NUMBERS // max(1, vectors.size))
        d2 = np.concatenate([((vectors[None] - self.asked[a : a + step, None]) ** 2).sum(axis=2) for a in range(0, len(self.asked), step)])
        d2, own = np.concatenate([self.d2, d2], axis=1), np.concatenate([self.ids, np.broadcast_to(ids, d2.shape)], axis=1)
        if d2.shape[1] > self.k:  # all that may be among the first k, ties included, before they are put in order
            edge = np.partition(d2, self.k - 1, axis=1)[:, self.k - 1 : self.k]
            d2 = np.where(d2 <= edge, d2, np.inf)
        order = np.lexsort((own, d2), axis=1)[:, : self.k]
        self.d2, self.ids = np.take_along_axis(d2, order, axis=1), np.take_along_axis(own, order, axis=1)


def _nearest_in(items: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, id, d2): what each partition of items has nearest to queries, which are gathered."""
    known = queries.select("query_id", "embedding").toPandas()
    if not len(known):
        return items.sparkSession.createDataFrame([], "query_id long, id long, d2 double")
    asked = items.sparkSession.sparkContext.broadcast((known["query_id"].to_numpy(np.int64), np.array(known["embedding"].tolist(), np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, vectors = asked.value
        best = _Nearest(vectors, k)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ITEMS):
                part = batch.slice(at, BLOCK_ITEMS)
                flat = part.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                best.add(part.column("id").to_numpy(zero_copy_only=False), flat.reshape(part.num_rows, -1))
        there = best.ids.shape[1]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names, there)), pa.array(best.ids.ravel()), pa.array(best.d2.ravel())], names=["query_id", "id", "d2"])

    return items.select("id", "embedding").where("embedding is not null").mapInArrow(run, "query_id long, id long, d2 double")


def nearest(queries: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(query_id, id, d2, rank) of the k nearest items of each query by squared distance, exactly; ids are longs.

    queries: query_id, embedding; items: id, embedding. Every item is compared with every query of a block, block by
    block in numpy, and a partition gives k rows for each query, so that what is shuffled does not grow with its rows.
    A block of queries is gathered and sent to all; there are as many scans of the items as blocks.
    """
    n = queries.agg(F.sum(F.size("embedding"))).first()[0] or 0
    blocks = max(1, -(-n // MOST_NUMBERS))
    parts = [queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b) if blocks > 1 else queries for b in range(blocks)]
    found = reduce(DataFrame.unionAll, [_nearest_in(items, p, k) for p in parts])
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("d2", "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def retrieve(query: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """The items nearest to a query, without their embeddings, in order."""
    found = nearest(query, items, k)
    if query.count() <= MOST_BROADCAST // k:  # k rows of three numbers for each
        found = F.broadcast(found)
    return items.drop("embedding").join(found, "id").orderBy("query_id", "rank")


def context_parts(items: DataFrame) -> DataFrame:
    """items with kind and what a model is given of them: text for texts and tables, else the image."""
    texts = F.coalesce(F.col("type").isin("text", "table"), F.lit(False))
    return items.withColumns({"kind": F.when(texts, "text").otherwise("image"), "context_text": F.when(texts, F.col("text")), "context_image": F.when(~texts, F.col("image"))})


def answer(prompt: str, matched: DataFrame, generator: Generator) -> str:
    """What the generator says to the prompt given the k matched items, which are gathered on the driver in order.

    An item is {"text": ...} or {"image": {"format": "png", "bytes": ...}}.
    """
    rows = context_parts(matched).orderBy("rank").collect()
    return generator(prompt, [{"text": r["context_text"]} if r["kind"] == "text" else {"image": {"format": "png", "bytes": r["context_image"]}} for r in rows])
