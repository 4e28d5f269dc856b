"""What the corpus operators share: scratch tables, size checks, bounded batches and components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from alloyframe.sources.scratch import drop_path, scratch

#: Rows of a key-only table that may be broadcast; 16 bytes each, so 32 MB at most.
BROADCAST_ROWS = 2_000_000
#: Bytes of Arrow data that a Python worker handles at a time.
SLICE_BYTES = 4 << 20


def stage(df: DataFrame, name: str, at: str | None = None) -> DataFrame:
    """Write a table to the shared folder, or to a path there, and read it back: lineage ends there and survives lost
    executors. The write's own shuffle files go when it is done, since nothing reads them again."""
    spark, clean = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = at or scratch(spark, name), spark.conf.get(clean)
    spark.conf.set(clean, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(clean, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(*tables: DataFrame) -> None:
    """Delete staged tables that no later plan reads."""
    for df in tables:
        for file in df.inputFiles()[:1]:
            drop_path(df.sparkSession, file.rsplit("/", 1)[0])


def maybe_broadcast(df: DataFrame, most: int = BROADCAST_ROWS, wide: str | None = None) -> DataFrame:
    """Hint a broadcast of a staged table if its row count is within the bound; else leave the join to shuffle.

    With an array column named, the bound is on rows and array elements together.
    """
    n = df.agg(F.sum(F.size(wide) + 1)).first()[0] or 0 if wide else df.count()
    return F.broadcast(df) if n <= most else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: Column) -> Column:
    """256 bits that tell texts apart; null for a null."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def row_key() -> Column:
    """The doc_id by which decisions name a row; one without an id is named by its text and comes after all others."""
    other = F.shiftrightunsigned(F.xxhash64("text", F.lit("row")), 2) + F.lit(1 << 62)
    return F.coalesce(F.col("doc_id").cast("long"), other)


def kept_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """(row, key) of the rows of docs whose key is not in gone (key); row holds their columns, whatever their names."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), row_key().alias("key"))
    return rows.join(maybe_broadcast(gone), "key", "left_anti")


def held_out(doc_id: Column, parts: int, rest: int) -> Column:
    """Whether crc32 of the id's text leaves this remainder; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == rest, F.lit(False))


def keep_freed_memory() -> None:
    """Let a worker's allocator keep what arrays of some MB free, in place of asking for new pages for each of them.

    The C library takes the largest block that was freed, up to 32 MB, as the mark from which memory goes back.
    """
    np.empty(30 << 20, np.uint8)


def slices(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each is about `most` bytes; a longer row stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """mapInArrow over small slices; fn may keep state for a worker's task in its closure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed_memory()
        for part in slices(batches):
            out = fn(part)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """A text column as bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node that each node of an edge reaches; a root itself has no row.

    Alternating large-star and small-star steps over a two-column table of longs, each written to the
    shared folder; a step moves an edge once, so a node with many neighbours makes no more rows than it has
    edges. Work on the driver is one count and one sum per round.
    """
    e = (
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    e = stage(e, "cc")
    last = None
    while True:
        # large star: each neighbour larger than the node goes to the node's smallest neighbour (or itself)
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        low = stage(low, "cc-low")
        large = (
            both.where(F.col("v") > F.col("u")).join(low, F.col("u") == F.col("n"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = stage(large, "cc-large")
        # small star: each node and its smaller neighbours go to the smallest of them
        small_low = stage(large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "n"), "cc-low")
        small = (
            large.join(small_low, F.col("u") == F.col("n"))
            .select(F.col("v").alias("x"), "m")
            .where("x != m")
            .unionAll(small_low.select(F.col("n").alias("x"), "m"))
            .select(F.col("x").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        new = stage(small, "cc")
        now = tuple(new.select(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
        drop_staged(e, low, large, small_low)
        e = new
        if now == last:
            break
        last = now
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


#: Labels that a sample takes in at most: the most frequent ones.
MOST_LABELS = 200


def in_class_sample(rows: DataFrame, label: str, most: int, key: str = "doc_id", labels: int = MOST_LABELS) -> Column:
    """A condition that about `most` rows of each label meet at most, by a hash of the key; all rows of rarer labels.

    Rows of other labels than the most frequent ones (of equal ones the first in order), and rows without a key or a
    label, do not meet it. Only the label is read, and no more than a count for each of those labels is gathered.
    """
    counts = rows.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(label).count()
    last = [(r[0], (min(most, r[1]) << 63) // r[1] - 1) for r in counts.orderBy(F.desc("count"), label).limit(labels).collect()]
    if not last:
        return F.lit(False)
    limits = F.create_map(*[x for k, v in last for x in (F.lit(k), F.lit(v).cast("long"))])
    place = F.shiftrightunsigned(F.xxhash64(key, F.lit("sample")), 1)
    return F.coalesce(F.col(key).isNotNull() & (place <= F.try_element_at(limits, F.col(label))), F.lit(False))
