"""Numbers in order without one task for all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Parts of the order at most, each of which a task numbers for itself.
MOST_PARTS = 256


def numbered_by(rows: DataFrame, by: Sequence[str], order: Sequence[str], name: str, first: int = 0) -> DataFrame:
    """Rows numbered from `first` among those that are equal in `by`, in an order that the columns decide.

    Edges between the parts of the order are those of a sample by hash, so that they are the same whenever the plan
    runs. Rows are numbered within their part, and what earlier parts hold is added from a count of each part.
    """
    key = F.struct(*(F.col(f"`{c}`") for c in order))
    parts = min(MOST_PARTS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sample = rows.select(key.alias("k")).distinct().orderBy(F.xxhash64("k"), "k").limit(16 * parts)
    edges = sample.agg(F.sort_array(F.collect_list("k")).alias("all")).select(
        F.transform(F.sequence(F.lit(1), F.lit(parts - 1)), lambda i: F.get("all", (i * F.size("all") / parts).cast("int"))).alias("edges") if parts > 1 else F.slice("all", 1, 0).alias("edges")
    )
    dealt = rows.crossJoin(F.broadcast(edges)).withColumn("_part", F.size(F.filter("edges", lambda e: e < key))).drop("edges")  # one row of edges
    groups = [F.col(f"`{c}`") for c in by]
    counts = dealt.groupBy(*(g.alias(f"_by{i}") for i, g in enumerate(groups)), "_part").count()
    names = [f"_by{i}" for i in range(len(groups))]
    before = F.sum("count").over(W.partitionBy(*names or [F.lit(0)]).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))  # parts of each group
    offsets = counts.select(*names, F.col("_part").alias("_p"), F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(W.partitionBy(*groups, "_part").orderBy(*(F.col(f"`{c}`") for c in order)))
    on = F.col("_part") == F.col("_p")
    for g, n in zip(groups, names, strict=True):
        on = on & g.eqNullSafe(F.col(n))
    return dealt.withColumn("_place", place).join(offsets, on).withColumn(name, (F.col("_place") + F.col("_before") + (first - 1)).cast("long")).drop("_place", "_before", "_part", "_p", *names)
