"""Quality rules: cross-document line frequency.

Lines are normalised (ASCII lower case, digits as 0, one space between words) and hashed to 128 bits. For each
host the distinct document contents that hold a line are counted; a text that is repeated byte for byte counts once,
so copies do not make their own lines frequent, while texts that differ in digits, case or spacing each count. A line
in more contents of a host than the limit goes from all documents but the first of them (smallest doc_id), and a
document that loses too large a share of its words is rejected as depleted.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from alloyframe.llm.common import kept_rows, map_slices, maybe_broadcast, row_key, stage, utf8
from alloyframe.sources.scratch import scratch, temporary

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
DIGITS = bytes.maketrans(b"123456789", b"000000000")
#: Frequent lines, of some 100 bytes on a worker, up to which every worker has their table.
FREQUENT_LINES = 200_000


@dataclass(frozen=True)
class LineRules:
    #: A line is frequent when more contents of its host hold it, however many contents the host has.
    max_contents: int = 20
    #: A document is depleted when frequent lines held more than this share of its words, in percent.
    max_lost_percent: int = 50
    #: Base rules: too few words, or too many repeated words in percent.
    min_words: int = 50
    max_repeat_percent: int = 50


def repeat_words(words: list[bytes]) -> int:
    """Words in 3-word windows that are found twice or more, the first place included."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    two = ids[:-1] * len(known) + ids[1:]
    if len(known) > 1_000_000:  # keeps the next product within 63 bits
        two = np.unique(two, return_inverse=True)[1]
    three = two[:-1] * len(known) + ids[2:]
    order = np.argsort(three, kind="stable")
    same = three[order][1:] == three[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def normal_line(line: bytes) -> bytes:
    return b" ".join(line.lower().split()).translate(DIGITS)


def _measure(batch: pa.RecordBatch) -> pa.RecordBatch:
    out: dict[str, list] = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content", "line", "line_words")}
    for text in utf8(batch.column("text")):
        words = text.split()
        bare = text.translate(None, SPACE)
        lines = [x for x in text.split(b"\n") if x.split(None, 1)]
        own: dict[bytes, int] = {}
        for x in lines:
            k = xxhash.xxh3_128_digest(normal_line(x))
            own[k] = own.get(k, 0) + len(x.split())
        out["n_words"].append(len(words))
        out["word_chars"].append(len(bare.decode("utf-8", "replace")))
        out["n_symbols"].append(len(bare) - len(bare.translate(None, SYMBOLS)))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        out["n_repeat_words"].append(repeat_words(words))
        out["content"].append(xxhash.xxh3_128_digest(text))
        out["line"].append(list(own))
        out["line_words"].append(list(own.values()))
    kinds = {"content": pa.binary(), "line": pa.list_(pa.binary()), "line_words": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays(
        [batch.column(k) for k in ("rid", "doc_id", "host", "key")] + [pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()],
        names=["rid", "doc_id", "host", "key", *out],
    )


def _host(host: str) -> Column:
    return F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host")


def _judged(docs: DataFrame, host: str, rules: LineRules, place: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The columns of line_rules and the key by row, (host, key, line) of the lines that go, and the frequent lines.

    The last are (host, line, first_key), staged at a place if one is given.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", row_key().alias("key"), _host(host), "text")
    schema = "rid long, doc_id long, host string, key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content binary, line array<binary>, line_words array<long>"
    seen = stage(map_slices(rows, _measure, schema), "lines")
    contents = seen.groupBy("host", "content").agg(F.min("key").alias("key"), F.first("line").alias("line"))
    held = contents.select("host", "key", F.explode("line").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"), F.min("key").alias("first_key"))
    frequent = stage(held.where(F.col("n") > rules.max_contents).select("host", "line", "first_key"), "frequent", place)
    places = seen.select("rid", "key", "host", F.explode(F.arrays_zip("line", "line_words")).alias("x")).select("rid", "key", "host", "x.line", "x.line_words")
    gone = places.join(maybe_broadcast(frequent, 200_000), ["host", "line"]).where("key != first_key")
    lost = gone.groupBy("rid").agg(F.sum("line_words").alias("lost_words"))
    bad = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    judged = (
        seen.drop("content", "line", "line_words", "host").join(lost, "rid", "left").drop("rid")
        .withColumn("lost_words", F.coalesce("lost_words", F.lit(0).cast("long")))
        .withColumn("base_failed", bad)
        .withColumn("kept", ~bad & (100 * F.col("lost_words") <= rules.max_lost_percent * F.col("n_words")))
    )
    return judged, gone.select("host", "key", "line"), frequent


def line_rules(docs: DataFrame, host: str = "source", rules: LineRules = LineRules()) -> DataFrame:
    """Per row of docs: doc_id, counts, base_failed, lost_words, kept.

    Reads doc_id, text and the host column only, so other columns cannot clash. A null text has no words and
    fails the base rules; a null host is one host of its own; repeated rows are judged each for itself and count
    as one content; an empty table gives an empty result. Texts are measured whole.
    """
    return _judged(docs, host, rules)[0].drop("key")


def _without(text: bytes, gone) -> bytes | None:
    """A text without the lines whose digests are gone; null if it has none of them."""
    lines = text.split(b"\n")
    left = [x for x in lines if not x.split(None, 1) or not gone(xxhash.xxh3_128_digest(normal_line(x)))]
    return b"\n".join(left) if len(left) < len(lines) else None


def _cut_by_list(rows: DataFrame, cut: DataFrame, schema: StructType) -> DataFrame:
    """(row, text) by the list of digests that each row loses, for more frequent lines than every worker could have."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = [set(x or ()) for x in batch.column("cut").to_pylist()]
        out = [_without(text, own.__contains__) for text, own in zip(utf8(batch.column("text")), lists, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.binary()).cast(pa.string())], names=["row", "text"])

    return map_slices(rows.join(cut, ["host", "key"], "left").select("row", "text", "cut"), run, schema)


def _cut_by_table(rows: DataFrame, frequent: DataFrame, schema: StructType) -> DataFrame:
    """(row, text) by the table of frequent lines, which every worker has, so that no text is shuffled or written."""
    table: dict[str, dict[bytes, int]] = {}
    for r in frequent.collect():  # FREQUENT_LINES at most
        table.setdefault(r["host"], {})[bytes(r["line"])] = r["first_key"]
    shared = frequent.sparkSession.sparkContext.broadcast(table)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for host, key, text in zip(batch.column("host").to_pylist(), batch.column("key").to_pylist(), utf8(batch.column("text")), strict=True):
            own = shared.value.get(host)
            out.append(_without(text, lambda line: own.get(line, key) != key) if own else None)  # noqa: B023
        return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.binary()).cast(pa.string())], names=["row", "text"])

    return map_slices(rows.select("row", "text", "host", "key"), run, schema)


def keep_documents(docs: DataFrame, host: str = "source", rules: LineRules = LineRules()) -> DataFrame:
    """The rows of docs that the rules keep, less the lines above the limit, with n_chars brought up to date.

    A line stays in the first of its documents. Rows that share a doc_id stand or fall together, and rows without one
    that share a text; these come after all others. Rows that lose nothing are unchanged.
    """
    places = {name: scratch(docs.sparkSession, name) for name in ("rejected", "frequent", "cut")}
    schema = StructType([StructField("row", docs.schema), StructField("text", StringType())])
    with temporary(docs.sparkSession):
        judged, lines, frequent = _judged(docs, host, rules, places["frequent"])
        gone = stage(judged.where("not kept").select("key").distinct(), "rejected", places["rejected"])
        few = frequent.count() <= FREQUENT_LINES
        if not few:  # which lines a row loses follows from its host and key, so that rows which share them may share the list
            cut = stage(lines.join(maybe_broadcast(gone), "key", "left_anti").groupBy("host", "key").agg(F.collect_set("line").alias("cut")), "cut", places["cut"])
    kept = kept_rows(docs, gone).withColumns({"host": F.coalesce(F.col("row").getField(host).cast("string"), F.lit("")), "text": F.col("row").getField("text")})
    less = _cut_by_table(kept, frequent, schema) if few else _cut_by_list(kept, cut, schema)
    own = lambda c: F.col("row").getField(c)
    new = {"text": F.coalesce("text", own("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(own("n_chars"))
    return less.select(*(new.get(c, own(c)).alias(c) for c in docs.columns))
