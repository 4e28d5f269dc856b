"""Token counts: delta-maintained rollups.

A rollup folder holds additive totals by (source, lang, tokenizer version). A batch brings signed rows: an insert
counts +1 document, a delete -1, a revised count the difference. Each batch is aggregated before it is stored, so
that the store grows with the number of groups, not of documents. A batch commits by one rename of its folder to the
name of its id, which fails if that name is there: a batch id is applied once, whoever else tries, and an attempt
that broke off leaves nothing under that name. A compaction commits likewise, as the next generation, with the list
of the batches it holds. Readers list names; they open no batch that a generation holds.

The rename must fail where the name is taken, as HDFS and local file systems do.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping
from urllib.parse import quote, unquote

import public_tokenizers
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alloyframe.llm.bpe_prefix import VOCABULARY, codec
from alloyframe.llm.common import map_slices, maybe_broadcast, stage, text_key

KEYS = ["source", "lang", "tokenizer"]
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
#: Characters of a batch id, once escaped, that a file name takes.
LONGEST_ID = 200


class TokenRollup:
    """Totals kept under a path that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm.org.apache.hadoop.fs
        self._path = jvm.Path
        conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.path).getFileSystem(conf)
        self._renames = jvm.FileContext.getFileContext(self._path(self.path).toUri(), conf)
        self._plain = spark._jvm.java.lang.reflect.Array.newInstance(spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        for part in ("batches", "generations", "attempts"):
            self._fs.mkdirs(self._path(f"{self.path}/{part}"))

    @staticmethod
    def _name(batch_id: str) -> str:
        """The id as a file name: any text that is not too long, slashes and colons included."""
        name = "id-" + quote(batch_id, safe="")
        if len(name) > LONGEST_ID:
            raise ValueError(f"a batch id may have {LONGEST_ID - 3} characters at most, escaped")
        return name

    def _attempt(self) -> str:
        return f"{self.path}/attempts/{uuid.uuid4().hex}"

    def _commit(self, attempt: str, to: str) -> bool:
        """Give an attempt its name; False, and the attempt goes, if the name is taken."""
        try:
            self._renames.rename(self._path(attempt), self._path(f"{self.path}/{to}"), self._plain)
        except Py4JJavaError as e:
            if not self._fs.exists(self._path(f"{self.path}/{to}")):
                raise RuntimeError(f"{to} can't be committed") from e
            self._fs.delete(self._path(attempt), True)
            return False
        return True

    def _names(self, part: str) -> list[str]:
        return [str(x.getPath().getName()) for x in self._fs.listStatus(self._path(f"{self.path}/{part}"))]

    def _state(self) -> tuple[list[str], str | None, int, set[str]]:
        """Folders of the batches that no generation holds, the last generation's folder and number, and what it holds."""
        last = max(map(int, self._names("generations")), default=0)
        base = f"{self.path}/generations/{last}" if last else None
        held = {r[0] for r in self.spark.read.text(f"{base}/held").collect()} if base else set()  # a name for each batch
        return sorted(f"{self.path}/batches/{x}" for x in self._names("batches") if x not in held), base, last, held

    def committed(self) -> set[str]:
        return {unquote(x[3:]) for x in self._names("batches")}

    def apply(self, batch_id: str, delta: DataFrame) -> bool:
        """Fold a batch of (source, lang, tokenizer, sign, n_tokens) in; False if the batch was there already.

        sign is +1 or -1 for a document that comes or goes, 0 for a changed count; n_tokens is already signed.
        Null keys are a group of their own; null counts count as 0. An empty batch commits without totals.
        """
        to = f"batches/{self._name(batch_id)}"
        if self._fs.exists(self._path(f"{self.path}/{to}")):
            return False
        attempt = self._attempt()
        (
            delta.groupBy(*[F.col(k).cast("string").alias(k) for k in KEYS])
            .agg(F.coalesce(F.sum("sign"), F.lit(0)).cast("long").alias("n_docs"), F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("long").alias("n_tokens"))
            .write.parquet(attempt)
        )
        return self._commit(attempt, to)

    def _summed(self, batches: list[str], base: str | None) -> DataFrame:
        folders = [*([f"{base}/totals"] if base else []), *batches]
        rows = self.spark.read.schema(TOTALS).parquet(*folders) if folders else self.spark.createDataFrame([], TOTALS)
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs != 0 or n_tokens != 0")

    def totals(self) -> DataFrame:
        """Current totals of every group that has a document or a token."""
        batches, base, _, _ = self._state()
        return self._summed(batches, base)

    def compact(self) -> bool:
        """Sum what is committed now into the next generation; batches that land meanwhile stay beside it.

        The sum and the list of what it holds come from one look at the folder. False if another compaction was first.
        """
        batches, base, last, held = self._state()
        attempt = self._attempt()
        self._summed(batches, base).coalesce(1).write.parquet(f"{attempt}/totals")
        names = sorted(held | {x.rsplit("/", 1)[1] for x in batches})
        self.spark.createDataFrame([(x,) for x in names], "value string").coalesce(1).write.text(f"{attempt}/held")
        return self._commit(attempt, f"generations/{last + 1}")


#: Tokenizer versions of the demonstration query, as patterns: words between white space, and the pieces of them.
TOKENIZERS = {"words-1": r"[^\x20\x09-\x0D]+", "pieces-1": r"[A-Za-z]+|[0-9]|[^\x20\x09-\x0DA-Za-z0-9]+"}
#: The revision of words-1 leaves out words without an ASCII letter or digit.
REVISED = r"[^\x20\x09-\x0DA-Za-z0-9]*+[A-Za-z0-9][^\x20\x09-\x0D]*+"


def measured(docs: DataFrame, tokenizers: Mapping[str, str]) -> DataFrame:
    """(doc_id, source, lang, same, counts): every pattern counted in one pass, and the key of the text.

    counts has a field for each tokenizer; a null text has no tokens.
    """
    n = [F.coalesce(F.regexp_count("text", F.lit(p)), F.lit(0)).cast("long").alias(name) for name, p in tokenizers.items()]
    return docs.select("doc_id", "source", "lang", text_key(F.col("text")).alias("same"), F.struct(*n).alias("counts"))


def measured_by_bpe(docs: DataFrame, name: str = "bpe-1", vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """The same with the byte-level encoder's counts under one name."""
    more = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(public_tokenizers.path(vocabulary), pattern)
        texts = batch.column("text").to_pylist()
        n = pa.array([len(own.encode(x or "")) for x in texts], pa.int64())
        same = pa.array([None if x is None else hashlib.sha256(x.encode()).digest() for x in texts], pa.binary())
        cols = [*(batch.column(k) for k in ("doc_id", "source", "lang")), same, pa.StructArray.from_arrays([n], names=[name])]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "source", "lang", "same", "counts"])

    return map_slices(more, run, f"doc_id long, source string, lang string, same binary, counts struct<`{name}`:long>")


def counted(rows: DataFrame, tokenizer: str, version: str | None = None, sign: int = 1) -> DataFrame:
    """Signed rows for measured documents under a tokenizer's name, with the counts of a version of it."""
    n = F.col("counts").getField(version or tokenizer)
    return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(sign).alias("sign"), (n * sign).alias("n_tokens"))


def revised(rows: DataFrame, tokenizer: str, old: str, new: str) -> DataFrame:
    """Signed rows that turn one version's counts into another's; unchanged documents give no row."""
    n = F.col("counts").getField(new) - F.col("counts").getField(old)
    return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(0).alias("sign"), n.alias("n_tokens")).where("n_tokens != 0")


def later_copies(rows: DataFrame) -> DataFrame:
    """Measured rows whose text a row with a smaller doc_id has too. A null text is no copy.

    Rows of the same doc_id and text are one document that is stored twice, and neither is a later copy.
    """
    groups = rows.where("same is not null").groupBy("same").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    groups = stage(groups.where("first_doc != last_doc").select("same", "first_doc"), "copies")
    return rows.join(maybe_broadcast(groups, 100_000), "same").where("doc_id != first_doc").drop("first_doc")
