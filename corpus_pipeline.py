"""The corpus pipeline: quality rules, near duplicates, repeated passages, benchmark passages, tokens.

Each stage is a function (spark, docs, sf_dir) to a DataFrame and works on all that the stage before it kept. All but
the last return the columns of documents, and pass on further columns as they are.

Null and empty texts fail the base rules and go in the first stage. Rows that share a doc_id stand or fall together,
and so do rows without a doc_id that share a text; these come after all others where a first document is looked for.
Repeated rows stay repeated; an empty table gives an empty result; texts of any length are read whole; further columns
may have any names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from alloyframe.llm import bpe_prefix, decontamination, golay_simhash, line_frequency, prefix_free_dedup
from alloyframe.llm.common import stage, table
from alloyframe.sources.scratch import drop_path, scratch, temporary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the line-frequency rule reject go, and frequent lines from the text of the rest."""
    return line_frequency.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked fingerprints stays, the one with the smallest doc_id."""
    return golay_simhash.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that an earlier document has go from the text; documents left empty go."""
    return prefix_free_dedup.keep_rest(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, exactly or edited, go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of what is left."""
    return bpe_prefix.encode_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark passages", benchmark_passages),
    ("tokens", tokens),
]

#: SQL cannot express the alignment, the components or the encoding; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder before the next; what a stage left there goes then."""
    docs, last = table(spark, sf_dir, "documents"), None
    for k, (_, function) in enumerate(STAGES[:-1]):
        place = scratch(spark, f"stage-{k}")
        with temporary(spark):
            docs = stage(function(spark, docs, sf_dir), f"stage-{k}", place)
        if last:
            drop_path(spark, last)
        last = place
    return STAGES[-1][1](spark, docs, sf_dir)
