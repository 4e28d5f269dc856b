"""Extension: extractor answers as a stream into the upload store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from alloyframe.operators.ingest import classify_rows, extract_rows, parse_answers
from alloyframe.sources.sinks import conform


def answer_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Files of answers, one JSON object (doc_id, answer, at) a line, each document once within a day."""
    raw = spark.readStream.schema("doc_id string, answer string, at timestamp").json(folder)
    return raw.withWatermark("at", "1 day").dropDuplicatesWithinWatermark(["doc_id"])


def stream_rows(spark: SparkSession, folder: str, store: str, checkpoint: str, material_class: str) -> StreamingQuery:
    """Append the rows of new answers to the store; processed once, as the file sink and its checkpoint have it."""
    rows = classify_rows(extract_rows(parse_answers(answer_stream(spark, folder))), material_class)
    out = conform(rows.withColumn("_src", F.lit("pdf")))
    return out.writeStream.format("parquet").option("path", store).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
