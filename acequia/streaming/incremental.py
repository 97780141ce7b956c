"""Curation of files as they come, with Structured Streaming.

The stream's checkpoint says which files are done, so a run that is begun
again goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from acequia.functions.text import clean, token_count


def clean_stream(spark: SparkSession, source: str, schema: str, files_at_once: int = 100) -> DataFrame:
    """Documents of a folder's Parquet files, cleaned and with tokens, as a stream."""
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(source)
    return raw.where(F.col("text").isNotNull()).withColumn("text", clean(F.col("text"))).withColumn("tokens", token_count(F.col("text")))


def once_by_text(stream: DataFrame, time: str, late: str = "1 day") -> DataFrame:
    """The first of equal texts that come within a time of each other."""
    return stream.withColumn("text_hash", F.sha2("text", 256)).withWatermark(time, late).dropDuplicatesWithinWatermark(["text_hash"])


def counts_by_window(stream: DataFrame, time: str, source: str, length: str = "1 day", late: str = "1 day") -> DataFrame:
    """(window, source, n_docs, n_tokens) of tumbling windows; later documents are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, length), source).agg(F.count("*").alias("n_docs"), F.sum("tokens").alias("n_tokens"))


def write_batches(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Hand what has come to a writer batch by batch, then stop."""
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def write_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has come to Parquet files, then stop."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
