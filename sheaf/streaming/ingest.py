"""Documents as a stream: batches of files go through the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sheaf.sources.sinks import upsert


def read_texts(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """doc_id (the path), text and arrival time of new text files."""
    got = spark.readStream.format("text").option("wholetext", "true").option("maxFilesPerTrigger", files_per_batch).load(path)
    return got.select(F.input_file_name().alias("doc_id"), F.col("value").alias("text"), F.current_timestamp().alias("arrived"))


def into_table(docs: DataFrame, plan: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: str = "doc_id") -> StreamingQuery:
    """Applies a batch plan to every batch and replaces its documents in a table.

    A batch that runs again replaces the same partitions, so a restart changes
    nothing.
    """

    def write(batch: DataFrame, _: int) -> None:
        upsert(plan(batch), out, key)

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_window(events: DataFrame, time: str = "ts", late: str = "10 minutes", width: str = "5 minutes", *keys: str) -> DataFrame:
    """Counts by time window, late rows within the watermark included."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"))
