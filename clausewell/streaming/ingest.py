"""Incremental ingest and windowed counts with Structured Streaming (an extension)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from clausewell.operators.segments import StoredIndex


def windowed_counts(events: DataFrame, ts: str = "ts", by: str = "event_type", window: str = "1 day", late: str = "2 days") -> DataFrame:
    """(window_start, by, n, total): tumbling windows; on a stream, rows later than
    ``late`` are left out."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    counted = rows.groupBy(F.window(ts, window), by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("window.start").alias("window_start"), by, "n", "total")


def ingest(spark: SparkSession, folder: str, schema: StructType, index: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Index each batch of newly arrived Parquet files once, appending to ``out``.

    Batches are keyed by their number, so one that is retried replaces its own rows.
    """

    def one(batch: DataFrame, number: int) -> None:
        index(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def index_stream(spark: SparkSession, folder: str, schema: StructType, index_path: str, documents: Callable[[DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Bring a stored index up to date with newly arrived Parquet files: a batch adds its
    documents, or replaces those that have their ids.

    The index remembers the number of the last batch, so one that is retried after it was
    added changes nothing.
    """

    def one(batch: DataFrame, number: int) -> None:
        StoredIndex(spark, index_path).add(documents(batch), number)

    return spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
