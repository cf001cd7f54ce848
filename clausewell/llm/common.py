"""Helpers shared by the training-data operators: tables, and intermediate results in
the folder that driver and executors share."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from clausewell.sources import tables
from clausewell.sources.shared import discard, fresh_path, materialize, shared_dir

__all__ = ["discard", "fresh_path", "materialize", "release_memory", "shared_dir", "small_batches", "table"]

_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Let texts go to Python in batches of a few megabytes, for this session, if it has
    Spark's default: whole texts fill those of 64 megabytes, several times over on the way."""
    if spark.conf.get(_BATCH) == "67108864b":
        spark.conf.set(_BATCH, size)


def release_memory() -> None:
    """Give back to the system what earlier tasks of this worker have freed."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, dealt over the cores if it has fewer partitions than they are."""
    return tables.spread(tables.table(spark, sf_dir, name))
