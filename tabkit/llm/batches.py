"""Running the Python steps with small Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.session import stage

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> Iterator[None]:
    """Arrow batches of at most rows rows and about size bytes in the jobs run inside.

    Text rows are far larger than the default of 10,000 rows a batch assumes;
    the session's own setting is put back afterwards.
    """
    conf = spark.conf
    before = {k: conf.get(k, None) for k in (ROWS, BYTES)}
    try:
        conf.set(ROWS, str(rows))
        conf.set(BYTES, size)
        yield
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def stage_batched(df: DataFrame, rows: int = 1000, size: str = "8m") -> DataFrame:
    """stage(df) with small Arrow batches."""
    with small_batches(df.sparkSession, rows, size):
        return stage(df)


def broadcast_below(df: DataFrame, most: int = 8 << 20) -> DataFrame:
    """Hint a broadcast if the planner knows df, a stored table, to be at most ``most`` bytes; no job is run for it."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(df) if size <= most else df
