"""Tables written between steps, and joins whose small side is checked."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feeflow.session import scratch_path

# A side is broadcast only when it was counted and has at most this many narrow rows.
BROADCAST_ROWS = 1_000_000
# Whole texts that go to a Python worker at once: the executor and the worker both hold them.
BATCH_ROWS = 2000


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: the folder is shared, so a lost executor costs a re-read only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """What runs inside sends at most ``rows`` rows to Python workers at once, or fewer if the session
    says so; the session gets its own setting back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    if before is not None and 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def checked_broadcast(small: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``small`` (a written table of narrow rows) with a broadcast hint if it has at most
    ``max_rows`` rows; otherwise as it is, and the join shuffles both sides."""
    return F.broadcast(small) if small.count() <= max_rows else small
