"""Late data (T2, T6) and bounded redelivery state (T5), with what was dropped kept or counted.

Spark drops a row of a windowed count when its window ended at or before the watermark, that is the
newest event time of earlier micro-batches less the delay: of all earlier ones if a batch without
data came between, otherwise of all but the last (late rows are judged by the watermark that the last
batch had). ``split_writer`` applies the same rule to the rows themselves and keeps the late ones: a
side output that the count cannot give.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feeflow.functions import WATERMARK_DELAY, WINDOW_DURATION, ntz_to_instant

MARK = "at TIMESTAMP, batch_id BIGINT"


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MARK).parquet(path)


def create_marks(spark: SparkSession, path: str) -> None:
    """Make the table of newest event times readable before its first batch."""
    spark.createDataFrame([], "at TIMESTAMP").write.mode("ignore").parquet(f"{path}/batch_id=-1")


def split_writer(
    out: str, ts_col: str = "ts", duration: str = WINDOW_DURATION, delay: str = WATERMARK_DELAY, lag: int = 0
) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer that parts a batch into ``{out}/on_time`` and ``{out}/late``.

    A row is late when its window ended at or before the watermark of the batch; ``lag`` 1 leaves the
    last batch out of it, as Spark does for batches that follow one another. The newest event
    time of each batch is kept in ``{out}/marks`` (a row per batch), so a retried batch is parted as before
    and replaces its own rows. A row without a time is on time: no watermark can judge it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        create_marks(spark, f"{out}/marks")
        newest = read_marks(spark, f"{out}/marks").filter(F.col("batch_id") < batch_id - lag).agg(F.max("at").alias("at")).first()["at"]
        at = ntz_to_instant(ts_col)
        if newest is None:
            late = F.lit(False)
        else:
            watermark = F.lit(newest) - F.expr(f"INTERVAL {delay}")
            late = F.coalesce(F.window(at, duration).end <= watermark, F.lit(False))
        parted = batch.withColumn("late", late)
        parted.filter("not late").drop("late").write.mode("overwrite").parquet(f"{out}/on_time/batch_id={batch_id}")
        parted.filter("late").drop("late").write.mode("overwrite").parquet(f"{out}/late/batch_id={batch_id}")
        batch.agg(F.max(at).alias("at")).write.mode("overwrite").parquet(f"{out}/marks/batch_id={batch_id}")

    return write


def dropped_as_late(queries: list[StreamingQuery]) -> int:
    """Rows that stateful operators dropped behind the watermark, over all progress of the runs
    (an aggregation counts partial groups here, a deduplication rows)."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for q in queries for p in q.recentProgress for op in p["stateOperators"])


def state_rows(queries: list[StreamingQuery]) -> list[int]:
    """Rows held in state after each micro-batch of the runs."""
    return [sum(op["numRowsTotal"] for op in p["stateOperators"]) for q in queries for p in q.recentProgress if p["stateOperators"]]
