"""The metrics table.

The original job kept running totals in complete-mode state and pushed a snapshot
{vol, trans_fees, total_hash} to a web service after every batch. Here each
micro-batch writes one *delta* row keyed by its ``batch_id``; a replayed batch
overwrites its own row, so the table stays exact under retries. The latest
snapshot is a single aggregation over the deltas (sum of counts, of rate
hundredths and of volume), not a scan of unbounded state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeflow.functions import PUBLISHED_RATE_DIGITS, coins_text, rate_cents
from feeflow.schemas import METRICS_DELTA


def metric_deltas(fees: DataFrame, batch_col: str | None = None, batch_id: int | None = None) -> DataFrame:
    """Per-batch delta rows: batch_id, n_tx, rate_cents, out_value.

    Either group a fee table by ``batch_col``, or collapse it into the single row
    of micro-batch ``batch_id`` (inside ``foreachBatch``).
    """
    aggs = [
        F.count(F.lit(1)).alias("n_tx"),
        F.coalesce(F.sum(rate_cents("fee_rate")), F.lit(0).cast("bigint")).alias("rate_cents"),
        F.coalesce(F.sum("out_total"), F.lit(0).cast("bigint")).alias("out_value"),
    ]
    if batch_col is not None:
        return fees.groupBy(F.col(batch_col).cast("bigint").alias("batch_id")).agg(*aggs)
    return fees.agg(*aggs).select(F.lit(batch_id).cast("bigint").alias("batch_id"), "n_tx", "rate_cents", "out_value")


def latest_snapshot(deltas: DataFrame) -> DataFrame:
    """K4: the cumulative snapshot after the latest batch (zeros when empty)."""
    n = F.coalesce(F.sum("n_tx"), F.lit(0).cast("bigint"))
    totals = deltas.agg(
        F.max("batch_id").alias("batch_id"),
        n.alias("total_hash"),
        F.try_divide(F.sum("rate_cents").cast("double"), n.cast("double") * 100.0).alias("mean_fee_rate"),
        F.coalesce(F.sum("out_value"), F.lit(0).cast("bigint")).alias("volume_sat"),
    )
    return totals.select(
        "batch_id",
        coins_text("volume_sat").alias("vol"),
        F.coalesce(F.round("mean_fee_rate", PUBLISHED_RATE_DIGITS), F.lit(0.0)).alias("trans_fees"),
        "total_hash",
    )


def write_delta(delta: DataFrame, table_path: str, batch_id: int) -> None:
    """Idempotent write of one batch's delta: it replaces partition batch_id=<id>."""
    delta.drop("batch_id").coalesce(1).write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")


def read_deltas(spark, table_path: str) -> DataFrame:
    return spark.read.schema(METRICS_DELTA).parquet(table_path)


def create_metrics(spark, table_path: str) -> None:
    """Make the metrics table readable before its first batch."""
    empty = spark.createDataFrame([], METRICS_DELTA).drop("batch_id")
    empty.write.mode("ignore").parquet(f"{table_path}/batch_id=-1")


def metric_change(before: DataFrame, after: DataFrame, batch_id: int) -> DataFrame:
    """The delta row of a batch that turned the fee table ``before`` into ``after``."""
    values = ["n_tx", "rate_cents", "out_value"]
    gone = metric_deltas(before, batch_id=batch_id).select("batch_id", *[(-F.col(v)).alias(v) for v in values])
    both = metric_deltas(after, batch_id=batch_id).unionByName(gone)
    return both.groupBy("batch_id").agg(*[F.sum(v).alias(v) for v in values])


def signed_change(fees: DataFrame, batch_id: int) -> DataFrame:
    """The same from one table: rows after the batch with ``sign`` 1, rows before it with -1."""
    of = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("bigint"))
    sums = fees.agg(
        of(F.col("sign")).alias("n_tx"), of(F.col("sign") * rate_cents("fee_rate")).alias("rate_cents"), of(F.col("sign") * F.col("out_total")).alias("out_value")
    )
    return sums.select(F.lit(batch_id).cast("bigint").alias("batch_id"), "n_tx", "rate_cents", "out_value")


# --- compaction ------------------------------------------------------------------------------
# ``{table}/_compacted/upto=<batch_id>`` holds the sum of all deltas up to a batch in one row. Its
# _SUCCESS marker, which the job writes last, makes it current in one step; a reader takes the newest
# marked one and the deltas after it, so before, during and after a compaction it sees the same totals.


def _complete_versions(spark, table_path: str) -> list[int]:
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{table_path}/_compacted")
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(base)]
    done = [n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{table_path}/_compacted/{n}/_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in done if n.startswith("upto="))


def read_current(spark, table_path: str) -> DataFrame:
    """The deltas of the table, those of compacted batches as one row."""
    upto = _complete_versions(spark, table_path)[-1:]
    recent = read_deltas(spark, table_path)
    if not upto:
        return recent
    compacted = spark.read.schema(METRICS_DELTA).parquet(f"{table_path}/_compacted/upto={upto[0]}")
    return compacted.unionByName(recent.filter(F.col("batch_id") > upto[0]))


def compact(spark, table_path: str) -> int | None:
    """Sum all deltas so far into a new version and delete what the version before it had summed; the
    batch summed up to (None: nothing to do). Run it from one place, e.g. after a batch.

    A reader of the version before still finds all it needs until the next compaction, so the table
    holds at most the deltas of two rounds. A compaction that breaks off leaves no marker and is made anew.
    """
    versions = _complete_versions(spark, table_path)
    before = versions[-1] if versions else -1
    current = read_current(spark, table_path)
    newest = current.agg(F.max("batch_id").alias("at")).first()["at"]
    if newest is None or newest <= before:
        return None
    sums = current.agg(F.max("batch_id").alias("batch_id"), *[F.sum(c).alias(c) for c in ("n_tx", "rate_cents", "out_value")])
    sums.coalesce(1).write.mode("overwrite").parquet(f"{table_path}/_compacted/upto={newest}")
    _delete_summed(spark, table_path, before, versions[:-1])
    return newest


def _delete_summed(spark, table_path: str, upto: int, old_versions: list[int]) -> None:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(table_path).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(path(table_path)):
        name = status.getPath().getName()
        if name.startswith("batch_id=") and 0 <= int(name.split("=")[1]) <= upto:
            fs.delete(status.getPath(), True)
    for v in old_versions:
        fs.delete(path(f"{table_path}/_compacted/upto={v}"), True)
