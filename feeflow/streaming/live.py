"""Live totals with keyed state.

Two streams, neither of which reads anything but its own new rows:

1. ``increments_job``: items that were never seen, found by Spark's own deduplication with its state
   keyed by the whole item, so one transaction with very many items spreads over all tasks. Each
   micro-batch writes one row per transaction that it adds to: the sums of its new items.
2. ``totals_job``: keyed state holds each transaction's totals; they are emitted before and after, and
   from these follows what the batch changed in the live metrics, one row per batch. The state is that
   of a plain aggregation; only totals with a time to live need a state processor in Python.

A redelivered document has no new item, so it makes no row at all, in any later batch. The work
of a batch depends on its own rows, not on how many batches there were.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from feeflow.functions import rate_cents
from feeflow.operators.fees import with_fees
from feeflow.operators.flatten import flatten
from feeflow.sources.files import read_parquet_stream
from feeflow.streaming.jobs import start, with_doc_event_time
from feeflow.streaming.metrics import create_metrics, signed_change, write_delta

INCREMENT = "hash STRING, size BIGINT, in_new BIGINT, out_new BIGINT"
TOTALS = "in_total BIGINT, out_total BIGINT"
CHANGE = "hash STRING, size BIGINT, known BOOLEAN, in_before BIGINT, out_before BIGINT, in_total BIGINT, out_total BIGINT"
ITEM_KEY = ["hash", "size", "side", "addr", "value"]
# Increments of a micro-batch are summed in this many groups, of whole transactions each.
SUM_GROUPS = 1024

# What runs in workers goes there with its code: the one that Spark starts beside the driver
# has neither the driver's ``sys.path`` nor the files that were added to the session.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def new_items(tx: DataFrame, keep: str | None = None) -> DataFrame:
    """Items (hash, size, side, addr, value) of a stream of transactions, each once.

    Without ``keep`` an item is remembered for good. With it (e.g. "7 days" of event time) state is
    bounded: items older than the newest by more than ``keep`` are dropped, first deliveries included.
    """
    items = ["side", "addr", "value"]
    if keep is None:
        return flatten(tx, header=["hash", "size"], items=items).dropDuplicates(ITEM_KEY)
    timed = flatten(with_doc_event_time(tx), header=["hash", "size", "event_time"], items=items)
    return timed.withWatermark("event_time", keep).dropDuplicatesWithinWatermark(ITEM_KEY)


def increment_writer(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of a row per transaction and batch: sums of the items new in it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        of = lambda side, name: F.sum(F.when(F.col("side") == side, F.col("value"))).alias(name)
        sums = batch.groupBy("hash", F.col("size").cast("bigint").alias("size")).agg(of("in", "in_new"), of("out", "out_new"))
        sums.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


class TransactionTotals(StatefulProcessor):
    """Totals of one transaction (key: hash, size), with an optional time to live."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", TOTALS, self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = self.totals.get()
        now = list(before or (None, None))
        for row in rows:
            for i, new in enumerate((row.in_new, row.out_new)):
                if new is not None:
                    now[i] = (now[i] or 0) + new
        self.totals.update(tuple(now))
        old = before or (None, None)
        yield Row(hash=key[0], size=key[1], known=before is not None, in_before=old[0], out_before=old[1], in_total=now[0], out_total=now[1])

    def close(self) -> None:
        pass


def batch_sums(increments: pa.Table) -> pa.Table:
    """A row per transaction: its increments in this micro-batch summed, and the batch's number ``at``."""
    at = int(TaskContext.get().getLocalProperty("streaming.sql.batchId"))
    wide = [increments[c].cast(pa.decimal128(38, 0)) for c in ("in_new", "out_new")]  # a sum beyond bigint fails when cast back
    sums = pa.table([increments["hash"], increments["size"], *wide], ["hash", "size", "i", "o"])
    sums = sums.group_by(["hash", "size"], use_threads=False).aggregate([("i", "sum"), ("o", "sum")])
    back = [sums[c].cast(pa.int64()) for c in ("i_sum", "o_sum")]
    return pa.table([sums["hash"], sums["size"], *back, pa.array([at] * len(sums), pa.int64())], ["hash", "size", "in_new", "out_new", "at"])


def _aggregated_changes(increments: DataFrame) -> DataFrame:
    """``total_changes`` without a time to live, in update mode: state and its updates stay in Spark.

    After ``batch_sums`` a transaction has one row per micro-batch it is in, so the newest row is what
    the batch adds, the sums without it are the totals before, and the count of rows says if there were any.
    """
    group = F.pmod(F.xxhash64("hash", "size"), F.lit(SUM_GROUPS)).alias("sum_group")
    rows = increments.groupBy(group).applyInArrow(batch_sums, f"{INCREMENT}, at BIGINT")
    names = {"in": "in_new", "out": "out_new"}
    state = rows.groupBy("hash", "size").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("at", *names.values())).alias("last"),
        *[F.sum(c).alias(f"{side}_total") for side, c in names.items()], *[F.count(c).alias(f"n_{side}") for side, c in names.items()],
    )

    def before(side: str) -> Column:
        last = F.col(f"last.{names[side]}")
        earlier = F.col(f"n_{side}") > F.when(last.isNull(), 0).otherwise(1)
        return F.when(earlier, F.col(f"{side}_total") - F.coalesce(last, F.lit(0))).alias(f"{side}_before")

    return state.select("hash", "size", (F.col("n") > 1).alias("known"), before("in"), before("out"), "in_total", "out_total")


def total_changes(increments: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """Totals of each touched transaction before (``known``: if there were any) and after; append mode
    with a time to live, else update mode."""
    if ttl_ms is None:
        return _aggregated_changes(increments)
    return increments.groupBy("hash", "size").transformWithState(
        TransactionTotals(ttl_ms), outputStructType=CHANGE, outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None"
    )


def _signed_fees(changes: DataFrame) -> DataFrame:
    """The fee tables of the touched transactions after (``sign`` 1) and before the batch (-1), as one:
    the state, whose rows they are, is updated once per batch."""
    after = F.struct(F.lit(1).cast("bigint").alias("sign"), "in_total", "out_total")
    before = F.struct(F.lit(-1).cast("bigint").alias("sign"), F.col("in_before").alias("in_total"), F.col("out_before").alias("out_total"))
    both = F.when(F.col("known"), F.array(after, before)).otherwise(F.array(after))
    return with_fees(changes.select("hash", "size", F.inline(both)))


def change_writer(table_path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of the metrics row of a batch, from its ``total_changes``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_delta(signed_change(_signed_fees(batch), batch_id), table_path, batch_id)

    return write


# Sums from which means, deviations and the correlation follow; a transaction that changes takes its
# old part out again, which sums of whole numbers allow exactly.
POWER_SUMS = {
    "n": "1", "size1": "size", "size2": "size * size", "fee1": "fee", "fee2": "fee * fee", "rate1": "cents", "rate2": "cents * cents", "size_rate": "size * cents",
}
SUM_TYPE = "decimal(38,0)"


def profile_writer(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of what a batch changes in the power sums (A10, A17), one row per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        fees = _signed_fees(batch)
        exact = fees.select("sign", *[F.col(c).cast("decimal(19,0)").alias(c) for c in ("size", "fee")], rate_cents("fee_rate").cast("decimal(19,0)").alias("cents"))
        of = lambda e: F.sum(F.expr(f"if(sign > 0, cast({e} as {SUM_TYPE}), cast(-({e}) as {SUM_TYPE}))"))
        change = exact.agg(*[F.coalesce(of(e), F.lit(0)).cast(SUM_TYPE).alias(c) for c, e in POWER_SUMS.items()])
        change.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def profile(spark: SparkSession, path: str) -> DataFrame:
    """Count, means, sample deviations and the correlation of size and fee rate after all batches."""
    schema = ", ".join(f"{c} {SUM_TYPE}" for c in POWER_SUMS)
    total = spark.read.schema(schema).parquet(path).agg(*[F.sum(c).cast("double").alias(c) for c in POWER_SUMS])
    mean = lambda c: F.try_divide(F.col(f"{c}1"), F.col("n"))
    spread = lambda c: F.col(f"{c}2") - F.col("n") * mean(c) * mean(c)
    deviation = lambda c: F.sqrt(F.try_divide(spread(c), F.col("n") - 1))
    together = F.col("size_rate") - F.col("n") * mean("size") * mean("rate")
    return total.select(
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        F.round(mean("size"), 6).alias("mean_size"), F.round(deviation("size"), 6).alias("sd_size"),
        F.round(mean("fee"), 4).alias("mean_fee"), F.round(deviation("fee"), 4).alias("sd_fee"),
        F.round(mean("rate") / 100, 6).alias("mean_fee_rate"), F.round(deviation("rate") / 100, 6).alias("sd_fee_rate"),
        F.round(F.try_divide(together, F.sqrt(spread("size") * spread("rate"))), 6).alias("corr_size_fee_rate"),
    )


def increments_job(tx: DataFrame, out: str, keep: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Stream 1, from transactions to ``{out}/increments``."""
    return start(new_items(tx, keep), "live_increments", foreach_batch=increment_writer(f"{out}/increments"), checkpoint=f"{out}/_checkpoints/increments", trigger=trigger, unbounded_state=True)


def totals_job(
    spark: SparkSession, out: str, ttl_ms: int | None = None, trigger: dict | None = None, max_files: int | None = None,
    writer: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Stream 2, from ``{out}/increments`` to the metrics table ``{out}/metrics``, or to another
    ``writer`` of ``total_changes``."""
    create_metrics(spark, f"{out}/metrics")
    increments = read_parquet_stream(spark, f"{out}/increments", INCREMENT, max_files_per_trigger=max_files)
    return start(
        total_changes(increments, ttl_ms), "live_totals", mode="append" if ttl_ms is not None else "update", foreach_batch=writer or change_writer(f"{out}/metrics"),
        checkpoint=f"{out}/_checkpoints/totals", trigger=trigger, unbounded_state=True,
    )
