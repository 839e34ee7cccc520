"""Structured Streaming jobs.

Every job is a streaming DataFrame built from the same pure functions as the
batch plans, started with a checkpoint under the shared ``spark.checkpoint.dir``
so that a restarted driver or lost executor resumes exactly where it stopped.
Sinks are files (or ``foreachBatch`` writers that overwrite their own
``batch_id`` partition), so a replayed micro-batch never double-counts.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feeflow.functions import WATERMARK_DELAY, WINDOW_DURATION, epoch_to_instant, ntz_to_instant
from feeflow.operators.fees import doc_deltas, doc_items, item_totals, items_of_docs, totals_of_deltas, with_fees
from feeflow.operators.flatten import flatten
from feeflow.operators.windows import utc_bounds
from feeflow.session import rocksdb_state, scratch_path, stored
from feeflow.sources.broker import accepted, rejected
from feeflow.sources.files import read_json_stream, read_parquet_stream
from feeflow.streaming.metrics import metric_change, write_delta

DEFAULT_TIMEOUT_S = 1800
# Transactions whose rows are picked from the item log by a broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
# Rows of the delta table: totals of a whole document, or one item of a part.
FEE_DELTA = "hash STRING, size BIGINT, digest BIGINT, is_input BOOLEAN, addr STRING, value BIGINT, in_total BIGINT, out_total BIGINT"


# --- running -------------------------------------------------------------------------------


def start(
    df: DataFrame,
    name: str,
    *,
    sink_path: str | None = None,
    checkpoint: str | None = None,
    mode: str = "append",
    fmt: str = "parquet",
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    trigger: dict | None = None,
    unbounded_state: bool = False,
) -> StreamingQuery:
    """Start a stream (K1, K6-K9).

    ``trigger`` is passed to ``DataStreamWriter.trigger``: ``{"availableNow": True}``
    (default: drain what is there, then stop) or e.g. ``{"processingTime": "5 seconds"}``
    for a live job. The checkpoint defaults to a fresh folder under the shared
    checkpoint directory. ``unbounded_state``: keep the state in RocksDB whatever the session
    says, for state processors and for state that nothing evicts.
    """
    spark = df.sparkSession
    writer = df.writeStream.queryName(name).outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint or scratch_path(spark, f"streams/{name}"))
    if foreach_batch is not None:
        writer = writer.foreachBatch(foreach_batch)
    else:
        writer = writer.format(fmt)
        if sink_path:
            writer = writer.option("path", sink_path)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    with rocksdb_state(spark) if unbounded_state else nullcontext():
        return writer.start()


def await_done(query: StreamingQuery, timeout_s: int = DEFAULT_TIMEOUT_S) -> None:
    """Block until the query stops; raise if it failed or did not finish in time."""
    finished = query.awaitTermination(timeout_s)
    if not finished:
        query.stop()
        raise TimeoutError(f"stream {query.name} did not finish within {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(f"stream {query.name} failed: {query.exception()}")


def run(df: DataFrame, name: str, timeout_s: int = DEFAULT_TIMEOUT_S, **kwargs) -> StreamingQuery:
    q = start(df, name, **kwargs)
    await_done(q, timeout_s)
    return q


def run_until_drained(df: DataFrame, name: str, interval: str = "1 second", **kwargs) -> StreamingQuery:
    """K9: a stream on a processing-time trigger that is stopped once it has read all there is."""
    q = start(df, name, trigger={"processingTime": interval}, **kwargs)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return q


def console(df: DataFrame, name: str = "console", mode: str = "append") -> StreamingQuery:
    """K2: debug sink printing every batch in full."""
    return df.writeStream.queryName(name).outputMode(mode).format("console").option("truncate", "false").start()


# --- sources ---------------------------------------------------------------------------------
# The stream readers live with the other sources; these names keep the job code short.

json_doc_stream = read_json_stream
parquet_stream = read_parquet_stream


# --- the fee stream ----------------------------------------------------------------------------


def item_log_writer(table_path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of the deduplicated item log.

    Each micro-batch writes a row per distinct document (``doc_items``: its distinct inputs and
    outputs, nested, with their digest and sums) into partition ``batch_id=<id>`` with overwrite, so
    a retried batch replaces its own output instead of adding to it. Items travel inside their
    document, which says hash and size once and not with every item.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        doc_items(batch).write.mode("overwrite").option("compression", "zstd").parquet(f"{table_path}/batch_id={batch_id}")

    return write


def fees_from_item_log(spark: SparkSession, table_path: str) -> DataFrame:
    """Fee table over everything logged so far (the complete-mode result, K6).

    Items are distinct across batches too, so a transaction redelivered in a later
    batch, or split over several batches, still counts exactly once. Where all documents of a
    transaction have the same items, their sums are its totals, and the items needn't be read.
    The others, cut into parts or with contents that differ, go item by item: the distinct
    shuffles on the whole item, so a huge transaction spreads over all reducers.
    """
    log = spark.read.parquet(table_path).drop("batch_id")
    one = lambda c: F.max(c).alias(c)
    known = stored(log.groupBy("hash", "size").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"), one("in_total"), one("out_total")), "known_totals")
    totals = known.filter("lo = hi").select("hash", "size", "in_total", "out_total")
    several = known.filter("lo <> hi").select(F.col("hash").alias("__hash"), F.col("size").alias("__size"))
    n = several.count()
    if n:
        same = F.col("hash").eqNullSafe(F.col("__hash")) & F.col("size").eqNullSafe(F.col("__size"))
        rows = log.join(F.broadcast(several) if n <= BROADCAST_ROWS else several, same, "left_semi")
        totals = totals.unionByName(item_totals(items_of_docs(rows)))
    return with_fees(totals).select("hash", "size", "in_total", "out_total", "fee", "fee_rate")


def fee_delta_writer(table_path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of what each document adds to its transaction (the incremental variant).

    Each batch writes the rows of ``doc_deltas`` keyed by batch_id, folded inside the row: the
    batch job has no shuffle at all. Nothing is dropped as late: copies of a document, in one
    batch or in several, are equal rows and count once on read (``fees_from_deltas``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        doc_deltas(batch).write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")

    return write


def create_deltas(spark: SparkSession, table_path: str) -> None:
    """Make the delta table readable before its first batch."""
    spark.createDataFrame([], FEE_DELTA).write.mode("ignore").parquet(f"{table_path}/batch_id=-1")


def fees_from_deltas(spark: SparkSession, table_path: str) -> DataFrame:
    """Fee table over all batches: equal rows once, one aggregation per (hash, size), then the fee."""
    deltas = spark.read.schema(FEE_DELTA).parquet(table_path).drop("batch_id")
    return with_fees(totals_of_deltas(deltas)).select("hash", "size", "in_total", "out_total", "fee", "fee_rate")


def metrics_writer(log_path: str, table_path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of one metrics row per micro-batch (K3, T7): what it changed in the totals.

    The batch logs its deltas; the fees of the transactions it touches, with and without them,
    give the change. A document redelivered in any later batch changes nothing, and a retried
    batch replaces its own row. Each batch reads the log's rows once, filtered by the touched
    transactions; where that is too much, log deltas only and sum them when read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        doc_deltas(batch).write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")
        log = spark.read.schema(f"{FEE_DELTA}, batch_id BIGINT").parquet(log_path)
        touched = log.filter(F.col("batch_id") == batch_id).select(
            F.col("hash").alias("__hash"), F.col("size").alias("__size")
        )
        same = F.col("hash").eqNullSafe(F.col("__hash")) & F.col("size").eqNullSafe(F.col("__size"))
        rows = log.filter(F.col("batch_id") <= batch_id).join(touched.distinct(), same, "left_semi")
        after = with_fees(totals_of_deltas(rows.drop("batch_id")))
        before = with_fees(totals_of_deltas(rows.filter(F.col("batch_id") < batch_id).drop("batch_id")))
        write_delta(metric_change(before, after, batch_id), table_path, batch_id)

    return write


def outcome_writer(out: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of checked payloads: good ones to ``{out}/good``, dead letters to ``{out}/dead``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        accepted(batch).write.mode("overwrite").parquet(f"{out}/good/batch_id={batch_id}")
        rejected(batch).write.mode("overwrite").parquet(f"{out}/dead/batch_id={batch_id}")

    return write


def with_doc_event_time(tx: DataFrame) -> DataFrame:
    """Event time of a transaction document: its ``time`` (epoch s) as a TIMESTAMP."""
    return tx.withColumn("event_time", epoch_to_instant("time"))


def with_doc_digest(tx: DataFrame) -> DataFrame:
    """Add ``doc_digest``: of hash, size and the distinct (addr, value, n) of both sides in any
    order. Copies of a document agree in it even if items are reordered or ``spent`` changed;
    parts of one transaction differ by their positions ``n``."""
    ins = F.transform("inputs", lambda i: F.struct(i["prev_out"]["addr"].alias("a"), i["prev_out"]["value"].alias("v"), i["prev_out"]["n"].alias("n")))
    outs = F.transform("out", lambda o: F.struct(o["addr"].alias("a"), o["value"].alias("v"), o["n"].alias("n")))
    ordered = [F.array_sort(F.array_distinct(x)) for x in (ins, outs)]
    return tx.withColumn("doc_digest", F.xxhash64("hash", "size", *ordered))


def doc_log_writer(table_path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of one row per document: header, item counts and digest, by batch_id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = with_doc_digest(batch).select(
            "hash", "size", "time", "doc_digest", F.size("inputs").alias("n_inputs"), F.size("out").alias("n_outputs")
        )
        rows.write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")

    return write


def transactions_from_doc_log(spark: SparkSession, table_path: str) -> DataFrame:
    """T5 without drops: hash, size, time, n_inputs, n_outputs of every transaction logged, copies
    of a document once and the parts of a transaction together."""
    once = spark.read.parquet(table_path).dropDuplicates(["hash", "doc_digest"])
    return once.groupBy("hash", "size", "time").agg(
        F.sum("n_inputs").cast("int").alias("n_inputs"), F.sum("n_outputs").cast("int").alias("n_outputs")
    )


def dedup_documents(tx: DataFrame, delay: str) -> DataFrame:
    """T5 with bounded state: drop redelivered documents within the watermark.

    An explicit choice: a document older than the watermark is dropped as late, first
    deliveries included (``numRowsDroppedByWatermark`` of the progress counts them), so
    ``delay`` must cover the disorder of the source. The delta and log tables need no drop.
    State is evicted once the watermark passes, instead of growing forever.
    """
    keyed = with_doc_digest(with_doc_event_time(tx))
    return keyed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["hash", "doc_digest"])


# --- windows ----------------------------------------------------------------------------------


def event_window_counts(
    events: DataFrame,
    duration: str = WINDOW_DURATION,
    delay: str | None = WATERMARK_DELAY,
    ts_col: str = "ts",
) -> DataFrame:
    """T1 + T2: events per window; the watermark sits *before* the aggregation.

    With the watermark in front, append mode is allowed, late rows are dropped
    and state for closed windows is evicted. The ``ts`` column of the events
    table is timestamp_ntz; it is converted zone-free to an instant first.
    """
    df = events.withColumn("event_time", ntz_to_instant(ts_col))
    if delay:
        df = df.withWatermark("event_time", delay)
    grouped = df.groupBy(F.window("event_time", duration).alias("window")).agg(F.count(F.lit(1)).alias("count"))
    return utc_bounds(grouped)


ITEM_COLUMNS = ["hash", "side", "addr", "value", "size"]


def windowed_items(tx: DataFrame, duration: str = WINDOW_DURATION, delay: str = WATERMARK_DELAY) -> DataFrame:
    """T1 + T3 + A1 on a stream of transactions: multiplicity of each item per window, append mode.

    The state is keyed by the whole item and evicted behind the watermark, which sits in front
    of the group (the original had it behind, so its state only grew).
    """
    items = flatten(with_doc_event_time(tx), header=["hash", "size", "event_time"], items=["side", "addr", "value"])
    grouped = items.withWatermark("event_time", delay).groupBy(F.window("event_time", duration).alias("window"), *ITEM_COLUMNS)
    return grouped.agg(F.count(F.lit(1)).alias("count"))


def windowed_transactions(items: DataFrame, duration: str = WINDOW_DURATION) -> DataFrame:
    """Of ``windowed_items``, chained in the same query: distinct items, deliveries and the sums of the
    distinct items per window and transaction."""
    of = lambda side, name: F.sum(F.when(F.col("side") == side, F.col("value"))).alias(name)
    again = items.groupBy(F.window(F.window_time("window"), duration).alias("window"), "hash", "size")
    return again.agg(F.count(F.lit(1)).alias("n_items"), F.sum("count").alias("n_deliveries"), of("in", "in_total"), of("out", "out_total"))


def snapshot_writer(table_path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of the rows a batch emits, partitioned by batch_id.

    In update mode a batch emits the windows it changed; in complete mode, all.
    Reading back the row of the latest batch per key gives the settled result.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")

    return write


def latest_per_key(spark: SparkSession, table_path: str, keys: list[str]) -> DataFrame:
    """For each key, the values of the row written by the latest batch."""
    df = spark.read.parquet(table_path)
    values = [c for c in df.columns if c not in keys and c != "batch_id"]
    latest = F.max_by(F.struct(*values), F.col("batch_id")).alias("v")
    return df.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"v.{c}").alias(c) for c in values])


__all__ = [
    "await_done",
    "console",
    "create_deltas",
    "dedup_documents",
    "doc_log_writer",
    "event_window_counts",
    "fee_delta_writer",
    "fees_from_deltas",
    "fees_from_item_log",
    "item_log_writer",
    "json_doc_stream",
    "latest_per_key",
    "metrics_writer",
    "outcome_writer",
    "parquet_stream",
    "run",
    "run_until_drained",
    "snapshot_writer",
    "start",
    "transactions_from_doc_log",
    "windowed_items",
    "windowed_transactions",
    "with_doc_digest",
    "with_doc_event_time",
]
