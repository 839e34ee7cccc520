"""Read the supplied parquet tables as transactions.

The supplied tables hold orders and their lines, not blockchain data. This module
maps them onto the transaction model:

    hash    <- o_orderkey (as text)
    time    <- o_orderdate, seconds since the epoch (UTC wall clock)
    size    <- sum(l_quantity) of the order, as bigint
    inputs  <- one per line: addr = l_suppkey, value = l_extendedprice in cents
    out     <- one per line: addr = l_partkey, value = l_extendedprice * (1 - l_discount) in cents

Money is converted to integer cents with integer arithmetic, so sums are exact and
every engine agrees.

Two shapes are offered:

* flat item relations (``table_items``, ``tx_header``) read straight
  from ``lineitem``: this is what the fee plan consumes, with no nesting step;
* nested documents (``tx_documents``) in the broker's schema, for the parsing,
  flattening and streaming operators. An order's lines are packed into documents
  of at most ``max_items`` lines each, so no single row (and no single task)
  ever has to hold an unbounded group, however large one order is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feeflow.functions import cents_of, discounted_cents_of, ntz_to_epoch_seconds
from feeflow.session import stored

# Fixed values of the mapping (constant document fields).
OP_UNCONFIRMED = "utx"
LOCK_TIME = 0
VERSION = 1
FINAL_SEQUENCE = 4294967295
RELAYED_BY = "0.0.0.0"
COIN_TYPE = 0
DEFAULT_MAX_ITEMS = 1000
# The lineitem columns a document carries; their hash spreads a big order's lines over parts.
DOC_LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table, as the scan gives it: no exchange in front of the plans built on it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tx_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tx_id, size, n_items: one row per order that has lines (partial aggregation before the shuffle)."""
    return (
        read_table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("tx_id"))
        .agg(
            F.sum("l_quantity").cast("bigint").alias("size"),
            F.count(F.lit(1)).alias("n_items"),
        )
    )


def tx_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tx_id, hash, time, size, n_items for every order that has lines."""
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("tx_id"),
        ntz_to_epoch_seconds("o_orderdate").alias("time"),
    )
    return orders.join(tx_sizes(spark, sf_dir), "tx_id").select(
        "tx_id",
        F.col("tx_id").cast("string").alias("hash"),
        "time",
        "size",
        "n_items",
    )


def table_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tx_id, is_input, addr, value, qty: every input and output, from one scan of lineitem.

    Each line yields one input and one output through a two-element generator, so
    the scan is shared instead of being read once per side and unioned. Keys stay
    numeric (text addresses are only produced where a result shows them); ``qty``
    rides on the input rows so that the size of a transaction falls out of the
    same aggregation as its totals.
    """
    li = read_table(spark, sf_dir, "lineitem")
    pair = F.array(
        F.struct(
            F.lit(True).alias("is_input"),
            F.col("l_suppkey").alias("addr"),
            cents_of("l_extendedprice").alias("value"),
            F.col("l_quantity").alias("qty"),
        ),
        F.struct(
            F.lit(False).alias("is_input"),
            F.col("l_partkey").alias("addr"),
            discounted_cents_of("l_extendedprice", "l_discount").alias("value"),
            F.lit(None).cast("double").alias("qty"),
        ),
    )
    return li.select(F.col("l_orderkey").alias("tx_id"), F.inline(pair))


def document_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tx_id, time, size, n_items and ``copies`` (equal orders of one key) of the documents, stored."""
    li = read_table(spark, sf_dir, "lineitem")
    stats = li.groupBy(F.col("l_orderkey").alias("tx_id")).agg(
        F.sum("l_quantity").cast("bigint").alias("size"), F.count(F.lit(1)).alias("n_items")
    )
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("tx_id"), ntz_to_epoch_seconds("o_orderdate").alias("time")
    )
    # Equal orders of one key give one document with their lines as often: ``copies``.
    header = orders.join(stats, "tx_id").groupBy("tx_id", "time", "size", "n_items").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    return stored(header, "tx_header")  # read several times


def tx_documents(spark: SparkSession, sf_dir: str, max_items: int = DEFAULT_MAX_ITEMS, header: DataFrame | None = None) -> DataFrame:
    """Transactions as broker documents: columns ``op`` and ``x`` (schema ``TX_DOC``).

    An order with at most ``max_items`` lines becomes one document. A bigger order
    is cut into ceil(lines / max_items) parts by a hash of each line, so every
    collected array holds about ``max_items`` elements whatever the order size,
    and the parts of a huge order are built by different tasks (the lines are
    grouped on (order, part), not on the order alone). Items keep the order
    in which they arrive; every result built on them is order-insensitive. ``header``: their
    ``document_header``, if the caller has it already.
    """
    li = read_table(spark, sf_dir, "lineitem")
    header = document_header(spark, sf_dir) if header is None else header
    n_parts = F.ceil(F.col("n_items") / F.lit(max_items))
    # Lines get their part before they are gathered: orders of several parts are few (at most one in
    # ``max_items`` lines) and written, so that Spark knows their size and mostly broadcasts them.
    # This join is on the key as text: after one on the key itself, grouping would need no exchange, and
    # AQE couldn't split a hot order's lines. Documents, not lines, meet the header.
    big = header.filter(n_parts > 1).select(F.col("tx_id").cast("string").alias("big_id"), n_parts.alias("n_parts")).distinct()
    big = stored(big.coalesce(1), "tx_big")
    line_hash = F.xxhash64(*[F.col(c) for c in DOC_LINE_COLUMNS])
    part = F.when(F.col("n_parts").isNull(), F.lit(0).cast("bigint")).otherwise(F.pmod(line_hash, F.col("n_parts")))
    lines = li.join(big, li["l_orderkey"].cast("string") == big["big_id"], "left").withColumn("line_part", part)
    # One flat struct per line is collected; the nested input and output structs are
    # built from the collected array afterwards (one collect instead of two, and
    # smaller aggregation buffers).
    line = F.struct(
        F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"),
        cents_of("l_extendedprice").alias("gross"),
        discounted_cents_of("l_extendedprice", "l_discount").alias("net"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("n"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
    )
    collected = lines.groupBy("l_orderkey", "line_part").agg(F.collect_list(line).alias("lines"))
    header = header.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), n_parts - 1)))
    parts = collected.join(header, (F.col("l_orderkey") == F.col("tx_id")) & (F.col("line_part") == F.col("part")))
    parts = parts.withColumn("lines", F.when(F.col("copies") == 1, F.col("lines")).otherwise(F.flatten(F.array_repeat("lines", F.col("copies")))))
    tx_input = lambda e: F.struct(
        F.lit(FINAL_SEQUENCE).cast("bigint").alias("sequence"),
        F.struct(
            F.lit(True).alias("spent"),
            e["partkey"].alias("tx_index"),
            F.lit(COIN_TYPE).cast("bigint").alias("type"),
            e["suppkey"].cast("string").alias("addr"),
            e["gross"].alias("value"),
            e["n"].alias("n"),
            e["flag"].alias("script"),
        ).alias("prev_out"),
        e["status"].alias("script"),
    )
    tx_output = lambda e: F.struct(
        F.lit(False).alias("spent"),
        F.col("tx_id").alias("tx_index"),
        F.lit(COIN_TYPE).cast("bigint").alias("type"),
        e["partkey"].cast("string").alias("addr"),
        e["net"].alias("value"),
        e["n"].alias("n"),
        e["status"].alias("script"),
    )
    parts = parts.select(
        "tx_id", "time", "size", "n_items",
        F.transform("lines", tx_input).alias("inputs"),
        F.transform("lines", tx_output).alias("out"),
    )
    return parts.select(
        F.lit(OP_UNCONFIRMED).alias("op"),
        F.struct(
            F.lit(LOCK_TIME).alias("lock_time"),
            F.lit(VERSION).alias("ver"),
            F.col("size"),
            F.col("inputs"),
            F.col("time"),
            F.col("tx_id").alias("tx_index"),
            F.col("n_items").alias("vin_sz"),
            F.col("tx_id").cast("string").alias("hash"),
            F.col("n_items").alias("vout_sz"),
            F.lit(RELAYED_BY).alias("relayed_by"),
            F.col("out"),
        ).alias("x"),
    )


def table_items_coarse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hash, size, time, side, addr, value: a second mapping, in which items repeat and fees have both signs.

    An input is worth 100 per unit at the return flag, an output that plus tax less discount in
    percent at the line status: lines of one order often agree in both, and the fee of a line,
    quantity times (discount - tax), is negative as often as not.
    """
    li = read_table(spark, sf_dir, "lineitem")
    qty, percent = F.col("l_quantity").cast("bigint"), lambda c: F.round(F.col(c) * 100).cast("bigint")
    pair = F.array(
        F.struct(F.lit("in").alias("side"), F.col("l_returnflag").alias("addr"), (qty * 100).alias("value")),
        F.struct(F.lit("out").alias("side"), F.col("l_linestatus").alias("addr"), (qty * (100 + percent("l_tax") - percent("l_discount"))).alias("value")),
    )
    # Lines are joined, not items: half the rows.
    lines = li.withColumnRenamed("l_orderkey", "tx_id").join(tx_header(spark, sf_dir), "tx_id")
    return lines.select("hash", "size", "time", F.inline(pair))
