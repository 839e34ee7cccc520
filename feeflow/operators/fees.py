"""Fee computation.

For each transaction: fee = sum of its distinct inputs - sum of its distinct
outputs, fee rate = fee / size rounded half-even to 2 digits, and only rates >= 0
are kept. "Distinct" is the original job's rule: two inputs with the same address
and value count once (and a redelivered transaction counts once).

Three plans compute the same table:

* ``fee_table`` - relational, over the long item relation: one distinct and one
  conditional sum per transaction, no join. The distinct shuffles on the full
  item key, so even a transaction holding a third of all items spreads over every
  reducer; the per-transaction sum is then pre-aggregated map-side.
* ``fee_table_rowlocal`` - a fold over the arrays of each document inside one
  projection: no generator, no item-level shuffle.
* the pieces in the original job's shape (``distinct_inputs`` ... ``join_totals``) that keep
  the separate input and output branches joined on the hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feeflow.functions import coins_text, fee, fee_rate, rate_cents


def item_totals(items: DataFrame, keys: Sequence[str] = ("hash", "size"), distinct: bool = True) -> DataFrame:
    """Per-transaction sums of inputs and outputs from the long item relation.

    ``items`` has ``keys`` plus is_input/addr/value. With ``distinct`` (the default),
    equal (is_input, addr, value) items of one transaction count once; without it
    every item counts (use it only on deduplicated documents).
    """
    base = items.select(*keys, "is_input", "addr", "value")
    if distinct:
        base = base.distinct()
    return base.groupBy(*keys).agg(
        F.sum(F.when(F.col("is_input"), F.col("value"))).alias("in_total"),
        F.sum(F.when(~F.col("is_input"), F.col("value"))).alias("out_total"),
    )


def with_fees(totals: DataFrame, keep_negative: bool = False) -> DataFrame:
    """Add fee and fee_rate and keep non-negative rates (F1).

    The filter runs after rounding, so -0.004 sat/B rounds to 0.0 and is kept; a
    NULL rate (missing side, NULL or zero size) is dropped.
    """
    out = totals.withColumn("fee", fee("in_total", "out_total")).withColumn("fee_rate", fee_rate("fee", "size"))
    return out if keep_negative else out.filter(F.col("fee_rate") >= 0)


def fee_table(items: DataFrame, distinct: bool = True) -> DataFrame:
    """hash, size, in_total, out_total, fee, fee_rate from items keyed by (hash, size)."""
    return with_fees(item_totals(items, ("hash", "size"), distinct)).select(
        "hash", "size", "in_total", "out_total", "fee", "fee_rate"
    )


def totals_with_size(items: DataFrame, distinct: bool = True) -> DataFrame:
    """tx_id, size, in_total, out_total from items that carry ``qty`` on input rows.

    Two aggregations and no join: the first collapses equal items of a transaction
    (shuffling on the full item key, so a huge transaction still spreads over all
    reducers) and adds up their quantities; the second, pre-aggregated map-side,
    gives the totals and the size (the sum of all input quantities).
    """
    keys = ["tx_id", "is_input", "addr", "value"]
    per_item = items.groupBy(*keys).agg(F.sum("qty").alias("qty"), F.count(F.lit(1)).alias("copies"))
    if not distinct:
        per_item = per_item.withColumn("value", F.col("value") * F.col("copies"))
    return per_item.groupBy("tx_id").agg(
        F.sum("qty").cast("bigint").alias("size"),
        F.sum(F.when(F.col("is_input"), F.col("value"))).alias("in_total"),
        F.sum(F.when(~F.col("is_input"), F.col("value"))).alias("out_total"),
    )


def fee_table_by_id(items: DataFrame, distinct: bool = True, extra: DataFrame | None = None) -> DataFrame:
    """The fee table when items carry a numeric ``tx_id`` and quantities.

    The text hash is derived only at the end. ``extra`` (tx_id plus further
    per-transaction columns, e.g. time) is joined on when a result needs it.
    """
    fees = with_fees(totals_with_size(items, distinct))
    cols = [F.col("tx_id").cast("string").alias("hash"), "size", "in_total", "out_total", "fee", "fee_rate"]
    if extra is None:
        return fees.select(*cols)
    return fees.join(extra, "tx_id").select(*cols, *[c for c in extra.columns if c != "tx_id"])


# --- row-local plan ----------------------------------------------------------------


def _null_aware_sum(values: Column) -> Column:
    """Sum of an array of bigint like SQL ``sum``: NULLs skipped, NULL when none is set."""
    return F.aggregate(
        values,
        F.lit(None).cast("bigint"),
        lambda acc, v: F.when(v.isNull(), acc).otherwise(F.coalesce(acc, F.lit(0).cast("bigint")) + v),
    )


def _doc_sides(distinct: bool) -> tuple[Column, Column]:
    """The (addr, value) arrays of a document's inputs and outputs."""
    ins = F.transform("inputs", lambda i: F.struct(i["prev_out"]["addr"].alias("addr"), i["prev_out"]["value"].alias("value")))
    outs = F.transform("out", lambda o: F.struct(o["addr"].alias("addr"), o["value"].alias("value")))
    return (F.array_distinct(ins), F.array_distinct(outs)) if distinct else (ins, outs)


def _side_total(pairs: Column) -> Column:
    return _null_aware_sum(F.transform(pairs, lambda p: p["value"]))


def _both_sides() -> Column:
    return (F.size("inputs") > 0) & (F.size("out") > 0)


def doc_totals(tx: DataFrame, distinct: bool = True) -> DataFrame:
    """hash, size, in_total, out_total of each document, computed inside the row."""
    ins, outs = _doc_sides(distinct)
    return tx.filter(_both_sides()).select(
        "hash", "size", _side_total(ins).alias("in_total"), _side_total(outs).alias("out_total")
    )


def doc_items(tx: DataFrame) -> DataFrame:
    """hash, size, in_addr, in_value, out_addr, out_value: the distinct (addr, value) of both sides of each
    distinct document, in order, as arrays side by side; with their ``digest`` and the sums in_total
    and out_total. A document with an empty side has no row."""
    ins, outs = (F.array_sort(side) for side in _doc_sides(True))
    sides = tx.filter(_both_sides()).select("hash", "size", ins.alias("ins"), outs.alias("outs"))
    flat = sides.select("hash", "size", *[F.col(f"{side}s.{c}").alias(f"{side}_{c}") for side in ("in", "out") for c in ("addr", "value")])
    once = flat.distinct()
    digest = F.xxhash64("in_addr", F.lit(0), "in_value", F.lit(0), "out_addr", F.lit(0), "out_value")
    totals = [_null_aware_sum(F.col(f"{side}_value")).alias(f"{side}_total") for side in ("in", "out")]
    return once.select("*", digest.alias("digest"), *totals)


def items_of_docs(docs: DataFrame) -> DataFrame:
    """hash, size, is_input, addr, value of the rows of ``doc_items``."""
    of = lambda side, is_input: F.transform(
        F.arrays_zip(F.col(f"{side}_addr").alias("addr"), F.col(f"{side}_value").alias("value")),
        lambda p: F.struct(F.lit(is_input).alias("is_input"), p["addr"].alias("addr"), p["value"].alias("value")),
    )
    return docs.select("hash", "size", F.inline(F.concat(of("in", True), of("out", False))))


def _delta(digest=None, is_input=None, addr=None, value=None, in_total=None, out_total=None) -> Column:
    cols = {
        "digest": (digest, "bigint"),
        "is_input": (is_input, "boolean"),
        "addr": (addr, "string"),
        "value": (value, "bigint"),
        "in_total": (in_total, "bigint"),
        "out_total": (out_total, "bigint"),
    }
    return F.struct(*[(F.lit(None) if c is None else c).cast(t).alias(n) for n, (c, t) in cols.items()])


def doc_deltas(tx: DataFrame) -> DataFrame:
    """What a document adds to its transaction: hash, size and the columns of ``_delta``.

    A whole document (it holds all ``vin_sz`` inputs and ``vout_sz`` outputs) becomes one row
    of totals with a digest of its distinct (addr, value) pairs, whatever their order. A part of
    a transaction, or a document that doesn't say how many items there are, becomes one row per
    distinct item. Equal rows mean the same content, so ``totals_of_deltas`` gives the same
    totals however a transaction was cut and however often it was delivered.
    """
    ins, outs = _doc_sides(True)
    whole = (F.col("vin_sz") == F.size("inputs")) & (F.col("vout_sz") == F.size("out"))
    digest = F.xxhash64(F.array_sort(ins), F.array_sort(outs))
    folded = F.array(_delta(digest=digest, in_total=_side_total(ins), out_total=_side_total(outs)))
    items = F.concat(
        F.transform(ins, lambda p: _delta(is_input=F.lit(True), addr=p["addr"], value=p["value"])),
        F.transform(outs, lambda p: _delta(is_input=F.lit(False), addr=p["addr"], value=p["value"])),
    )
    rows = F.when(whole, folded).otherwise(items)
    return tx.filter(_both_sides()).select("hash", F.col("size").cast("bigint").alias("size"), F.inline(rows))


def totals_of_deltas(deltas: DataFrame) -> DataFrame:
    """hash, size, in_total, out_total from rows of ``doc_deltas``, equal rows counting once.

    The distinct shuffles on the whole row, so the items of one huge transaction spread over
    all reducers. A transaction arrives either whole or in parts; its content never changes
    under one hash.
    """
    of = lambda total, is_input: F.sum(
        F.when(F.col("digest").isNotNull(), F.col(total)).when(F.col("is_input") == F.lit(is_input), F.col("value"))
    ).alias(total)
    return deltas.distinct().groupBy("hash", "size").agg(of("in_total", True), of("out_total", False))


def fee_table_rowlocal(tx: DataFrame, distinct: bool = True, whole_documents: bool = False) -> DataFrame:
    """Fee table by folding each document's arrays inside the row (no item shuffle for whole documents).

    Parts of big transactions (the table adapter cuts them) go by their items, and copies
    of a document count once, so the table equals ``fee_table``'s. ``whole_documents`` is for a
    deduplicated stream of complete transactions: no generator and no shuffle. Without
    ``distinct`` every item of every document counts.
    """
    if whole_documents:
        totals = doc_totals(tx, distinct)
    elif distinct:
        totals = totals_of_deltas(doc_deltas(tx))
    else:
        totals = doc_totals(tx, False).groupBy("hash", "size").agg(
            F.sum("in_total").alias("in_total"), F.sum("out_total").alias("out_total")
        )
    return with_fees(totals).select("hash", "size", "in_total", "out_total", "fee", "fee_rate")


# --- pieces in the original job's shape ----------------------------------------------


def distinct_inputs(inputs: DataFrame) -> DataFrame:
    """A2 + A4: distinct (hash, in_addr, in_value, size) of exploded inputs."""
    return inputs.select("hash", "in_addr", "in_value", "size").distinct()


def distinct_outputs(outputs: DataFrame) -> DataFrame:
    """A3: distinct (hash, out_addr, out_value, size) of exploded outputs."""
    return outputs.select("hash", "out_addr", "out_value", "size").distinct()


def input_totals(dist_inputs: DataFrame) -> DataFrame:
    """A5: hash, trans_size, in_total."""
    return dist_inputs.groupBy("hash", F.col("size").alias("trans_size")).agg(F.sum("in_value").alias("in_total"))


def output_totals(dist_outputs: DataFrame) -> DataFrame:
    """Hash, size, out_total."""
    return dist_outputs.groupBy("hash", "size").agg(F.sum("out_value").alias("out_total"))


def join_totals(in_totals: DataFrame, out_totals: DataFrame) -> DataFrame:
    """Input and output totals of the same transaction side by side.

    The key is (hash, size), not the hash alone: a hash seen with two sizes would
    otherwise pair every input size with every output size.
    """
    i = in_totals.withColumnRenamed("trans_size", "size")
    return i.join(out_totals, ["hash", "size"]).select("hash", "size", "in_total", "out_total")


def sum_distinct_inputs(inputs: DataFrame) -> DataFrame:
    """Per transaction, the sum of distinct input values."""
    return inputs.groupBy("hash").agg(F.sum_distinct("in_value").alias("sum_distinct_in"))


# --- summaries -------------------------------------------------------------------------


def fee_summary(fees: DataFrame) -> DataFrame:
    """A7 + A8 + A13 in one pass: transactions kept, mean fee rate, output volume.

    The mean is taken over exact integer hundredths of the 2-digit rates, so it
    does not depend on the order in which partial sums are merged. An empty
    input gives 0 transactions, a NULL mean and volume 0.
    """
    n = F.count(F.lit(1))
    return fees.agg(
        n.alias("total_hash"),
        F.try_divide(F.sum(rate_cents("fee_rate")).cast("double"), n.cast("double") * 100.0).alias("mean_fee_rate"),
        F.coalesce(F.sum("out_total"), F.lit(0).cast("bigint")).alias("volume_sat"),
    )


def metrics_payload(summary: DataFrame) -> DataFrame:
    """K3: the published snapshot {vol, trans_fees, total_hash}.

    vol is the volume in coins as text, trans_fees the mean rate rounded to 4 digits (0 before
    the first transaction).
    """
    return summary.select(
        coins_text("volume_sat").alias("vol"),
        F.coalesce(F.round("mean_fee_rate", 4), F.lit(0.0)).alias("trans_fees"),
        F.col("total_hash"),
    )


def payload_json(payload: DataFrame) -> DataFrame:
    """The published snapshot as one JSON text per row, e.g.
    {"vol":"8.43681216","trans_fees":20.2925,"total_hash":12}."""
    return payload.select(F.to_json(F.struct("vol", "trans_fees", "total_hash")).alias("payload"))
