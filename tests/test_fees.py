"""Fee semantics on hand-made documents: golden values and edge rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from feeflow.operators import fees as fe
from feeflow.operators import flatten as fl
from feeflow.operators import windows as wn
from feeflow.sources import broker as br
from tests.docs import GOLDEN, doc, golden_docs, to_df


def fees_both_ways(spark, docs, distinct=True):
    tx = fl.expand(to_df(spark, docs))
    rel = fe.fee_table(fl.fee_items(tx), distinct=distinct)
    row = fe.fee_table_rowlocal(tx, distinct=distinct)
    return rel, row


def as_dict(df):
    return {r["hash"]: (r["size"], r["in_total"], r["out_total"], r["fee"], r["fee_rate"]) for r in df.collect()}


def test_golden_fee_table(spark):
    rel, row = fees_both_ways(spark, golden_docs())
    expected = {h: (size, si, so, fee, rate) for h, _t, size, _ni, _no, si, so, fee, rate in GOLDEN}
    assert as_dict(rel) == expected
    assert as_dict(row) == expected


def test_golden_summary_and_payload(spark):
    rel, _ = fees_both_ways(spark, golden_docs())
    s = fe.fee_summary(rel).first()
    assert (s["total_hash"], s["volume_sat"]) == (12, 843681216)
    assert round(s["mean_fee_rate"], 6) == 20.2925
    p = fe.metrics_payload(fe.fee_summary(rel)).first()
    assert (p["vol"], p["trans_fees"], p["total_hash"]) == ("8.43681216", 20.2925, 12)
    text = fe.payload_json(fe.metrics_payload(fe.fee_summary(rel))).first()["payload"]
    assert text == '{"vol":"8.43681216","trans_fees":20.2925,"total_hash":12}'


def test_golden_flat_and_windows(spark):
    tx = fl.expand(to_df(spark, golden_docs()))
    flat = fl.flatten(tx)
    assert flat.count() == sum(ni + no for _h, _t, _s, ni, no, *_ in GOLDEN)
    assert flat.filter(F.col("addr").isNull()).count() == 1
    counts = wn.window_tx_counts(tx).orderBy("window_start").collect()
    starts = [r["window_start"] for r in counts]
    assert starts == [dt.datetime(2023, 2, 27, 2, 19, s) for s in (46, 48, 50, 52)]
    assert [r["total_trans"] for r in counts] == [4, 2, 2, 4]
    groups = wn.windowed_item_counts(fl.flatten(tx, header=["hash", "size", "time"]))
    assert groups.count() == flat.count() and groups.agg(F.max("count")).first()[0] == 1


def test_empty_input_summary(spark):
    rel, _ = fees_both_ways(spark, [doc("e", 100, 1, [], [("a", 1)])])
    s = fe.fee_summary(rel).first()
    assert (s["total_hash"], s["mean_fee_rate"], s["volume_sat"]) == (0, None, 0)


def test_edge_rows(spark):
    docs = [
        doc("empty_in", 100, 1, [], [("o", 5)]),
        doc("size0", 0, 1, [("a", 10)], [("o", 5)]),
        doc("equal_in", 100, 1, [("a", 500), ("a", 500)], [("o", 400)]),
        doc("negative", 100, 1, [("a", 100)], [("o", 200)]),
        doc("tiny_negative", 250, 1, [("a", 100)], [("o", 101)]),
        doc("tie1", 200, 1, [("a", 469)], [("o", 0)]),
        doc("tie2", 200, 1, [("a", 471)], [("o", 0)]),
        doc("tie3", 8, 1, [("a", 1)], [("o", 0)]),
        doc("redelivered", 100, 1, [("a", 300)], [("o", 100)]),
        doc("redelivered", 100, 1, [("a", 300)], [("o", 100)]),
        doc("two_sizes", 100, 1, [("a", 300)], [("o", 100)]),
        doc("two_sizes", 200, 1, [("a", 300)], [("o", 100)]),
    ]
    rel, row = fees_both_ways(spark, docs)
    got = as_dict(rel)
    assert "empty_in" not in got and "size0" not in got and "negative" not in got
    assert got["equal_in"][1] == 500  # equal inputs collapse (original rule)
    assert got["tiny_negative"][4] == 0.0  # -0.004 rounds to 0.0 and is kept
    assert (got["tie1"][4], got["tie2"][4], got["tie3"][4]) == (2.34, 2.36, 0.12)  # half-even
    assert got["redelivered"][1:4] == (300, 100, 200)  # counted once
    assert rel.filter("hash = 'two_sizes'").count() == 2  # one row per (hash, size), no 2x2 product
    assert as_dict(row) == got  # the row-local plan counts copies once, too
    exact = as_dict(fe.fee_table(fl.fee_items(fl.expand(to_df(spark, docs[2:3]))), distinct=False))
    assert exact["equal_in"][1] == 1000


def test_junk_and_bad_fields(spark):
    good = '{"op":"utx","x":{"size":100,"time":1,"hash":"h","inputs":[{"prev_out":{"addr":"a","value":300}}],"out":[{"addr":"b","value":100}]}}'
    bad_size = good.replace('"size":100', '"size":"z"').replace('"hash":"h"', '"hash":"b"')
    big_size = good.replace('"size":100', '"size":99999999999').replace('"hash":"h"', '"hash":"c"')
    env = spark.createDataFrame([(b"k1", "junk".encode()), (b"k2", good.encode()), (b"k3", bad_size.encode()),
                                 (b"k4", big_size.encode())], "key binary, value binary")
    tx = br.parse_transactions(env)
    rows = {r["key"]: r for r in tx.collect()}
    assert rows["k1"]["hash"] is None
    assert rows["k3"]["hash"] == "b" and rows["k3"]["size"] is None
    assert rows["k4"]["hash"] == "c" and rows["k4"]["size"] is None
    fees = as_dict(fe.fee_table(fl.fee_items(tx)))
    assert set(fees) == {"h"} and fees["h"][4] == 2.0


def test_envelope_round_trip(spark):
    docs = to_df(spark, golden_docs())
    tx = br.parse_transactions(br.as_envelope(docs))
    assert tx.count() == 12
    assert as_dict(fe.fee_table(fl.fee_items(tx))) == as_dict(fe.fee_table(fl.fee_items(fl.expand(docs))))


def test_original_shaped_pieces(spark):
    tx = fl.expand(to_df(spark, golden_docs()))
    ins = fe.input_totals(fe.distinct_inputs(fl.explode_inputs(tx)))
    outs = fe.output_totals(fe.distinct_outputs(fl.explode_outputs(tx)))
    joined = fe.with_fees(fe.join_totals(ins, outs)).select("hash", "size", "in_total", "out_total", "fee", "fee_rate")
    expected = {h: (size, si, so, fee, rate) for h, _t, size, _ni, _no, si, so, fee, rate in GOLDEN}
    assert as_dict(joined) == expected
