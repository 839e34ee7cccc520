"""A hot transaction holding over a third of all lines: bounded documents, exact fees."""

from __future__ import annotations

import datetime as dt
import re
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from feeflow.operators import fees as fe
from feeflow.operators import flatten as fl
from feeflow.plans.queries import REGISTRY
from feeflow.sources import tables as tb
from tests.test_plans import plan_of

HOT_LINES = 2600


@pytest.fixture(scope="module")
def skewed_dir():
    rng = np.random.default_rng(7)
    keys = [0] * HOT_LINES + [k for k in range(1, 401) for _ in range(int(rng.integers(1, 8)))]
    n = len(keys)
    li = pd.DataFrame(
        {
            "l_orderkey": np.array(keys, dtype="int64"),
            "l_partkey": rng.integers(1, 300, n).astype("int64"),
            "l_suppkey": rng.integers(1, 40, n).astype("int64"),
            "l_linenumber": rng.integers(1, 8, n).astype("int32"),
            "l_quantity": rng.integers(1, 51, n).astype("float64"),
            "l_extendedprice": np.round(rng.uniform(900, 99000, n), 2),
            "l_discount": rng.integers(0, 11, n) / 100.0,
            "l_tax": rng.integers(0, 9, n) / 100.0,
            "l_returnflag": rng.choice(["A", "N", "R"], n),
            "l_linestatus": rng.choice(["O", "F"], n),
            "l_shipdate": pd.Timestamp("1996-01-01"),
        }
    )
    # a few exact copies inside the hot order: equal items must collapse
    li = pd.concat([li, li[li.l_orderkey == 0].head(50)], ignore_index=True)
    orders = pd.DataFrame(
        {
            "o_orderkey": np.arange(0, 401, dtype="int64"),
            "o_custkey": np.ones(401, dtype="int64"),
            "o_orderstatus": "O",
            "o_totalprice": 1.0,
            "o_orderdate": [dt.datetime(1995, 1, 1) + dt.timedelta(days=int(d)) for d in rng.integers(0, 2000, 401)],
            "o_orderpriority": "1-URGENT",
        }
    )
    d = tempfile.mkdtemp()
    li.to_parquet(f"{d}/lineitem.parquet", index=False, coerce_timestamps="us")
    orders.to_parquet(f"{d}/orders.parquet", index=False, coerce_timestamps="us")
    return d, li


def brute_force(li: pd.DataFrame) -> pd.DataFrame:
    cents = np.round(li.l_extendedprice * 100).astype("int64")
    pct = np.round(li.l_discount * 100).astype("int64")
    net = cents * (100 - pct)
    out_cents = (net + 50) // 100
    ins = pd.DataFrame({"tx": li.l_orderkey, "a": li.l_suppkey, "v": cents}).drop_duplicates()
    outs = pd.DataFrame({"tx": li.l_orderkey, "a": li.l_partkey, "v": out_cents}).drop_duplicates()
    t = pd.DataFrame(
        {
            "in_total": ins.groupby("tx").v.sum(),
            "out_total": outs.groupby("tx").v.sum(),
            "size": li.groupby("l_orderkey").l_quantity.sum().astype("int64"),
        }
    )
    t["fee"] = t.in_total - t.out_total
    from decimal import ROUND_HALF_EVEN, Decimal

    t["fee_rate"] = [float(Decimal(repr(f / s)).quantize(Decimal("0.01"), ROUND_HALF_EVEN)) for f, s in zip(t.fee, t["size"])]
    return t[t.fee_rate >= 0]


def test_hot_order_fees_exact(spark, skewed_dir):
    d, li = skewed_dir
    want = brute_force(li)
    got = {int(r.hash): (r.size, r.in_total, r.out_total, r.fee, r.fee_rate) for r in REGISTRY["tx_fees"](spark, d).collect()}
    assert len(got) == len(want)
    for tx, row in want.iterrows():
        assert got[int(tx)] == (row["size"], row.in_total, row.out_total, row.fee, row.fee_rate), tx


def test_hot_order_documents_are_bounded(spark, skewed_dir):
    d, _ = skewed_dir
    docs = tb.tx_documents(spark, d, max_items=1000)
    hot = docs.filter(F.col("x.hash") == "0").select(F.size("x.inputs").alias("n"))
    sizes = sorted(r.n for r in hot.collect())
    assert sum(sizes) == HOT_LINES + 50 and len(sizes) == 3 and max(sizes) < 1200
    assert docs.filter(F.col("x.hash") != "0").groupBy("x.hash").count().filter("count > 1").count() == 0
    from_docs = fe.fee_table(fl.fee_items(fl.expand(docs)))
    direct = REGISTRY["tx_fees"](spark, d)
    assert from_docs.exceptAll(direct).count() == 0 and direct.exceptAll(from_docs).count() == 0
    # The row-local plan, too, whatever the cut and however often documents come.
    for cut in (docs, tb.tx_documents(spark, d, max_items=2), docs.union(docs)):
        local = fe.fee_table_rowlocal(fl.expand(cut))
        assert local.exceptAll(direct).count() == 0 and direct.exceptAll(local).count() == 0


def test_item_distinct_shuffles_on_the_full_item_key(spark, skewed_dir):
    d, _ = skewed_dir
    p = plan_of(REGISTRY["tx_fees"](spark, d))
    keys = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", p)
    first = [k.strip().split("#")[0] for k in keys[0].split(",")][:-1]
    assert first == ["tx_id", "is_input", "addr", "value"]
    assert [k.strip().split("#")[0] for k in keys[1].split(",")][:-1] == ["tx_id"]


def test_lines_are_shuffled_once(spark, skewed_dir):
    plan = plan_of(tb.tx_documents(spark, skewed_dir[0]))
    assert "REPARTITION_BY_COL" not in plan


def test_repeated_orders_repeat_their_lines(spark, tmp_path):
    li = pd.DataFrame({"l_orderkey": [1, 1, 2], "l_partkey": [1, 2, 3], "l_suppkey": [4, 5, 6], "l_linenumber": np.array([1, 2, 1], "int32")})
    li = li.assign(l_quantity=1.0, l_extendedprice=10.0, l_discount=0.0, l_tax=0.0, l_returnflag="A", l_linestatus="O", l_shipdate=pd.Timestamp("1996-01-01"))
    days = [dt.datetime(1995, 1, d) for d in (1, 1, 2, 1)]
    orders = pd.DataFrame({"o_orderkey": [1, 1, 1, 2], "o_orderdate": days})
    li.to_parquet(tmp_path / "lineitem.parquet", index=False, coerce_timestamps="us")
    orders.to_parquet(tmp_path / "orders.parquet", index=False, coerce_timestamps="us")
    got = tb.tx_documents(spark, str(tmp_path)).selectExpr("x.hash", "size(x.inputs) n").collect()
    assert sorted(map(tuple, got)) == [("1", 2), ("1", 4), ("2", 1)]
