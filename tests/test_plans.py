"""Physical plans: pruning, no pair products, the expected number of shuffles."""

from __future__ import annotations

import re

from feeflow.plans.queries import REGISTRY
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    """The formatted physical plan, as ``df.explain("formatted")`` prints it."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_tx_fees_plan(spark):
    p = plan_of(REGISTRY["tx_fees"](spark, SF_SMALL))
    assert "Join" not in p and "Cartesian" not in p and "NestedLoop" not in p
    # one exchange for the item distinct, one for the per-transaction sums
    hashed = re.findall(r"Arguments: hashpartitioning\(", p)
    assert len(hashed) == 2
    scan = re.search(r"ReadSchema: (struct<[^>]*>)", p).group(1)
    assert set(re.findall(r"(\w+):", scan)) == {
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount"
    }


def test_rowlocal_plan_has_no_generator(spark):
    from feeflow.operators import fees as fe
    from feeflow.operators import flatten as fl
    from tests.docs import golden_docs, to_df

    tx = fl.expand(to_df(spark, golden_docs()))
    p = plan_of(fe.fee_table_rowlocal(tx, whole_documents=True))
    assert "Generate" not in p and "Exchange" not in p  # a fold inside one projection
    assert "Generate" in plan_of(fe.fee_table(fl.fee_items(tx)))


def test_no_pair_products_anywhere(spark):
    for name in ("tx_flatten", "window_tx_groups", "self_join_hash", "join_in_out_totals", "tx_fees_docs"):
        p = plan_of(REGISTRY[name](spark, SF_SMALL))
        assert "Cartesian" not in p and "NestedLoop" not in p, name


def test_filters_reach_the_scan(spark):
    from pyspark.sql import functions as F

    from feeflow.sources import tables as tb

    df = tb.read_table(spark, SF_SMALL, "lineitem").filter(F.col("l_discount") > 0.05)
    p = plan_of(df.select("l_orderkey"))
    assert "PushedFilters: [IsNotNull(l_discount), GreaterThan(l_discount,0.05)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_discount:double>" in p


def test_scans_are_not_dealt_anew(spark):
    from feeflow.sources import tables as tb

    assert "Exchange" not in plan_of(tb.read_table(spark, SF_SMALL, "lineitem"))


def test_feature_queries_write_nothing(spark):
    for name in ("ml_features", "ml_poly_features"):
        assert "Scan parquet" in plan_of(REGISTRY[name](spark, SF_SMALL)), name  # from the table, no checkpoint


def test_hot_order_is_split_in_the_header_join(spark, tmp_path):
    """40% of the lines in one order: AQE splits them, as the header has an exchange of its own."""
    from pyspark.sql import functions as F

    from feeflow.sources import tables as tb

    hot = spark.read.parquet(f"{SF_SMALL}/orders.parquet").agg(F.min("o_orderkey")).first()[0]
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    key = F.when(F.col("l_linenumber") <= 2, F.lit(hot)).otherwise(F.col("l_orderkey")).alias("l_orderkey")
    lines.select(key, *[c for c in lines.columns if c != "l_orderkey"]).repartition(16).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").write.parquet(f"{tmp_path}/orders.parquet")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        docs = tb.tx_documents(spark, str(tmp_path)).select("x.hash", F.size("x.inputs").alias("n"))
        docs.collect()
        assert "skew=true" in docs._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_sum_distinct_shuffles_on_the_value_first(spark):
    """A11 stays skew-safe: values are deduplicated on (hash, value) before the per-hash sum."""
    p = plan_of(REGISTRY["sum_distinct_in"](spark, SF_SMALL))
    keys = [k for k in re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", p)]
    names = [[x.strip().split("#")[0] for x in k.split(",")][:-1] for k in keys]
    assert ["hash", "in_value"] in names and ["hash"] in names
    assert names.index(["hash", "in_value"]) < names.index(["hash"])  # details run bottom-up: the value exchange comes first


def test_window_streams_have_more_shares_for_more_lines(spark, monkeypatch):
    """A share's state is bounded: a larger table is published in more of them, with the same windows at the end."""
    from feeflow.plans import queries
    from feeflow.streaming import jobs

    runs, run = [], jobs.run
    monkeypatch.setattr(jobs, "run", lambda *a, **k: runs.append(run(*a, **k)) or runs[-1])
    found, most = [], []
    for lines in (queries.LINES_PER_SHARE, 800):
        monkeypatch.setattr(queries, "LINES_PER_SHARE", lines)
        runs.clear()
        found.append(sorted(map(tuple, REGISTRY["stream_window_tx_groups"](spark, SF_SMALL).collect()), key=repr))
        most.append((len(runs), max(s["numRowsTotal"] for q in runs for p in q.recentProgress for s in p["stateOperators"])))
    assert found[0] == found[1] and len(found[0]) > 10_000
    assert most[0][0] == 4 and most[1][0] >= 7 and most[1][1] < 0.8 * most[0][1]


def test_item_streams_read_no_other_fields():
    from feeflow.schemas import ITEM_DOC, TX_DOC

    assert [f.name for f in ITEM_DOC["x"].dataType] == ["size", "inputs", "time", "hash", "out"]
    assert ITEM_DOC["x"].dataType["inputs"].dataType.elementType["prev_out"].dataType.simpleString() == "struct<addr:string,value:bigint>"
    assert all(ITEM_DOC["x"].dataType[c].dataType == TX_DOC["x"].dataType[c].dataType for c in ("size", "time", "hash"))
