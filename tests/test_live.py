"""Live totals with keyed state, late rows, bounded redelivery state."""

from __future__ import annotations

import datetime as dt
import subprocess
import sys
import tempfile

from pyspark.serializers import CloudPickleSerializer
from pyspark.sql import functions as F

from feeflow.operators import fees as fe
from feeflow.operators import flatten as fl
from feeflow.schemas import TX_DOC
from feeflow.streaming import jobs as sj
from feeflow.streaming import late as lt
from feeflow.streaming import live as lv
from feeflow.streaming import metrics as mt
from tests.docs import golden_docs, to_df
from tests.test_streaming import EVENTS, stage, write_events


def _drain(spark, root, out):
    """Both jobs over what is there; rows that each micro-batch read."""
    stream = sj.json_doc_stream(spark, f"{root}/in", TX_DOC, max_files_per_trigger=1)
    runs = [lv.increments_job(fl.expand(stream), out)]
    sj.await_done(runs[0])
    runs.append(lv.totals_job(spark, out))
    sj.await_done(runs[1])
    return [[p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] for q in runs]


def test_live_totals_after_every_delivery(spark):
    docs, root, out = golden_docs(), tempfile.mkdtemp(), tempfile.mkdtemp()
    delivered = []
    for name, part in (("a", docs[:5]), ("b", docs[3:9]), ("c", docs[:6]), ("d", docs)):  # parts again, everything again
        stage(root, f"in/{name}", part)
        delivered += part
        read = _drain(spark, root, out)
        assert read[0] == [len(part)]  # nothing but the new file, however long the history is
        got = mt.latest_snapshot(mt.read_deltas(spark, f"{out}/metrics")).first()
        want = fe.metrics_payload(fe.fee_summary(fe.fee_table(fl.fee_items(fl.expand(to_df(spark, delivered)))))).first()
        assert (got["vol"], got["trans_fees"], got["total_hash"]) == tuple(want)
    assert (got["vol"], got["trans_fees"], got["total_hash"]) == ("8.43681216", 20.2925, 12)
    stage(root, "in/e", docs)
    assert _drain(spark, root, out)[1] == []  # no increment: the second job has nothing to read


def test_item_state_is_bounded_by_the_delay(spark):
    docs, root, out = golden_docs(), tempfile.mkdtemp(), tempfile.mkdtemp()
    stage(root, "in/a", docs)
    stage(root, "in/b", docs)
    stream = sj.json_doc_stream(spark, f"{root}/in", TX_DOC, max_files_per_trigger=1)
    q = lv.increments_job(fl.expand(stream), out, keep="3650 days")
    sj.await_done(q)
    got = spark.read.parquet(f"{out}/increments").groupBy("hash", "size").count()
    assert got.filter("count > 1").count() == 0
    assert got.count() == fl.fee_items(fl.expand(to_df(spark, docs))).select("hash", "size").distinct().count()


def test_late_rows_are_those_that_the_count_drops(spark):
    root = tempfile.mkdtemp()
    write_events(spark, f"{root}/in", "f0", [100, 110])
    write_events(spark, f"{root}/in", "f1", [108, 107, 109, 120])  # watermark 109: window [106, 108) ended
    write_events(spark, f"{root}/in", "f2", [101, 118, 130])  # watermark 119: [118, 120) is open
    seconds = lambda path: sorted(r[0] for r in spark.read.parquet(path).select(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).collect())
    for lag, late in ((0, [101, 107]), (1, [101])):
        out = f"{root}/out{lag}"
        stream = sj.parquet_stream(spark, f"{root}/in", EVENTS, max_files_per_trigger=1)
        sj.run(stream, "split_test", foreach_batch=lt.split_writer(out, lag=lag), checkpoint=f"{root}/ck{lag}")
        assert seconds(f"{out}/late") == late
    counted = sj.parquet_stream(spark, f"{root}/in", EVENTS, max_files_per_trigger=1)
    q = sj.run(sj.event_window_counts(counted), "split_count", sink_path=f"{root}/counts", checkpoint=f"{root}/ck2")
    assert lt.dropped_as_late([q]) == 1
    windows = {(r["window_start"] - dt.datetime(1970, 1, 1)).seconds: r["count"] for r in spark.read.parquet(f"{root}/counts").collect()}
    kept = [s for s in seconds(f"{out}/on_time") if s < 128]
    assert windows == {int(w): sum(w <= s < w + 2 for s in kept) for w in {s // 2 * 2 for s in kept}}
    # A retried batch is parted as before.
    batch = spark.createDataFrame([(1, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s)) for s in (101, 118, 130)], EVENTS)
    lt.split_writer(out, lag=1)(batch, 2)
    assert seconds(f"{out}/late") == [101]


def test_chained_windows_count_redelivered_items_once(spark):
    docs, root = golden_docs(), tempfile.mkdtemp()
    stage(root, "in/a", docs)
    stage(root, "in/b", docs)
    stream = sj.json_doc_stream(spark, f"{root}/in", TX_DOC, max_files_per_trigger=None)
    sj.run(sj.windowed_transactions(sj.windowed_items(fl.expand(stream))), "chain", sink_path=f"{root}/out", checkpoint=f"{root}/ck")
    got = spark.read.parquet(f"{root}/out")
    items = fl.fee_items(fl.expand(to_df(spark, docs)))
    want = {(r["hash"], r["size"]): r["n"] for r in items.distinct().groupBy("hash", "size").agg(F.count("*").alias("n")).collect()}
    assert got.count() > 0
    for r in got.collect():
        assert r["n_items"] <= want[(r["hash"], r["size"])] and r["n_deliveries"] >= 2 * r["n_items"]


def test_profile_takes_back_what_changed(spark):
    docs, root, out = golden_docs(), tempfile.mkdtemp(), tempfile.mkdtemp()
    for name, part in (("a", docs[:7]), ("b", docs), ("c", docs[2:])):
        stage(root, f"in/{name}", part)
    stream = sj.json_doc_stream(spark, f"{root}/in", TX_DOC, max_files_per_trigger=1)
    sj.await_done(lv.increments_job(fl.expand(stream), out))
    sj.await_done(lv.totals_job(spark, out, max_files=1, writer=lv.profile_writer(f"{out}/profile")))
    got = lv.profile(spark, f"{out}/profile").first()
    fees = fe.fee_table(fl.fee_items(fl.expand(to_df(spark, docs))))
    want = fees.agg(F.count("*").alias("n"), F.avg("size"), F.stddev("size"), F.avg("fee"), F.stddev("fee"), F.avg("fee_rate"), F.stddev("fee_rate"), F.corr("size", "fee_rate")).first()
    assert got["n"] == want["n"] and all(abs(a - b) <= 1e-4 * max(1, abs(b)) for a, b in zip(got[1:], want[1:], strict=True))


def test_compaction_keeps_what_readers_see(spark, tmp_path):
    table = str(tmp_path / "metrics")
    mt.create_metrics(spark, table)
    assert mt.compact(spark, table) is None

    def delta(i):
        mt.write_delta(spark.createDataFrame([(i, 1, 100 + i, 10)], "batch_id long, n_tx long, rate_cents long, out_value long"), table, i)

    folders = lambda: sorted(p.name for p in (tmp_path / "metrics").glob("batch_id=[0-9]*"))
    for i in range(6):
        delta(i)
        before = mt.latest_snapshot(mt.read_deltas(spark, table) if i < 2 else mt.read_current(spark, table)).first()
        if i in (1, 3, 5):
            old_reader = mt.read_current(spark, table)  # resolved before the compaction, read after it
            assert mt.compact(spark, table) == i and mt.compact(spark, table) is None
            assert mt.latest_snapshot(old_reader).first() == before
        assert mt.latest_snapshot(mt.read_current(spark, table)).first() == before
    assert before["total_hash"] == 6 and before["batch_id"] == 5 and folders() == ["batch_id=4", "batch_id=5"]
    # One that broke off before its marker is not read.
    broken = tmp_path / "metrics" / "_compacted" / "upto=9"
    broken.mkdir()
    assert mt.latest_snapshot(mt.read_current(spark, table)).first() == before


def test_dead_letters_keep_the_raw_text(spark):
    from feeflow.sources import broker as br

    good = [r["value"] for r in br.as_envelope(to_df(spark, golden_docs())).collect()]
    bad = [good[0][:-3], b"junk", b"", None, b"[]", b"{}", b'"text"', good[1].replace(b'"size":', b'"size":99999999999'), b"\xff\xfe"]
    checked = br.parse_checked(spark.createDataFrame([(bytes(v) if v is not None else None,) for v in [*good, *bad]], "value binary"))
    assert br.accepted(checked).count() == len(good)
    texts = [r["payload"] for r in br.rejected(checked).collect()]
    assert len(texts) == len(bad) and sorted(t for t in texts if t.isascii()) == sorted((v or b"").decode() for v in bad[:-1])


def test_live_totals_in_a_session_with_the_heap_store(spark):
    """Spark's default state store can't run state processors; the session gets its settings back."""
    key = "spark.sql.streaming.stateStore.providerClass"
    heap = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    mine = spark.conf.get(key)
    docs, root, out = golden_docs(), tempfile.mkdtemp(), tempfile.mkdtemp()
    stage(root, "in/a", docs[:8])
    stage(root, "in/b", docs)
    spark.conf.set(key, heap)
    try:
        _drain(spark, root, out)
        assert spark.conf.get(key) == heap
    finally:
        spark.conf.set(key, mine)
    got = mt.latest_snapshot(mt.read_deltas(spark, f"{out}/metrics")).first()
    assert (got["vol"], got["trans_fees"], got["total_hash"]) == ("8.43681216", 20.2925, 12)


def test_the_state_processor_needs_no_package_in_its_workers():
    load = "import sys; from pyspark import cloudpickle; print(type(cloudpickle.loads(sys.stdin.buffer.read())).__name__)"
    raw = CloudPickleSerializer().dumps(lv.TransactionTotals(1000))
    got = subprocess.run([sys.executable, "-c", load], input=raw, capture_output=True, cwd="/", env={})
    assert got.stdout.decode().strip() == "TransactionTotals", got.stderr.decode()


INCREMENTS = [
    [("a", 1, 5, None), ("a", 1, 1, None), ("b", 2, 7, 8), (None, 3, 1, 1), ("n", 4, None, None)],
    [("a", 1, 10, None), ("c", 1, 0, -2), ("a", 2, 3, 3), ("c", None, 1, 1)],
    [(None, 3, None, 4), ("b", 2, 1, 1), ("n", 4, None, 6), ("a", 1, -16, 2), ("a", 1, None, 2)],
]


def test_totals_need_no_python_call_per_transaction(spark, tmp_path):
    """What an aggregation emits equals what the state processor does, batch by batch."""
    columns = [c.split()[0] for c in lv.CHANGE.split(", ")]
    processor = lambda rows: rows.groupBy("hash", "size").transformWithState(lv.TransactionTotals(), outputStructType=lv.CHANGE, outputMode="Append", timeMode="None")
    got = {}
    for name, job, mode in (("plain", lv.total_changes, "update"), ("processor", processor, "append")):
        batches, root = [], tmp_path / name
        for i, rows in enumerate(INCREMENTS):
            spark.createDataFrame(rows, lv.INCREMENT).repartition(3).write.parquet(f"{root}/in/batch_id={i}")
            changes = job(sj.parquet_stream(spark, f"{root}/in", lv.INCREMENT, max_files_per_trigger=None))
            assert ("TransformWithState" in changes._jdf.queryExecution().analyzed().toString()) == (name == "processor")
            keep = lambda batch, i: batches.append(sorted(map(tuple, batch.select(*columns).collect()), key=repr))  # noqa: B023, E731
            sj.run(changes, "totals", timeout_s=100, mode=mode, foreach_batch=keep, checkpoint=f"{root}/ck", unbounded_state=True)
        got[name] = batches
    assert got["plain"] == got["processor"] and len(got["plain"]) == 3
    assert ("a", 1, True, 16, None, 0, 4) in got["plain"][2] and ("n", 4, True, None, None, None, 6) in got["plain"][2]


def test_a_sum_beyond_bigint_is_not_wrapped():
    import pyarrow as pa
    import pytest

    rows = pa.table([["a", "a"], [1, 1], [2**62, 2**62], pa.array([None, 1], pa.int64())], ["hash", "size", "in_new", "out_new"])
    with_batch = type("Context", (), {"get": staticmethod(lambda: type("T", (), {"getLocalProperty": staticmethod(lambda key: "7")}))})
    with pytest.MonkeyPatch.context() as m:
        m.setattr(lv, "TaskContext", with_batch)
        with pytest.raises(pa.ArrowInvalid):
            lv.batch_sums(rows)
        assert lv.batch_sums(rows.slice(1)).to_pylist() == [{"hash": "a", "size": 1, "in_new": 2**62, "out_new": 1, "at": 7}]
