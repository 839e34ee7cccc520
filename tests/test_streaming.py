"""Streaming: watermark timing, late data, batch = stream, restart from checkpoint."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
import time

from pyspark.sql import functions as F

from feeflow.operators import fees as fe
from feeflow.operators import flatten as fl
from feeflow.schemas import TX_DOC
from feeflow.streaming import jobs as sj
from feeflow.streaming import metrics as mt
from tests.docs import doc, golden_docs, to_df, to_json_lines

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ"


def write_events(spark, root, name, seconds):
    rows = [(i, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s)) for i, s in enumerate(seconds)]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{root}/{name}")
    time.sleep(1.1)  # distinct modification times keep the files in order


def run_append(spark, root):
    out, ck = tempfile.mkdtemp(dir=root), tempfile.mkdtemp(dir=root)
    stream = sj.parquet_stream(spark, f"{root}/in", EVENTS, max_files_per_trigger=1)
    q = sj.run(sj.event_window_counts(stream), "append_test", sink_path=out, checkpoint=ck)
    got = {(r["window_start"] - dt.datetime(1970, 1, 1)).seconds: r["count"] for r in spark.read.parquet(out).collect()}
    return got, q


def test_watermark_timing(spark):
    """Lateness is judged against the previous batch's watermark."""
    root = tempfile.mkdtemp()
    write_events(spark, f"{root}/in", "f0", [100, 101, 110])
    write_events(spark, f"{root}/in", "f1", [101, 120])
    write_events(spark, f"{root}/in", "f2", [130])
    got, _ = run_append(spark, root)
    assert got == {100: 3, 110: 1, 120: 1}  # window 130 is still open


def test_late_row_dropped(spark):
    root = tempfile.mkdtemp()
    write_events(spark, f"{root}/in", "f0", [100, 110])
    write_events(spark, f"{root}/in", "f1", [120])
    write_events(spark, f"{root}/in", "f2", [101])  # two batches after the watermark passed it
    got, _ = run_append(spark, root)
    assert got == {100: 1, 110: 1}


def stage(root, name, docs):
    os.makedirs(f"{root}/{name}", exist_ok=True)
    with open(f"{root}/{name}/part.json", "w") as fh:
        fh.write(to_json_lines(docs))
    time.sleep(1.1)


def test_batch_equals_stream_with_redelivery(spark):
    docs = golden_docs()
    root = tempfile.mkdtemp()
    stage(root, "in/a", docs[:6])
    stage(root, "in/b", docs[6:])
    stage(root, "in/c", docs[:3])  # redelivery in a later batch
    log = f"{root}/log"
    stream = sj.json_doc_stream(spark, f"{root}/in", TX_DOC, max_files_per_trigger=1)
    q = sj.run(fl.expand(stream), "fee_stream_test", foreach_batch=sj.item_log_writer(log), checkpoint=f"{root}/ck")
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3  # one file per trigger
    streamed = fe.metrics_payload(fe.fee_summary(sj.fees_from_item_log(spark, log))).first()
    batch = fe.metrics_payload(fe.fee_summary(fe.fee_table(fl.fee_items(fl.expand(to_df(spark, docs)))))).first()
    assert streamed == batch
    assert (streamed["vol"], streamed["trans_fees"], streamed["total_hash"]) == ("8.43681216", 20.2925, 12)


def test_restart_from_checkpoint(spark):
    docs = golden_docs()
    root = tempfile.mkdtemp()
    log, ck = f"{root}/log", f"{root}/ck"
    stage(root, "in/a", docs[:6])
    stream = sj.json_doc_stream(spark, f"{root}/in", TX_DOC)
    sj.run(fl.expand(stream), "restart_1", foreach_batch=sj.item_log_writer(log), checkpoint=ck)
    stage(root, "in/b", docs[6:])
    stream = sj.json_doc_stream(spark, f"{root}/in", TX_DOC)
    q = sj.run(fl.expand(stream), "restart_2", foreach_batch=sj.item_log_writer(log), checkpoint=ck)
    assert sum(p["numInputRows"] for p in q.recentProgress) == 6  # only the new file
    assert spark.read.parquet(log).select("batch_id").distinct().count() == 2
    assert fe.fee_summary(sj.fees_from_item_log(spark, log)).first()["total_hash"] == 12


def test_dedup_within_watermark(spark):
    docs = golden_docs()
    root = tempfile.mkdtemp()
    stage(root, "in/a", docs + docs[:4])
    out = f"{root}/out"
    stream = sj.json_doc_stream(spark, f"{root}/in", TX_DOC, max_files_per_trigger=None)
    sj.run(sj.dedup_documents(fl.expand(stream), "10 minutes").select("hash"), "dedup_test", sink_path=out, checkpoint=f"{root}/ck")
    assert spark.read.parquet(out).count() == 12


def test_fee_delta_writer_idempotent(spark):
    docs = golden_docs()
    batch = fl.expand(to_df(spark, docs))
    root = tempfile.mkdtemp()
    writer = sj.fee_delta_writer(f"{root}/d")
    writer(batch, 0)
    writer(batch, 0)  # a replayed batch replaces its own output
    fees = sj.fees_from_deltas(spark, f"{root}/d")
    assert fe.metrics_payload(fe.fee_summary(fees)).first()["vol"] == "8.43681216"
    assert fees.count() == 12


def test_redelivery_in_later_batches_counts_once(spark):
    """Copies with reordered inputs, flipped ``spent`` and an older time, in other batches."""
    root = tempfile.mkdtemp()
    first, again = (doc("a", 100, 5000, [("x", 200), ("y", 300)], [("z", 100)]) for _ in range(2))
    again["x"]["inputs"].reverse()
    for item in again["x"]["inputs"]:
        item["prev_out"]["spent"] = False
    late = doc("b", 10, 1, [("x", 50)], [("z", 20)])
    sj.create_deltas(spark, f"{root}/d")
    assert fe.metrics_payload(fe.fee_summary(sj.fees_from_deltas(spark, f"{root}/d"))).first()[:] == ("0.00000000", 0.0, 0)
    for i, docs in enumerate(([first], [again, late], [late, first])):
        batch = fl.expand(to_df(spark, docs))
        sj.fee_delta_writer(f"{root}/d")(batch, i)
        sj.doc_log_writer(f"{root}/log")(batch, i)
    fees = {r.hash: (r.in_total, r.out_total) for r in sj.fees_from_deltas(spark, f"{root}/d").collect()}
    assert fees == {"a": (500, 100), "b": (50, 20)}
    seen = {r.hash: (r.n_inputs, r.n_outputs) for r in sj.transactions_from_doc_log(spark, f"{root}/log").collect()}
    assert seen == {"a": (2, 1), "b": (1, 1)}


def test_metrics_table(spark):
    root = tempfile.mkdtemp()
    fees = fe.fee_table(fl.fee_items(fl.expand(to_df(spark, golden_docs()))))
    for i in (0, 1, 1):  # batch 1 written twice
        mt.write_delta(mt.metric_deltas(fees.filter(F.col("size") < 300) if i == 0 else fees.filter(F.col("size") >= 300), batch_id=i), f"{root}/m", i)
    snap = mt.latest_snapshot(mt.read_deltas(spark, f"{root}/m")).first()
    assert (snap["batch_id"], snap["vol"], snap["trans_fees"], snap["total_hash"]) == (1, "8.43681216", 20.2925, 12)
    empty = mt.latest_snapshot(mt.metric_deltas(fees.limit(0), batch_id=0).limit(0)).first()
    assert (empty["vol"], empty["trans_fees"], empty["total_hash"]) == ("0.00000000", 0.0, 0)


def test_update_and_complete_modes(spark):
    root = tempfile.mkdtemp()
    write_events(spark, f"{root}/in", "f0", [100, 101, 110])
    write_events(spark, f"{root}/in", "f1", [101, 120])
    for mode, delay in (("update", "1 second"), ("complete", None)):
        table = f"{root}/{mode}"
        stream = sj.parquet_stream(spark, f"{root}/in", EVENTS, max_files_per_trigger=1)
        sj.run(sj.event_window_counts(stream, delay=delay), f"{mode}_test", mode=mode,
               foreach_batch=sj.snapshot_writer(table), checkpoint=f"{root}/ck_{mode}")
        got = {(r["window_start"] - dt.datetime(1970, 1, 1)).seconds: r["count"]
               for r in sj.latest_per_key(spark, table, ["window_start", "window_end"]).collect()}
        assert got == {100: 3, 110: 1, 120: 1}, mode


def test_doc_with_one_side_only_is_ignored(spark):
    rel = fe.fee_table(fl.fee_items(fl.expand(to_df(spark, [doc("x", 10, 1, [("a", 5)], [])]))))
    assert rel.count() == 0


def test_multiline_document_files(spark):
    """One pretty-printed document per file, one file per trigger (the original file job)."""
    import json

    root = tempfile.mkdtemp()
    for i, d in enumerate(golden_docs()[:3]):
        os.makedirs(f"{root}/in/{i}")
        with open(f"{root}/in/{i}/tx.json", "w") as fh:
            json.dump(d, fh, indent=2)
    out = f"{root}/out"
    stream = sj.json_doc_stream(spark, f"{root}/in", TX_DOC, max_files_per_trigger=1, multiline=True)
    q = sj.run(fl.flatten(fl.expand(stream)), "multiline_test", sink_path=out, checkpoint=f"{root}/ck")
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    assert spark.read.parquet(out).select("hash").distinct().count() == 3


def test_item_log_takes_contents_that_differ_item_by_item(spark):
    """Copies are one row of a batch; parts and contents that differ add only what is new."""
    root = tempfile.mkdtemp()
    part, more = doc("a", 100, 1, [("x", 5), ("y", 7)], [("z", 3)]), doc("a", 100, 1, [("y", 7), ("w", 9), ("w", 9)], [("z", 3), ("v", None)])
    plain, empty = doc("b", 10, 1, [("x", 50)], [("z", 20)]), doc("c", 10, 1, [("x", None)], [])
    writer = sj.item_log_writer(f"{root}/log")
    delivered = ([part, plain, plain, empty], [more, plain], [part])
    for i, docs in enumerate(delivered):
        writer(fl.expand(to_df(spark, docs)), i)
    assert spark.read.parquet(f"{root}/log").filter("batch_id = 0").count() == 2
    got = {r.hash: (r.in_total, r.out_total) for r in sj.fees_from_item_log(spark, f"{root}/log").collect()}
    want = fe.fee_table(fl.fee_items(fl.expand(to_df(spark, [d for docs in delivered for d in docs]))))
    assert got == {"a": (21, 3), "b": (50, 20)} == {r.hash: (r.in_total, r.out_total) for r in want.collect()}


def _tables(spark, root, n_orders=300, lines=7):
    """orders and lineitem of ``n_orders`` orders, a table folder."""
    days = [dt.datetime(1995, 1, 1) + dt.timedelta(days=i) for i in range(n_orders)]
    spark.createDataFrame(list(enumerate(days)), "o_orderkey BIGINT, o_orderdate TIMESTAMP_NTZ").write.parquet(f"{root}/orders.parquet")
    rows = [(o, o % 40, o % 11 + n, n + 1, float(n + 1), 100.0 * n + o, 0.05, 0.02, "R", "F") for o in range(n_orders) for n in range(lines)]
    schema = "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING"
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/lineitem.parquet")
    return root


def test_staged_documents_are_small(spark):
    """Both deliveries hold every document in a fraction of its plain text."""
    from feeflow.plans import queries as q

    sf = _tables(spark, tempfile.mkdtemp())
    root = q._stage_docs(spark, sf, deliveries=2)
    text = spark.read.text(root)
    plain = text.agg(F.sum(F.length("value"))).first()[0]
    size = sum(os.path.getsize(f"{d}/{f}") for d, _, files in os.walk(root.removeprefix("file://")) for f in files if f.startswith("part-"))
    assert text.count() == 600 and text.select("value").distinct().count() == 300 and size < plain / 4


def test_dead_letter_files_and_described_batches_follow_the_table(spark, monkeypatch):
    """More envelopes are staged in more files, not in larger ones; more files make no more batches."""
    from feeflow.plans import queries as q

    sf = _tables(spark, tempfile.mkdtemp())
    read = []
    stream = sj.parquet_stream
    monkeypatch.setattr(sj, "parquet_stream", lambda s, root, *a, **k: read.append((len(s.read.parquet(root).inputFiles()), k)) or stream(s, root, *a, **k))
    monkeypatch.setattr(q, "ENVELOPES_PER_FILE", 20)
    assert q.q_stream_dead_letters(spark, sf).select(F.count_distinct("key")).first()[0] == 300
    assert read[0][0] >= 15 and read[0][1]["max_files_per_trigger"] == read[0][0] // q.SHARES
    monkeypatch.setattr(q, "DESCRIBED", 2)
    described = q.q_stream_batch_describe(spark, sf)
    batches = described.count() // 5
    assert 2 <= batches <= 4
    assert described.filter("summary = 'count'").count() == batches
