"""The runnable jobs, end to end on hand-made and supplied data."""

from __future__ import annotations

import json
import os
import tempfile

from feeflow.plans.queries import REGISTRY
from feeflow.sources import broker as br
from feeflow.streaming import apps
from feeflow.streaming import jobs as sj
from tests.conftest import SF_SMALL
from tests.docs import golden_docs, to_df, to_json_lines


def test_live_job_on_envelope_files(spark):
    root = tempfile.mkdtemp()
    envelopes = br.as_envelope(to_df(spark, golden_docs() + golden_docs()[:5]))  # with redeliveries
    envelopes.write.parquet(f"{root}/in")
    stream = sj.parquet_stream(spark, f"{root}/in", "key BINARY, value BINARY, topic STRING")
    q = apps.live_fee_job(spark, stream, f"{root}/out", trigger={"availableNow": True})
    sj.await_done(q)
    snap = apps.live_snapshot(spark, f"{root}/out").first()
    assert (snap["vol"], snap["trans_fees"], snap["total_hash"]) == ("8.43681216", 20.2925, 12)


def test_file_job_then_model_job(spark):
    root = tempfile.mkdtemp()
    os.makedirs(f"{root}/in/a")
    with open(f"{root}/in/a/part.json", "w") as fh:
        fh.write(to_json_lines(golden_docs()))
    with open(f"{root}/in/a/again.json", "w") as fh:  # delivered once more, in another batch
        fh.write(to_json_lines(golden_docs()[::-1]))
    job = apps.file_fee_job(
        spark, f"{root}/in", f"{root}/out", trigger={"availableNow": True}, max_files_per_trigger=1
    )
    sj.await_done(job)
    export = apps.read_export(spark, apps.export_fees(spark, f"{root}/out"))
    assert export.count() == 12
    train = REGISTRY["tx_fees"](spark, SF_SMALL)
    errors, scored = apps.model_job(spark, train, export, f"{root}/model")
    e = errors.first()
    assert e["n"] > 0 and e["rmse"] >= 0
    assert scored.count() == 12 and "prediction" in scored.columns


def test_model_cli(spark):
    root = tempfile.mkdtemp()
    REGISTRY["tx_fees"](spark, SF_SMALL).write.option("header", "true").csv(f"{root}/export")
    apps.main(["model", "--train", f"{root}/export", "--out", f"{root}/m"])
    errors = [json.loads(line) for f in os.listdir(f"{root}/m/errors") if f.endswith(".json")
              for line in open(f"{root}/m/errors/{f}")]
    assert len(errors) == 1 and errors[0]["n"] > 0
    assert spark.read.parquet(f"{root}/m/predictions").count() == REGISTRY["tx_fees"](spark, SF_SMALL).count()
