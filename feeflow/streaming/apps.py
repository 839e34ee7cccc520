"""Runnable jobs: the live broker job, the file job and the model job.

Each is a thin composition of the library functions, with every location on
shared storage. Command line:

    python -m feeflow.streaming.apps live  --bootstrap host:9092 --out /shared/fees
    python -m feeflow.streaming.apps files --input /shared/incoming --out /shared/fees
    python -m feeflow.streaming.apps model --train /shared/fees/export --out /shared/model
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from feeflow.models import regression as ml
from feeflow.operators.fees import fee_summary, metrics_payload
from feeflow.operators.flatten import expand
from feeflow.schemas import FEE_TABLE, TX_DOC
from feeflow.session import checkpointed, get_session
from feeflow.sources import broker, files
from feeflow.streaming import jobs


def live_fee_job(
    spark: SparkSession,
    envelope: DataFrame,
    out_root: str,
    payload_col: str = "value",
    trigger: dict | None = None,
    dedup_delay: str | None = None,
) -> StreamingQuery:
    """The live job: broker envelopes -> parsed documents -> what each document adds, in
    ``{out_root}/deltas``; the checkpoint is ``{out_root}/_checkpoint``.

    Redelivered documents count once on read and nothing is dropped. ``dedup_delay`` also drops
    copies ahead of the table, within that watermark, and with them whatever arrives later
    than it. ``live_snapshot`` reads the published snapshot at any time.
    """
    tx = broker.parse_transactions(envelope, payload_col=payload_col).drop("key")
    jobs.create_deltas(spark, f"{out_root}/deltas")
    return jobs.start(
        jobs.dedup_documents(tx, dedup_delay) if dedup_delay else tx,
        "live_fees",
        foreach_batch=jobs.fee_delta_writer(f"{out_root}/deltas"),
        checkpoint=f"{out_root}/_checkpoint",
        trigger=trigger or {"processingTime": "5 seconds"},
    )


def live_snapshot(spark: SparkSession, out_root: str) -> DataFrame:
    """{vol, trans_fees, total_hash} over everything the live job has seen (zeros at first)."""
    return metrics_payload(fee_summary(jobs.fees_from_deltas(spark, f"{out_root}/deltas")))


def file_fee_job(
    spark: SparkSession,
    input_dir: str,
    out_root: str,
    multiline: bool = False,
    trigger: dict | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """The file job: JSON documents -> the distinct items of every batch in ``{out_root}/items``.

    ``export_fees`` turns them into the fee table at any time.
    """
    stream = jobs.json_doc_stream(
        spark, input_dir, TX_DOC, max_files_per_trigger=max_files_per_trigger, multiline=multiline
    )
    return jobs.start(
        expand(stream),
        "file_fees",
        foreach_batch=jobs.item_log_writer(f"{out_root}/items"),
        checkpoint=f"{out_root}/_checkpoint",
        trigger=trigger,
    )


def export_fees(spark: SparkSession, out_root: str) -> str:
    """Write the fee table over all batches so far as CSV (the training data): one row per
    transaction, however many files or deliveries it came in. Returns the folder."""
    path = f"{out_root}/export"
    files.write_table(jobs.fees_from_item_log(spark, f"{out_root}/items"), path, fmt="csv")
    return path


def read_export(spark: SparkSession, export_path: str) -> DataFrame:
    """The exported fee table, with its explicit schema."""
    return files.read_csv_table(spark, export_path, schema=FEE_TABLE)


def model_job(spark: SparkSession, train: DataFrame, score: DataFrame, model_path: str, params=ml.LINEAR_PARAMS):
    """The model job: assemble, split, fit, evaluate, save, and score new transactions.

    Returns (error summary, scored DataFrame). The training table is checkpointed
    first because the fit passes over it many times.
    """
    data = checkpointed(ml.assemble(train))
    fit_part, test_part = ml.hash_split(data)
    model = ml.fit_linear(fit_part, params)
    ml.save(model, model_path)
    errors = ml.error_summary(ml.predict(model, test_part))
    scored = ml.predict(ml.load(model_path), ml.assemble(score)).select("hash", "size", "fee_rate", "prediction")
    return errors, scored


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="feeflow.streaming.apps")
    sub = parser.add_subparsers(dest="job", required=True)
    live = sub.add_parser("live")
    live.add_argument("--bootstrap", required=True)
    live.add_argument("--topic", default=broker.DEFAULT_TOPIC)
    live.add_argument("--out", required=True)
    fjob = sub.add_parser("files")
    fjob.add_argument("--input", required=True)
    fjob.add_argument("--out", required=True)
    fjob.add_argument("--multiline", action="store_true")
    mjob = sub.add_parser("model")
    mjob.add_argument("--train", required=True)
    mjob.add_argument("--score")
    mjob.add_argument("--out", required=True)
    args = parser.parse_args(argv)

    spark = get_session(app_name=f"feeflow-{args.job}")
    if args.job == "live":
        live_fee_job(spark, broker.read_kafka(spark, bootstrap_servers=args.bootstrap, topic=args.topic), args.out)
        spark.streams.awaitAnyTermination()
    elif args.job == "files":
        file_fee_job(spark, args.input, args.out, multiline=args.multiline).awaitTermination()
        export_fees(spark, args.out)
    else:
        train = read_export(spark, args.train)
        score = read_export(spark, args.score) if args.score else train
        errors, scored = model_job(spark, train, score, f"{args.out}/model")
        errors.write.mode("overwrite").json(f"{args.out}/errors")
        scored.write.mode("overwrite").parquet(f"{args.out}/predictions")


if __name__ == "__main__":
    main()
