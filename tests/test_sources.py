"""Source options, CSV round trip, session-zone independence, document parts."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from feeflow.operators import fees as fe
from feeflow.operators import flatten as fl
from feeflow.plans.queries import REGISTRY
from feeflow.schemas import FEE_TABLE
from feeflow.sources import broker as br
from feeflow.sources import files as fs
from feeflow.sources import tables as tb
from tests.conftest import SF_SMALL


def test_kafka_options():
    o = br.kafka_options("h:9092", secure={"sasl.mechanism": "PLAIN", "security.protocol": "SASL_SSL"},
                         starting_offsets="earliest", fail_on_data_loss=False, max_offsets_per_trigger=100)
    assert o == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "bitcoin-1", "startingOffsets": "earliest",
        "kafka.group.id": "btc-group", "maxOffsetsPerTrigger": "100", "kafka.sasl.mechanism": "PLAIN",
        "kafka.security.protocol": "SASL_SSL", "failOnDataLoss": "false",
    }
    assert br.pubsublite_options("projects/p/locations/l/subscriptions/s") == {
        "pubsublite.subscription": "projects/p/locations/l/subscriptions/s"
    }


def test_pubsublite_payload_column(spark):
    docs = tb.tx_documents(spark, SF_SMALL)
    env = br.as_envelope(docs, payload_col="data")
    tx = br.parse_transactions(env, payload_col="data")
    assert tx.count() == docs.count()


def test_csv_round_trip(spark):
    fees = REGISTRY["tx_fees"](spark, SF_SMALL)
    path = fs.write_table(fees, tempfile.mkdtemp() + "/csv", fmt="csv")
    back = fs.read_csv_table(spark, path, schema=FEE_TABLE)
    assert back.exceptAll(fees).count() == 0 and fees.exceptAll(back).count() == 0
    inferred = fs.read_csv_table(spark, path)
    assert dict(inferred.dtypes)["fee"] in ("int", "bigint")


def test_results_do_not_depend_on_session_zone(spark):
    names = ("epoch_to_ts", "window_total_trans", "window_event_counts", "metrics_latest")
    utc = {n: sorted(REGISTRY[n](spark, SF_SMALL).collect()) for n in names}
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        for n in names:
            assert sorted(REGISTRY[n](spark, SF_SMALL).collect()) == utc[n], n
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_documents_split_into_bounded_parts(spark):
    docs = tb.tx_documents(spark, SF_SMALL, max_items=2)
    sizes = docs.select(F.size("x.inputs").alias("n"), "x.vin_sz")
    assert sizes.filter("vin_sz > 2").count() > 0
    assert sizes.agg(F.max("n")).first()[0] < sizes.agg(F.max("vin_sz")).first()[0]
    assert sizes.agg(F.avg("n")).first()[0] <= 2.5
    from_parts = fe.fee_table(fl.fee_items(fl.expand(docs)))
    direct = REGISTRY["tx_fees"](spark, SF_SMALL)
    assert from_parts.exceptAll(direct).count() == 0 and direct.exceptAll(from_parts).count() == 0
