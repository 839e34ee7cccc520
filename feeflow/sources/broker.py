"""Message-broker sources (S1-S4) and payload parsing.

The Kafka and Pub/Sub Lite connectors are external jars; the readers below only
assemble the options and call ``readStream``. Everything after the source works on
the envelope columns, so tests and batch queries feed envelope-shaped frames
through the same ``parse_payload``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feeflow.schemas import TX_DOC

# Fixed values of the live job.
DEFAULT_TOPIC = "bitcoin-1"
DEFAULT_GROUP = "btc-group"


def kafka_options(
    bootstrap_servers: str,
    topic: str = DEFAULT_TOPIC,
    starting_offsets: str = "latest",
    group_id: str | None = DEFAULT_GROUP,
    max_offsets_per_trigger: int | None = None,
    secure: dict[str, str] | None = None,
    fail_on_data_loss: bool | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source.

    ``group_id`` maps to ``kafka.group.id`` (the Spark name). ``secure`` takes
    the SASL settings, e.g. {"sasl.mechanism": "PLAIN", "security.protocol":
    "SASL_SSL", "request.timeout.ms": "...", "session.timeout.ms": "..."}; each
    is passed with the ``kafka.`` prefix.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    for key, value in (secure or {}).items():
        opts[key if key.startswith("kafka.") else f"kafka.{key}"] = value
    if fail_on_data_loss is not None:
        opts["failOnDataLoss"] = str(fail_on_data_loss).lower()
    return opts


def read_kafka(spark: SparkSession, **kwargs) -> DataFrame:
    """Streaming frame with the Kafka envelope; needs the Kafka connector on the classpath."""
    return spark.readStream.format("kafka").options(**kafka_options(**kwargs)).load()


def pubsublite_options(subscription: str, max_messages_per_trigger: int | None = None) -> dict[str, str]:
    """Options of the Pub/Sub Lite source."""
    opts = {"pubsublite.subscription": subscription}
    if max_messages_per_trigger:
        opts["pubsublite.flowcontrol.maxmessagesperbatch"] = str(max_messages_per_trigger)
    return opts


def read_pubsublite(spark: SparkSession, subscription: str, **kwargs) -> DataFrame:
    """Streaming frame with the Pub/Sub Lite envelope (payload column ``data``)."""
    return spark.readStream.format("pubsublite").options(**pubsublite_options(subscription, **kwargs)).load()


def parse_payload(envelope: DataFrame, payload_col: str = "value", schema: StructType = TX_DOC) -> DataFrame:
    """P1 + P2: payload bytes -> text -> struct ``data`` (permissive from_json).

    Junk text gives a NULL struct; a bad field gives NULL for that field only.
    The envelope key is kept as text next to the parsed document.
    """
    cols = [F.from_json(F.col(payload_col).cast("string"), schema).alias("data")]
    if "key" in envelope.columns:
        cols.insert(0, F.col("key").cast("string").alias("key"))
    return envelope.select(*cols)


def parse_transactions(envelope: DataFrame, payload_col: str = "value") -> DataFrame:
    """P1 + P2 + P3: envelope to one row per transaction document, star-expanded."""
    parsed = parse_payload(envelope, payload_col)
    keep = ["key"] if "key" in parsed.columns else []
    return parsed.select(*keep, "data.op", "data.x.*")


CORRUPT = "_corrupt_record"


def parse_checked(envelope: DataFrame, payload_col: str = "value", schema: StructType = TX_DOC) -> DataFrame:
    """P2 in one pass for both outcomes: ``data`` and, where the payload isn't a document of the schema,
    ``reject`` with the raw text (junk, cut-off text, a value that overflows its field, no payload).

    ``parse_payload`` keeps what it can of such a payload; here nothing of it passes as good.
    """
    text = F.col(payload_col).cast("string")
    whole = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = envelope.withColumn("data", F.from_json(text, whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    bad = F.col("data").isNull() | F.col(f"data.{CORRUPT}").isNotNull() | F.col("data.x").isNull()
    return parsed.withColumn("reject", F.when(bad, F.coalesce(text, F.lit(""))))


def accepted(checked: DataFrame) -> DataFrame:
    """The good documents of ``parse_checked``, star-expanded."""
    keep = [F.col("key").cast("string").alias("key")] if "key" in checked.columns else []
    return checked.filter("reject is null").select(*keep, "data.op", "data.x.*")


def rejected(checked: DataFrame) -> DataFrame:
    """The dead letters: key and raw text."""
    keep = [F.col("key").cast("string").alias("key")] if "key" in checked.columns else []
    return checked.filter("reject is not null").select(*keep, F.col("reject").alias("payload"))


def as_envelope(docs: DataFrame, topic: str = DEFAULT_TOPIC, payload_col: str = "value") -> DataFrame:
    """Documents (op, x) serialised into a broker-shaped envelope.

    This is what a producer would publish: the JSON text of each document as the
    payload bytes, keyed by the transaction hash.
    """
    payload = F.to_json(F.struct("op", "x")).cast("binary")
    return docs.select(
        F.col("x.hash").cast("binary").alias("key"),
        payload.alias(payload_col),
        F.lit(topic).alias("topic"),
    )


def select_expr_casts(envelope: DataFrame) -> DataFrame:
    """The ``selectExpr`` form of the casts, as in the console debug sink."""
    return envelope.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


__all__ = [
    "accepted",
    "as_envelope",
    "kafka_options",
    "parse_checked",
    "parse_payload",
    "parse_transactions",
    "pubsublite_options",
    "read_kafka",
    "read_pubsublite",
    "rejected",
    "select_expr_casts",
]
