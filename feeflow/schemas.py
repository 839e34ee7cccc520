"""Schemas of the transaction stream.

The document schema is the broker payload: one unconfirmed transaction with
its arrays of inputs and outputs. Every field is nullable so that a malformed
field turns into NULL instead of failing the whole micro-batch.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The field names and types of the transaction document (COIN, TX_INPUT,
# TX_BODY, TX_DOC) and of the two broker envelopes must equal what the sources publish.

# One spent or created coin: the `prev_out` of an input and each element of `out`.
COIN = StructType(
    [
        StructField("spent", BooleanType()),
        StructField("tx_index", LongType()),
        StructField("type", LongType()),
        StructField("addr", StringType()),
        StructField("value", LongType()),  # satoshi
        StructField("n", LongType()),
        StructField("script", StringType()),
    ]
)

TX_INPUT = StructType(
    [
        # 4294967295 occurs, so this does not fit an int.
        StructField("sequence", LongType()),
        StructField("prev_out", COIN),
        StructField("script", StringType()),
    ]
)

TX_BODY = StructType(
    [
        StructField("lock_time", IntegerType()),
        StructField("ver", IntegerType()),
        StructField("size", IntegerType()),  # bytes; NULL when it does not fit
        StructField("inputs", ArrayType(TX_INPUT)),
        StructField("time", LongType()),  # epoch seconds
        StructField("tx_index", LongType()),
        StructField("vin_sz", LongType()),
        StructField("hash", StringType()),
        StructField("vout_sz", LongType()),
        StructField("relayed_by", StringType()),
        StructField("out", ArrayType(COIN)),
    ]
)

TX_DOC = StructType([StructField("op", StringType()), StructField("x", TX_BODY)])


def fields(schema: StructType, names: dict) -> StructType:
    """``schema`` with only the fields ``names`` (those of nested structs as a dict, None: whole)."""

    def kept(kind, inner):
        if inner is None:
            return kind
        return ArrayType(kept(kind.elementType, inner)) if isinstance(kind, ArrayType) else fields(kind, inner)

    return StructType([StructField(f.name, kept(f.dataType, names[f.name])) for f in schema if f.name in names])


# What the item streams read of a document. Spark's JSON reader builds whole structs, also of columns
# that nothing uses; with this schema it skips their other fields.
_COIN = {"addr": None, "value": None}
ITEM_DOC = fields(TX_DOC, {"op": None, "x": {"hash": None, "size": None, "time": None, "inputs": {"prev_out": _COIN}, "out": _COIN}})

# Envelope of Spark's Kafka source.
KAFKA_ENVELOPE = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
    ]
)

# Envelope of the Pub/Sub Lite source; the payload column is `data`.
PUBSUBLITE_ENVELOPE = StructType(
    [
        StructField("subscription", StringType()),
        StructField("partition", LongType()),
        StructField("offset", LongType()),
        StructField("key", BinaryType()),
        StructField("data", BinaryType()),
        StructField("publish_timestamp", TimestampType()),
        StructField("event_timestamp", TimestampType()),
        StructField("attributes", MapType(StringType(), ArrayType(BinaryType()))),
    ]
)

# Per-transaction fee table.
FEE_TABLE = StructType(
    [
        StructField("hash", StringType()),
        StructField("size", LongType()),
        StructField("in_total", LongType()),
        StructField("out_total", LongType()),
        StructField("fee", LongType()),
        StructField("fee_rate", DoubleType()),
    ]
)

# One row per micro-batch in the metrics table (deltas, summed on read).
METRICS_DELTA = StructType(
    [
        StructField("batch_id", LongType()),
        StructField("n_tx", LongType()),
        StructField("rate_cents", LongType()),
        StructField("out_value", LongType()),
    ]
)

# Column order of the long flat relation (one row per input or per output).
HEADER_COLUMNS = [
    "op",
    "hash",
    "lock_time",
    "ver",
    "size",
    "time",
    "tx_index",
    "vin_sz",
    "vout_sz",
    "relayed_by",
]
ITEM_COLUMNS = [
    "side",
    "sequence",
    "spent",
    "item_tx_index",
    "item_type",
    "addr",
    "value",
    "n",
    "script",
    "sig_script",
]
