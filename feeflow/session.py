"""Session construction and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants. AQE re-plans joins and coalesces shuffle partitions at
# run time; skew-join splitting guards the hash-keyed joins against a hot key.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state (dedup keys, open windows) lives off-heap in RocksDB and is
    # checkpointed as changelogs, so large state neither bloats executor heaps nor
    # rewrites full snapshots every micro-batch.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


STATE_STORE = "spark.sql.streaming.stateStore"
STATE_STORE_CONF = {
    f"{STATE_STORE}.providerClass": DEFAULT_CONF[f"{STATE_STORE}.providerClass"],
    f"{STATE_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    # One budget for all state partitions of an executor, however many there are.
    f"{STATE_STORE}.rocksdb.boundedMemoryUsage": "true",
    # Counting the rows looks up every key a second time when it is written; nothing reads these counts.
    f"{STATE_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}
HEAP_STORE = "HDFSBackedStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, also in a session that ``get_session`` didn't
    make: Spark's default store holds all state on the heap and refuses state processors. A stream
    copies the settings when it starts, so the session gets its own back. Another store that
    the session names is left as it is, and so is what it sets for RocksDB.
    """
    provider = spark.conf.get(f"{STATE_STORE}.providerClass", None)
    if provider and not provider.endswith(HEAP_STORE) and provider != STATE_STORE_CONF[f"{STATE_STORE}.providerClass"]:
        yield
        return
    before = {key: spark.conf.get(key, None) for key in STATE_STORE_CONF}
    changed = [key for key, value in before.items() if value is None or key.endswith("providerClass")]
    try:
        for key in changed:
            spark.conf.set(key, STATE_STORE_CONF[key])
        yield
    finally:
        for key in changed:
            if before[key] is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before[key])


def get_session(
    master: str | None = None,
    app_name: str = "feeflow",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) a session with the defaults above.

    ``master`` stays unset on a cluster so that spark-submit decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is visible to every executor.
    Only when it is unset (a laptop or a test) do we pick a temporary folder and
    record it in the session so that all later calls agree.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a folder shared by all executors "
                "(a machine-local temporary folder does not survive the loss of that machine)"
            )
        root = tempfile.mkdtemp(prefix="feeflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/feeflow/{purpose}/{uuid.uuid4().hex}"



def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Used before iterative work (model fitting) that would otherwise recompute the
    whole upstream plan on every pass, and so that a lost executor costs a re-read
    of the checkpoint, not a recomputation from the source tables.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same for wide or nested rows that are read again: as Parquet, compressed and column by column."""
    path = scratch_path(df.sparkSession, f"stored/{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
