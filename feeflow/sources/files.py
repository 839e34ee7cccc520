"""File sources and sinks.

Paths may be local or any Hadoop-compatible URI; on a cluster they must point at
shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from feeflow.schemas import TX_DOC


def read_json_stream(
    spark: SparkSession,
    path: str,
    schema: StructType = TX_DOC,
    max_files_per_trigger: int | None = 1,
    multiline: bool = False,
    glob: str | None = None,
) -> DataFrame:
    """S5 + S3: JSON documents under ``path`` (recursively) as a stream, explicit schema.

    One file per trigger by default, as in the original file job. JSON lines by
    default; ``multiline`` reads one pretty-printed document per file.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    reader = reader.option("multiLine", str(multiline).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.json(path)


def read_parquet_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_files_per_trigger: int | None = 1,
    glob: str | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """Parquet files under ``path`` (recursively) as a stream (e.g. envelopes standing in for a broker).

    ``max_bytes_per_trigger`` (e.g. "1g") admits files up to that size to a micro-batch, and always one."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def read_csv_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A CSV table with a header.

    Pass ``schema`` whenever it is known: inference costs a full extra pass over
    the files, which at scale is as expensive as the query itself.
    """
    reader = spark.read.option("header", "true")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    return reader.csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """K5: export a result as files, written in parallel by the executors (no collect)."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(path)
    return path


def from_rows(spark: SparkSession, rows: list, schema: StructType | str) -> DataFrame:
    """A small in-memory collection as a DataFrame (tests and fixtures only)."""
    return spark.createDataFrame(rows, schema)
