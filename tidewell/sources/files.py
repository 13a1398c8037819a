"""Parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """A Parquet folder with its dates as they were written (no calendar rebase)."""
    return (
        spark.read.option("datetimeRebaseMode", "CORRECTED")
        .option("int96RebaseMode", "CORRECTED")
        .option("mergeSchema", str(merge_schema).lower())
        .parquet(path)
    )


def record_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Broker records that were saved as files, as a stream with the columns of the broker source."""
    reader = spark.readStream.format("parquet").schema(RECORD_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
