"""Parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARCHIVE_PARTITIONS = ("topic", "year", "month", "day")


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_archive(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Append to a folder laid out by topic and day.

    Rebalancing keeps a topic's day in few files, and in several where it is large. With a batch
    label the rows go to a ``batch`` level below the day, which a repeated batch overwrites instead
    of adding its rows again.
    """
    if batch is None:
        rows, partitions, mode = df, ARCHIVE_PARTITIONS, "append"
    else:
        rows, partitions, mode = df.withColumn("batch", F.lit(batch)), (*ARCHIVE_PARTITIONS, "batch"), "overwrite"
    (
        rows.hint("rebalance", *partitions)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )
