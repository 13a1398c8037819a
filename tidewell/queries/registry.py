"""Registration of queries, and the inputs they share."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import use_utc
from tidewell.sources.files import read_parquet

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Queries do not look at the clock: this is when they run.
RUN_TIME = dt.datetime(2024, 2, 1, 0, 0, 0)
RUN_TIME_SQL = "TIMESTAMP '2024-02-01 00:00:00'"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(function(use_utc(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = plain(sql)
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Rows of a SELECT over test tables, which are written ``{lineitem}`` in it."""
    names = set(re.findall(r"\{(\w+)\}", sql))
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in names})


def plain(sql: str) -> str:
    """The same SELECT for an engine that has the tables under their names."""
    return re.sub(r"\{(\w+)\}", r"\1", sql).strip()


def comparable(df: DataFrame) -> DataFrame:
    """Instants as UTC wall clock, which is how the test tables hold their times."""
    return df.select(
        [F.col(f"`{n}`").cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(f"`{n}`") for n, t in df.dtypes]
    )
