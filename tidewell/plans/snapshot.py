"""Full loads of source tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidewell.functions.keys import row_key
from tidewell.functions.names import KEY_COLUMN, MYSQL, STAGED_TIME_COLUMN, parse_source_table
from tidewell.functions.projections import stamp, stamp_or_rename, trim_and_shift_to_utc, trim_strings
from tidewell.sinks.files import overwrite_parquet
from tidewell.sinks.tables import BronzeStore, create_or_replace
from tidewell.sources.files import read_parquet
from tidewell.sources.jdbc import JdbcSource
from tidewell.sources.metadata import SourceMetadata
from tidewell.streaming.runner import Outcome, run_side_by_side


def bronze_rows(df: DataFrame, primary_key: Sequence[str], now: dt.datetime | None = None) -> DataFrame:
    """Rows of a source table as bronze keeps them: trimmed, stamped, and keyed if there is a key."""
    return with_key(stamp(trim_strings(df), now), primary_key)


def staged_rows(df: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """Rows of a source table as staged Parquet keeps them."""
    return stamp(trim_strings(df), now, STAGED_TIME_COLUMN)


def bronze_rows_from_staged(
    df: DataFrame,
    primary_key: Sequence[str],
    source_tz: str = "UTC",
    now: dt.datetime | None = None,
) -> DataFrame:
    return with_key(stamp_or_rename(trim_and_shift_to_utc(df, source_tz), now), primary_key)


def with_key(df: DataFrame, primary_key: Sequence[str]) -> DataFrame:
    return df.withColumn(KEY_COLUMN, row_key(df, primary_key)) if primary_key else df


def read_source_table(
    spark: SparkSession, metadata: SourceMetadata, table: str, partitions: int, even: bool = False
) -> DataFrame:
    """A source table, read in parallel where it has a column for that.

    Uniform ranges of a number or date cost the database next to nothing. ``even`` asks it for ranges that hold as many
    rows each, which it counts by key, for keys whose values are spread unevenly. A table that has no number or date
    to cut by is read in even ranges of its primary key's first column.
    """
    source = metadata.source
    # A SQL Server connection is made to one database, and names a table within it.
    within = table if source.dialect == MYSQL else table.split(".", 1)[1]
    database = parse_source_table(table, source.dialect).schema
    column = metadata.partition_key_of(table)
    first_key = next(iter(metadata.primary_key_of(table)), None) if partitions > 1 and column is None else None
    if partitions > 1 and (first_key or (even and column)):
        return source.table_by_even_ranges(spark, within, column or first_key, partitions, database)
    return source.scan(spark, within, column, partitions, database)


def load_table(
    spark: SparkSession,
    source: JdbcSource,
    store: BronzeStore,
    table: str,
    partitions: int = 1,
    now: dt.datetime | None = None,
    even: bool = False,
) -> None:
    """Database table -> bronze table."""
    metadata = SourceMetadata(spark, source, [table])
    rows = bronze_rows(read_source_table(spark, metadata, table, partitions, even), metadata.primary_key_of(table), now)
    name = parse_source_table(table, source.dialect)
    size = None if store.row_level or store.buckets else metadata.size_of(table)
    create_or_replace(spark, store, name.bronze_schema, name.bronze_table, rows, size)


def stage_table(
    spark: SparkSession,
    source: JdbcSource,
    base: str,
    table: str,
    partitions: int = 1,
    now: dt.datetime | None = None,
    even: bool = False,
) -> str:
    """Database table -> Parquet folder."""
    df = read_source_table(spark, SourceMetadata(spark, source, [table]), table, partitions, even)
    path = parse_source_table(table, source.dialect).parquet_path(base)
    overwrite_parquet(staged_rows(df, now), path)
    return path


def load_staged(
    spark: SparkSession,
    base: str,
    store: BronzeStore,
    table: str,
    primary_key: Sequence[str],
    source_tz: str = "UTC",
    now: dt.datetime | None = None,
) -> None:
    """Parquet folder -> bronze table."""
    name = parse_source_table(table)
    rows = bronze_rows_from_staged(read_parquet(spark, name.parquet_path(base)), primary_key, source_tz, now)
    create_or_replace(spark, store, name.bronze_schema, name.bronze_table, rows)


def load_many(
    spark: SparkSession, tables: Sequence[str], load: Callable[[str], object], concurrency: int = 3
) -> list[Outcome]:
    """One load per table, some at a time."""
    return run_side_by_side(spark, tables, load, concurrency)


def outcome_rows(spark: SparkSession, outcomes: Sequence[Outcome]) -> DataFrame:
    return spark.createDataFrame(
        [(o.name, o.status, o.error) for o in outcomes], "table_name STRING, status STRING, error STRING"
    )
