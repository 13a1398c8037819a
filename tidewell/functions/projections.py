"""Projections driven by a schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.logical_types import DEFAULT_SOURCE_TZ, cast_logical
from tidewell.functions.names import LOAD_TIME_COLUMN, STAGED_TIME_COLUMN
from tidewell.functions.times import run_time


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip the blanks that fixed-width source columns are padded with."""
    return df.select([_trimmed(field) for field in df.schema.fields])


def trim_and_shift_to_utc(df: DataFrame, source_tz: str = "UTC") -> DataFrame:
    """As :func:`trim_strings`, and timestamps go from the source's wall clock to UTC.

    The time rows were staged at is an instant already and stays.
    """
    return df.select(
        [field.name if field.name == STAGED_TIME_COLUMN else _shifted(field, source_tz) for field in df.schema.fields]
    )


def _trimmed(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    return F.trim(column).alias(field.name) if isinstance(field.dataType, T.StringType) else column


def _shifted(field: T.StructField, source_tz: str) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.TimestampType):
        return F.to_utc_timestamp(column, source_tz).alias(field.name)
    if isinstance(field.dataType, T.TimestampNTZType):
        return F.convert_timezone(F.lit(source_tz), F.lit("UTC"), column).alias(field.name)
    return _trimmed(field)


def stamp(df: DataFrame, now: dt.datetime | None = None, column: str = LOAD_TIME_COLUMN) -> DataFrame:
    return df.withColumn(column, run_time(now))


def stamp_or_rename(df: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """Staged files carry the time they were read from the source; keep it under its final name."""
    if STAGED_TIME_COLUMN in df.columns:
        return df.withColumnRenamed(STAGED_TIME_COLUMN, LOAD_TIME_COLUMN)
    return stamp(df, now)


def project_to_schema(
    df: DataFrame,
    target: T.StructType,
    logical_types: Mapping[str, str] | None = None,
    source_tz: str = DEFAULT_SOURCE_TZ,
    lenient: bool = False,
    also: tuple[str, ...] = (),
) -> DataFrame:
    """Columns of ``df`` in the order, under the names and with the types of ``target``.

    Columns the target lacks are dropped, and one it has but ``df`` lacks is an error.
    ``lenient`` turns values that cannot be cast into NULL instead of failing the job.
    """
    logical_types = logical_types or {}
    columns = []
    for field in target.fields:
        value = cast_logical(F.col(f"`{field.name}`"), logical_types.get(field.name), source_tz)
        value = value.try_cast(field.dataType) if lenient else value.cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns, *also)


def with_date_partitions(df: DataFrame, time_column: str = "timestamp") -> DataFrame:
    """year/month/day text columns of the record time, for a partitioned layout."""
    return df.withColumns(date_parts(F.col(time_column)))


# Partition columns and their formats.
_DATE_PARTS = {"year": "yyyy", "month": "MM", "day": "dd"}


def date_parts(time: Column) -> dict[str, Column]:
    return {name: F.date_format(time, pattern) for name, pattern in _DATE_PARTS.items()}
