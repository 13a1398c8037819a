"""Casts of the change connector's logical types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names the connector gives its logical types.
DATE = "io.debezium.time.Date"
MICRO_TIME = "io.debezium.time.MicroTime"
TIMESTAMP = "io.debezium.time.Timestamp"
MICRO_TIMESTAMP = "io.debezium.time.MicroTimestamp"
ZONED_TIMESTAMP = "io.debezium.time.ZonedTimestamp"

DEFAULT_SOURCE_TZ = "Asia/Seoul"


def cast_logical(
    column: Column, logical_type: str | None, source_tz: str = DEFAULT_SOURCE_TZ, zero_is_null: bool = True
) -> Column:
    """Wire value of a logical type as a Spark value; other types pass through.

    Timestamps carry the source's wall clock, in milliseconds or microseconds, and are
    moved to UTC. A zero stands for a missing value there, because the wire schema
    declares 0 as the default of such columns.
    """
    if logical_type == DATE:
        return F.date_from_unix_date(column.cast("int"))
    if logical_type == MICRO_TIME:
        return F.timestamp_micros(column.cast("bigint"))
    if logical_type in (TIMESTAMP, MICRO_TIMESTAMP):
        ticks = column.cast("bigint")
        if zero_is_null:
            ticks = F.nullif(ticks, F.lit(0).cast("bigint"))
        wall_clock = F.timestamp_millis(ticks) if logical_type == TIMESTAMP else F.timestamp_micros(ticks)
        return F.to_utc_timestamp(wall_clock, source_tz)
    return column
