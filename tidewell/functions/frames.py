"""Wire frames: one magic byte, a four-byte big-endian schema id, the payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER_BYTES = 5


def frame_schema_id(frame: Column) -> Column:
    return F.conv(F.hex(F.substring(frame, 2, 4)), 16, 10).cast("int")


def frame_payload(frame: Column) -> Column:
    return F.substring(frame, F.lit(HEADER_BYTES + 1), F.greatest(F.length(frame) - HEADER_BYTES, F.lit(0)))


def build_frame(schema_id: Column, payload: Column) -> Column:
    """Inverse of the two functions above; used where a broker is not at hand."""
    header = F.unhex(F.lpad(F.hex(schema_id.cast("bigint")), 2 * HEADER_BYTES, "0"))
    return F.concat(header, payload.cast("binary"))


def split_frames(records: DataFrame) -> DataFrame:
    """Broker records -> schema ids and bare payloads; a NULL value (tombstone) gives a NULL id."""
    return records.select(
        frame_schema_id(F.col("key")).alias("key_schema_id"),
        frame_schema_id(F.col("value")).alias("value_schema_id"),
        frame_payload(F.col("key")).alias("key"),
        frame_payload(F.col("value")).alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def split_value_frames(records: DataFrame) -> DataFrame:
    """The archive needs no key."""
    return records.select(
        frame_schema_id(F.col("value")).alias("value_schema_id"),
        frame_payload(F.col("value")).alias("value"),
        "topic",
        "timestamp",
    )
