"""The append-only ledger of processed batches."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.changes import newest_per_key, upsert_rows

# Name and columns of the ledger table.
LEDGER_SCHEMA_NAME = "ops_bronze"
LEDGER_TABLE_NAME = "cdc_watermark"
LEDGER_KEYS = ("dag_id", "bronze_schema", "table_name")
LEDGER_DDL = """
    dag_id STRING,
    bronze_schema STRING,
    table_name STRING,
    event_count BIGINT,
    max_event_ts TIMESTAMP,
    processed_at TIMESTAMP,
    min_offset BIGINT,
    max_offset BIGINT,
    batch_id BIGINT,
    processing_duration_sec DOUBLE
"""


@dataclass(frozen=True)
class BatchFigures:
    """What is noted about a batch: how many records, the newest time (text with microseconds, because a driver-side
    timestamp would be shifted to the driver's own zone), first and last offset, records without a value, and the
    pairs of schema ids."""

    events: int = 0
    newest: str | None = None
    first: int | None = None
    last: int | None = None
    tombstones: int = 0
    versions: frozenset[tuple[int | None, int | None]] = frozenset()

    @staticmethod
    def columns(keyed: bool = True) -> list[Column]:
        """The figures as aggregates, which any pass over a batch of split frames can observe."""
        versions = F.struct("value_schema_id", "key_schema_id") if keyed else F.struct("value_schema_id", F.lit(None).cast("int"))
        offsets = [F.min("offset").alias("first"), F.max("offset").alias("last")] if keyed else []
        return [
            F.count(F.lit(1)).alias("events"),
            F.date_format(F.max("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("newest"),
            *offsets,
            F.count_if(F.col("value").isNull()).alias("tombstones"),
            F.collect_set(versions).alias("versions"),
        ]

    @classmethod
    def of(cls, values: Mapping[str, Any]) -> BatchFigures:
        return cls(**{**values, "versions": frozenset(tuple(pair) for pair in values["versions"])})

    @classmethod
    def counted(cls, records: DataFrame, keyed: bool = True) -> BatchFigures:
        """In a pass of their own."""
        return cls.of(records.agg(*cls.columns(keyed)).first().asDict())


class Watched:
    """A batch whose figures come along with the pass that an action makes over it."""

    WAIT_SECONDS = 10.0

    def __init__(self, records: DataFrame, keyed: bool = True):
        self._records, self._keyed = records, keyed
        self._observation = Observation()
        self.records = records.observe(self._observation, *BatchFigures.columns(keyed))

    def figures(self) -> BatchFigures:
        """After the action. Spark hands figures over shortly after it; if it has planned the pass away, as it may where
        nothing can come of it, there are none, and the batch is counted."""
        done = self._observation._jo.future()
        until = time.monotonic() + self.WAIT_SECONDS
        while not done.isCompleted() and time.monotonic() < until:
            time.sleep(0.01)
        if done.isCompleted() and self._observation._jo.getRow().length():
            return BatchFigures.of(self._observation.get)
        return BatchFigures.counted(self._records, self._keyed)


def batch_stats(records: DataFrame) -> DataFrame:
    """Figures of a batch as one row."""
    return records.agg(*BatchFigures.columns()).drop("versions")


def schema_ids(records: DataFrame) -> DataFrame:
    """Distinct pairs of schema ids in a set of framed records."""
    return records.select("value_schema_id", "key_schema_id").distinct()


def ledger_row(
    spark: SparkSession,
    of: tuple[str, str, str],
    figures: BatchFigures,
    batch_id: int | None = None,
    seconds: float | None = None,
    at: dt.datetime | None = None,
) -> DataFrame:
    """What the ledger notes of a batch of one table, which the three ledger keys name; an empty batch has a count of 0
    and NULL measures."""
    noted = {
        **dict(zip(LEDGER_KEYS, of)),
        "event_count": figures.events,
        "max_event_ts": figures.newest,
        "processed_at": None if at is None else at.strftime("%Y-%m-%d %H:%M:%S.%f"),
        "min_offset": figures.first,
        "max_offset": figures.last,
        "batch_id": batch_id,
        "processing_duration_sec": seconds,
    }
    row = spark.createDataFrame([tuple(noted.values())], LEDGER_DDL.replace("TIMESTAMP", "STRING"))
    now = F.current_timestamp() if at is None else F.col("processed_at").cast("timestamp")
    return row.withColumns({"max_event_ts": F.col("max_event_ts").cast("timestamp"), "processed_at": now})


def latest(ledger: DataFrame) -> DataFrame:
    """Newest row per ledger key. A replayed batch is there twice, and the later row wins."""
    return newest_per_key(ledger, LEDGER_KEYS, [F.desc_nulls_last("processed_at"), F.desc_nulls_last("batch_id")])


def merge(ledger: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert of one row per ledger key."""
    return upsert_rows(ledger, updates, LEDGER_KEYS)


def retain(ledger: DataFrame, cutoff: Column) -> DataFrame:
    """Rows that retention keeps: those from the cutoff on, and the newest of each key.

    All rows tied at a key's newest time stay, and rows whose key or time is NULL are never
    deleted. The newest times come from a partial aggregate; the rows are matched by key *and*
    time, so the history of a long-lived key is spread over many tasks.
    """
    moment = F.col("processed_at")
    complete = moment.isNotNull()
    for name in LEDGER_KEYS:
        complete = complete & F.col(name).isNotNull()
    old = complete & (moment < cutoff)
    idle = ledger.groupBy(*LEDGER_KEYS).agg(F.max("processed_at").alias("processed_at")).filter(moment < cutoff)
    kept = ledger.filter(~old)
    newest = ledger.filter(old).join(idle, [*LEDGER_KEYS, "processed_at"], "left_semi").select(ledger.columns)
    return kept.unionByName(newest)
