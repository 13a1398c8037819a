"""The ledger table."""

from __future__ import annotations

import threading
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.ledger import LEDGER_DDL, LEDGER_KEYS, LEDGER_SCHEMA_NAME, LEDGER_TABLE_NAME, merge
from tidewell.sinks.tables import PARQUET, BronzeStore, append_rows, create_schema, repoint_table

# Properties of the ledger table.
LEDGER_PROPERTIES = {
    "format-version": "2",
    "write.metadata.delete-after-commit.enabled": "true",
    "write.metadata.previous-versions-max": "5",
}

PARQUET_TURN = threading.Lock()


def ledger_name(store: BronzeStore) -> str:
    return store.name(LEDGER_SCHEMA_NAME, LEDGER_TABLE_NAME)


def ensure_ledger(spark: SparkSession, store: BronzeStore) -> str:
    """Create the ledger unless it is there."""
    name = ledger_name(store)
    if not spark.catalog.tableExists(name):
        create_schema(spark, store, LEDGER_SCHEMA_NAME)
        properties = ", ".join(f"'{k}' = '{v}'" for k, v in LEDGER_PROPERTIES.items())
        tail = "" if store.provider == PARQUET else f"TBLPROPERTIES ({properties})"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({LEDGER_DDL}) USING {store.provider} "
            f"LOCATION '{store.location(LEDGER_SCHEMA_NAME, LEDGER_TABLE_NAME)}' {tail}"
        )
    return name


def append_ledger(spark: SparkSession, store: BronzeStore, row: DataFrame) -> None:
    """Every topic's stream appends its own rows.

    Row-level formats take appends of any number of writers. Appends to plain Parquet share one
    temporary folder, which the first to finish clears away, so the streams of an application take
    turns; such a ledger must have only one application that writes it at a time.
    """
    with nullcontext() if store.row_level else PARQUET_TURN:
        append_rows(spark, ledger_name(store), row, store.provider)


def merge_ledger(spark: SparkSession, store: BronzeStore, rows: DataFrame) -> None:
    """Keep one row per key, for a job that is the only writer.

    ``rows`` has one row per key. Concurrent writers would conflict here; they append.
    """
    name = ledger_name(store)
    if not store.row_level:
        with PARQUET_TURN:
            repoint_table(spark, name, merge(spark.table(name), rows))
        return
    same_key = F.lit(True)
    for key in LEDGER_KEYS:
        same_key = same_key & (F.col(f"{name}.{key}") == F.col(f"s.{key}"))
    values = {c: F.col(f"s.{c}") for c in rows.columns}
    measures = {c: v for c, v in values.items() if c not in LEDGER_KEYS}
    rows.alias("s").mergeInto(name, same_key).whenMatched().update(measures).whenNotMatched().insert(values).merge()
