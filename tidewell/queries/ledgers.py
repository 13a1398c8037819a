"""The processing ledger, as rows derived from ``events``: one user is one table, one event one batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tidewell.functions.times import retention_cutoff
from tidewell.operators import ledger
from tidewell.queries.registry import derive, query

# Hours tie, so a key's newest time may be shared by several rows; a few rows have no time or no key.
LEDGER = """
    SELECT 'cdc_' || (user_id % 5) AS dag_id, 's_' || (user_id % 3) || '_bronze' AS bronze_schema,
           CASE WHEN event_id % 499 <> 7 THEN 'tb_' || user_id END AS table_name, event_id * 2 AS event_count,
           ts AS max_event_ts, CASE WHEN event_id % 501 <> 5 THEN date_trunc('hour', ts) END AS processed_at,
           event_id AS min_offset, event_id + 9 AS max_offset, event_id AS batch_id, value AS processing_duration_sec
    FROM {events}
"""

# Times of a user stop early for some, so that whole tables are idle before the cutoff.
IDLE_LEDGER = f"""
    SELECT dag_id, bronze_schema, table_name, event_count, max_event_ts,
           CASE WHEN dag_id = 'cdc_2' AND processed_at >= TIMESTAMP '2024-01-12 00:00:00'
                THEN TIMESTAMP '2024-01-11 00:00:00' ELSE processed_at END AS processed_at,
           min_offset, max_offset, batch_id, processing_duration_sec
    FROM ({LEDGER}) AS l
"""


@query(
    "ledger_latest",
    f"""
    SELECT * FROM ({LEDGER})
    QUALIFY row_number() OVER (PARTITION BY dag_id, bronze_schema, table_name
        ORDER BY processed_at DESC NULLS LAST, batch_id DESC) = 1
    """,
)
def ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.latest(derive(spark, sf_dir, LEDGER))


@query(
    "ledger_merge",
    f"""
    WITH newest AS (
        SELECT * FROM ({LEDGER})
        QUALIFY row_number() OVER (PARTITION BY dag_id, bronze_schema, table_name
            ORDER BY processed_at DESC NULLS LAST, batch_id DESC) = 1
    )
    SELECT dag_id, bronze_schema, table_name, event_count + 1 AS event_count, max_event_ts, processed_at,
           min_offset, max_offset, batch_id, processing_duration_sec FROM newest WHERE min_offset % 2 = 0
    UNION ALL
    SELECT * FROM newest WHERE min_offset % 2 <> 0 OR table_name IS NULL
    UNION ALL
    SELECT dag_id || '_new', bronze_schema, table_name, event_count + 1, max_event_ts, processed_at,
           min_offset, max_offset, batch_id, processing_duration_sec FROM newest WHERE min_offset % 2 <> 0
    """,
)
def ledger_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the keys are updated, and as many new ones are added; a key with a NULL matches nothing."""
    current = ledger.latest(derive(spark, sf_dir, LEDGER))
    updates = current.selectExpr(
        "CASE WHEN min_offset % 2 = 0 THEN dag_id ELSE dag_id || '_new' END AS dag_id",
        "bronze_schema", "table_name", "event_count + 1 AS event_count", "max_event_ts", "processed_at",
        "min_offset", "max_offset", "batch_id", "processing_duration_sec",
    )
    return ledger.merge(current, updates)


@query(
    "ledger_retention",
    f"""
    WITH ledger AS ({IDLE_LEDGER}),
    newest AS (
        SELECT dag_id, bronze_schema, table_name, max(processed_at) AS newest FROM ledger GROUP BY ALL
    )
    SELECT ledger.* FROM ledger LEFT JOIN newest USING (dag_id, bronze_schema, table_name)
    WHERE processed_at IS NULL OR table_name IS NULL
       OR processed_at >= TIMESTAMP '2024-01-24 00:00:00' OR processed_at = newest
    """,
)
def ledger_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive(spark, sf_dir, IDLE_LEDGER)
    return ledger.retain(rows, retention_cutoff(7, dt.datetime(2024, 1, 31)))
