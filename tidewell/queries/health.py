"""Alerts, failures and freshness over ``events`` and ``lineitem``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import health
from tidewell.queries.registry import derive, query, table

RUN_EVENTS = """
    SELECT 'dag_' || (user_id % 7) AS dag_id, 'task_' || user_id AS task_id, 'run_' || (event_id % 4) AS run_id,
           ts AS event_ts, event_id, 1 + event_id % 3 AS try_number,
           CASE event_type WHEN 'purchase' THEN 'RECOVERED' WHEN 'signup' THEN 'RETRY' ELSE 'FAILED' END AS state
    FROM {events}
"""

ALERTS_SQL = f"""
    SELECT *, previous_state IS NULL AS opens_thread FROM (
        SELECT *, lag(state) OVER (PARTITION BY dag_id, task_id, run_id ORDER BY event_ts, event_id) AS previous_state
        FROM ({RUN_EVENTS}) WHERE state <> 'RECOVERED' OR try_number > 1
    ) WHERE NOT (state = 'FAILED' AND previous_state IS NOT DISTINCT FROM 'FAILED')
"""


@query("alert_transitions", ALERTS_SQL)
def alert_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.alert_transitions(derive(spark, sf_dir, RUN_EVENTS))


@query(
    "monthly_failures",
    f"""
    SELECT strftime(event_ts, '%Y%m') AS month, dag_id, task_id, count(*) AS failures
    FROM ({ALERTS_SQL}) WHERE state = 'FAILED' GROUP BY ALL
    """,
)
def monthly_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.monthly_failures(health.alert_transitions(derive(spark, sf_dir, RUN_EVENTS)))


@query(
    "freshness",
    """
    SELECT l_suppkey, newest_load, age_seconds,
           CASE WHEN age_seconds > 10 * 86400 THEN 'error' WHEN age_seconds > 3 * 86400 THEN 'warn'
                ELSE 'pass' END AS status
    FROM (
        SELECT l_suppkey, max(l_shipdate) AS newest_load,
               date_diff('second', max(l_shipdate), TIMESTAMP '2001-06-01 00:00:00') AS age_seconds
        FROM lineitem GROUP BY l_suppkey
    )
    """,
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit(dt.datetime(2001, 6, 1)).cast("timestamp_ntz")
    loads = table(spark, sf_dir, "lineitem")
    return health.freshness(loads, ("l_suppkey",), "l_shipdate", now, 3 * 86400, 10 * 86400)
