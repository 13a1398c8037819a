"""Alert, failure and freshness reports over run events and loaded tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.ordered import with_previous

# States of a task run.
FAILED = "FAILED"
RETRY = "RETRY"
RECOVERED = "RECOVERED"

RUN_KEYS = ("dag_id", "task_id", "run_id")


def effective_events(events: DataFrame) -> DataFrame:
    """Events that may change a run's state: a first-try success changes none, so it is dropped before states are compared."""
    return events.filter((F.col("state") != RECOVERED) | (F.col("try_number") > 1))


def _messages(compared: DataFrame) -> DataFrame:
    repeated = (F.col("state") == FAILED) & F.col("previous_state").eqNullSafe(F.lit(FAILED))
    return compared.filter(~repeated).withColumn("opens_thread", F.col("previous_state").isNull())


def alert_transitions(events: DataFrame) -> DataFrame:
    """Events that send a message: a failure once until the state changes, each retry, and a
    recovery only after a retry.

    The first message of a run opens its thread. Columns besides the run keys: ``event_ts``, ``event_id``,
    ``state``, ``try_number``.
    """
    return _messages(with_previous(effective_events(events), RUN_KEYS, ("event_ts", "event_id"), "state", "previous_state"))


def alerts_after(events: DataFrame, carried: DataFrame) -> DataFrame:
    """The same for effective events that follow others, of whose runs ``carried`` (run keys, ``state``) has the last states.

    A carried state comes before all events of its run, whatever their times. So messages don't depend on how
    events in their order are cut into batches.
    """
    earlier, order = "__follows", ("__follows", "event_ts", "event_id")
    before = carried.select(*RUN_KEYS, "state", F.lit(False).alias(earlier))
    both = events.withColumn(earlier, F.lit(True)).unionByName(before, allowMissingColumns=True)
    compared = with_previous(both, RUN_KEYS, order, "state", "previous_state")
    return _messages(compared.filter(earlier).drop(earlier))


def monthly_failures(alerts: DataFrame) -> DataFrame:
    """Failure messages per month, DAG and task."""
    return (
        alerts.filter(F.col("state") == FAILED)
        .groupBy(F.date_format("event_ts", "yyyyMM").alias("month"), "dag_id", "task_id")
        .agg(F.count("*").alias("failures"))
    )


def freshness(
    loads: DataFrame, keys: tuple[str, ...], time_column: str, now: Column, warn_seconds: int, error_seconds: int
) -> DataFrame:
    """Age of the newest load per table, and whether it passes, warns or is an error.

    A table that was never loaded is an error.
    """
    newest = loads.groupBy(*keys).agg(F.max(time_column).alias("newest_load"))
    age = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("newest_load").cast("timestamp"))
    return newest.withColumn("age_seconds", age).withColumn(
        "status",
        F.when(F.col("age_seconds").isNull() | (F.col("age_seconds") > error_seconds), "error")
        .when(F.col("age_seconds") > warn_seconds, "warn")
        .otherwise("pass"),
    )
