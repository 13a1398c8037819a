"""Alerts decided as events come, from a state that is kept between batches.

The state of a run is a row of a bronze table: its last state, the batch that wrote it, and the state before that
batch. A batch that is repeated, after a lost driver say, finds itself in the table and starts from the state before it, and
replaces what it had put out. So every event is decided once, whatever happens between two batches.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewell.functions.keys import row_key
from tidewell.functions.names import KEY_COLUMN
from tidewell.operators.changes import OP, newest_per_key
from tidewell.operators.health import RUN_KEYS, alerts_after, effective_events
from tidewell.operators.ledger import LEDGER_SCHEMA_NAME
from tidewell.session import staged_while
from tidewell.sinks.tables import BronzeStore, create_or_replace, merge_changes

log = logging.getLogger(__name__)

STATE_DDL = f"""
    dag_id STRING, task_id STRING, run_id STRING, state STRING, state_before STRING, batch_id BIGINT, {KEY_COLUMN} STRING
"""


@dataclass(frozen=True)
class AlertJob:
    """Where alerts go, and the table that keeps the states of runs."""

    store: BronzeStore
    output_path: str
    state_table: str = "alert_state"

    @property
    def state_name(self) -> str:
        return self.store.name(LEDGER_SCHEMA_NAME, self.state_table)


def ensure_state(spark: SparkSession, job: AlertJob) -> None:
    if not spark.catalog.tableExists(job.state_name):
        create_or_replace(spark, job.store, LEDGER_SCHEMA_NAME, job.state_table, spark.createDataFrame([], STATE_DDL))


def states_before(states: DataFrame, batch_id: int) -> DataFrame:
    """Run keys and last states as they were when the batch first began; runs that began with it are left out."""
    known = F.when(F.col("batch_id") == batch_id, F.col("state_before")).otherwise(F.col("state"))
    return states.select(*RUN_KEYS, KEY_COLUMN, known.alias("state")).filter(F.col("state").isNotNull())


def alert_batch(batch: DataFrame, batch_id: int, job: AlertJob) -> None:
    """Put out the alerts of one batch below its number, and note the last state of its runs.

    Only runs of the batch are looked up and written: their keys are matched with the table's own buckets.
    """
    spark = batch.sparkSession
    keyed = effective_events(batch).withColumn(KEY_COLUMN, row_key(batch, RUN_KEYS))
    with staged_while(keyed, "events") as events:
        if events.isEmpty():
            log.info("batch %s changes no state", batch_id)
            return
        runs = events.select(KEY_COLUMN).distinct()
        states = spark.table(job.state_name).join(runs, KEY_COLUMN, "left_semi")
        with staged_while(states_before(states, batch_id), "states") as before:
            alerts = alerts_after(events.drop(KEY_COLUMN), before)
            alerts.write.mode("overwrite").parquet(f"{job.output_path}/batch={batch_id}")
            newest = newest_per_key(events, [KEY_COLUMN], [F.desc("event_ts"), F.desc("event_id")])
            earlier = before.select(F.col(KEY_COLUMN).alias("__run"), F.col("state").alias("state_before"))
            noted = newest.join(earlier, F.col(KEY_COLUMN) == F.col("__run"), "left").select(
                *RUN_KEYS, "state", "state_before", F.lit(batch_id).cast("bigint").alias("batch_id"), KEY_COLUMN, F.lit("u").alias(OP)
            )
            merge_changes(spark, job.store, LEDGER_SCHEMA_NAME, job.state_table, noted)


def start_alerts(
    spark: SparkSession, events: DataFrame, job: AlertJob, checkpoint: str, name: str, interval: str | None = None
) -> StreamingQuery:
    """A batch every ``interval``; with None the events there are, and an end.

    Events of a run are expected in their order from batch to batch; one that comes late is decided when it comes.
    """
    ensure_state(spark, job)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        events.writeStream.foreachBatch(lambda batch, batch_id: alert_batch(batch, batch_id, job))
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
