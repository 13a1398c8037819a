"""Streaming forms, over records that are saved as files with the columns of the broker source.

The records arrive in several deliveries, each worked off by a run of its own that goes on from the
checkpoint, as scheduled runs do. Delivery follows offset order, the way a broker hands out the
records of a key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewell.functions.names import parse_topic
from tidewell.operators.decoding import JSON
from tidewell.plans.snapshot import bronze_rows
from tidewell.queries.cdc import applied_sql
from tidewell.queries.decoding import DECODED_SQL, framed_events, registry
from tidewell.queries.health import ALERTS_SQL, RUN_EVENTS
from tidewell.queries.registry import RUN_TIME, derive, query, table
from tidewell.session import new_workspace
from tidewell.sinks.ledger import ensure_ledger, ledger_name
from tidewell.sinks.tables import PARQUET, BronzeStore, create_or_replace, data_schema
from tidewell.sources.files import RECORD_SCHEMA, read_parquet, record_file_stream
from tidewell.streaming.alerts import AlertJob, start_alerts
from tidewell.streaming.archive import start_archive
from tidewell.streaming.cdc import CdcJob, run_topic, topic_checkpoint
from tidewell.streaming.listener import ProgressListener, ProgressSink
from tidewell.streaming.runner import run_topics

# Days between the deliveries.
DELIVERIES = ("2024-01-08", "2024-01-19")


def deliveries(records: DataFrame, time: str = "timestamp") -> Iterator[DataFrame]:
    """Records by time; the first delivery has all before its end, the last one all that is left, also without a time."""
    since = None
    for until in (*DELIVERIES, None):
        left = F.lit(True) if since is None else F.coalesce(F.col(time) >= F.lit(since), F.lit(True))
        yield records.filter(left if until is None else left & (F.col(time) < F.lit(until)))
        since = until


def deliver(records: DataFrame, folder: str) -> None:
    records.select(*RECORD_SCHEMA.names).write.mode("append").parquet(folder)


def _run_cdc(spark: SparkSession, sf_dir: str) -> tuple[BronzeStore, str, str]:
    """Load orders in full, then work off all changes; gives the store, the topic and the job's name."""
    folder = new_workspace(spark, "stream")
    run = uuid.uuid4().hex[:12]
    store = BronzeStore(f"{folder}/warehouse", provider=PARQUET, buckets=8)
    topic = f"srv.Shop{run}.Orders"
    name = parse_topic(topic)
    orders = bronze_rows(table(spark, sf_dir, "orders"), ["o_orderkey"], RUN_TIME)
    orders = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    create_or_replace(spark, store, name.bronze_schema, name.bronze_table, orders)
    ensure_ledger(spark, store)
    job = CdcJob(topic, f"cdc_{run}", store, registry, JSON)
    for part in deliveries(framed_events(spark, sf_dir, F.lit(topic))):
        deliver(part, f"{folder}/records")
        run_topics(
            spark,
            [topic],
            lambda _: run_topic(
                spark, job, record_file_stream(spark, f"{folder}/records"), topic_checkpoint(store.warehouse, topic)
            ),
        )
    return store, topic, job.dag_id


def _delivery(time: str) -> str:
    """Number of the delivery, and so of the batch, that a record comes with."""
    cases = [f"WHEN {time} < TIMESTAMP '{until} 00:00:00' THEN {i}" for i, until in enumerate(DELIVERIES)]
    return f"CASE {' '.join(cases)} ELSE {len(DELIVERIES)} END"


# What all changes give at once, whatever batches they came in.
STREAMED_SQL = f"""
    SELECT * FROM ({DECODED_SQL}) WHERE __op IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY id_iceberg ORDER BY __offset DESC) = 1
"""


@query("stream_cdc", applied_sql(STREAMED_SQL))
def stream_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze orders after the change stream was worked off in three runs."""
    store, topic, _ = _run_cdc(spark, sf_dir)
    name = parse_topic(topic)
    bronze = spark.table(store.name(name.bronze_schema, name.bronze_table))
    return bronze.select(*data_schema(bronze.schema).names)


@query(
    "stream_ledger",
    f"""
    SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS event_count, max(ts) AS max_event_ts,
           min(event_id) AS min_offset, max(event_id) AS max_offset
    FROM (SELECT *, {_delivery("ts")} AS batch_id FROM events) GROUP BY batch_id
    """,
)
def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the three runs noted in the ledger."""
    store, _, dag_id = _run_cdc(spark, sf_dir)
    return (
        spark.table(ledger_name(store))
        .filter(F.col("dag_id") == dag_id)
        .select("batch_id", "event_count", "max_event_ts", "min_offset", "max_offset")
    )


ARCHIVED_SQL = """
    SELECT 'srv.shop.' || event_type AS topic, CAST(year(ts) AS INTEGER) AS year,
           CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
           CASE WHEN event_id % 97 = 0 THEN NULL
                ELSE CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END END AS op,
           epoch_us(ts) // 1000 AS ts_ms,
           CASE WHEN event_id % 5 = 0 THEN -1 - user_id * 100 - event_id % 20
                ELSE user_id * 100 + event_id % 20 END AS o_orderkey,
           value AS o_totalprice, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) ELSE epoch_us(ts) // 1000 END AS o_orderdate,
           CASE WHEN event_id % 2 = 0 THEN props END AS note
    FROM events
"""


@query("stream_archive", ARCHIVED_SQL)
def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of five topics in the archive, two schema versions side by side."""
    folder = new_workspace(spark, "archive")
    records = framed_events(spark, sf_dir, F.concat(F.lit("srv.shop."), F.col("event_type")))
    for part in deliveries(records):
        deliver(part, f"{folder}/records")
        start_archive(
            spark,
            record_file_stream(spark, f"{folder}/records"),
            f"{folder}/out",
            f"{folder}/checkpoint",
            registry,
            f"archive-{uuid.uuid4().hex[:12]}",
            JSON,
            interval=None,
        ).awaitTermination()
    return _archived(spark, f"{folder}/out")


def _archived(spark: SparkSession, folder: str) -> DataFrame:
    return read_parquet(spark, folder, merge_schema=True).select(
        "topic", "year", "month", "day", "op", "ts_ms",
        "after.o_orderkey", "after.o_totalprice", "after.o_orderdate", "after.note",
    )


FILES_A_BATCH = 4


Start = Callable[[DataFrame, str, str], StreamingQuery]
RATED_INTERVAL = "100 milliseconds"


def _rated_runs(spark: SparkSession, sf_dir: str, start: Start) -> Iterator[StreamingQuery]:
    """Runs, each started with its records, a checkpoint and a name, that take ``FILES_A_BATCH`` files at a time.

    The first run finds a file without records, the second one three deliveries of as many files each as a batch takes.
    """
    folder = new_workspace(spark, "rated")
    records = framed_events(spark, sf_dir, F.concat(F.lit("srv.shop."), F.col("event_type")))
    file_no = F.pmod("offset", F.lit(FILES_A_BATCH)).cast("int")
    parts = [part.repartitionById(FILES_A_BATCH, file_no) for part in deliveries(records)]
    for name, given in (("empty", [records.limit(0)]), ("rated", parts)):
        for part in given:
            deliver(part, f"{folder}/records")
        query = start(record_file_stream(spark, f"{folder}/records", FILES_A_BATCH), f"{folder}/checkpoint", name)
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        yield query


@query("stream_rate", ARCHIVED_SQL)
def stream_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive after rate-limited batches at an interval, one of them without records."""
    out = new_workspace(spark, "archive")

    def start(records: DataFrame, checkpoint: str, name: str) -> StreamingQuery:
        return start_archive(spark, records, out, checkpoint, registry, name, JSON, RATED_INTERVAL)

    for _ in _rated_runs(spark, sf_dir, start):
        pass
    return _archived(spark, out)


@query(
    "stream_progress",
    """
    SELECT 'empty' AS name, 1 AS batches, 0 AS rows, 0 AS first_batch, 0 AS last_batch
    UNION ALL SELECT 'rated', 3, count(*), 1, 3 FROM events
    """,
)
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the progress table tells of runs that keep records as they came.

    Rows are what a batch has read; so an archive, which reads a batch once for each schema version, would have more.
    """
    folder = new_workspace(spark, "progress")
    sink = ProgressSink(spark, f"{folder}/table", batches_a_file=2)
    listener = ProgressListener(spark, sink=sink)

    def start(records: DataFrame, checkpoint: str, name: str) -> StreamingQuery:
        kept = records.writeStream.format(PARQUET).option("path", f"{folder}/kept").queryName(name)
        return kept.option("checkpointLocation", checkpoint).trigger(processingTime=RATED_INTERVAL).start()

    spark.streams.addListener(listener)
    try:
        for run in _rated_runs(spark, sf_dir, start):
            if not listener.wait_for_end(str(run.runId)):
                raise TimeoutError(f"the end of {run.name} was not told")
    finally:
        spark.streams.removeListener(listener)
    sink.wait()
    batches = sink.read().groupBy("name", "batch_id").agg(F.max("rows").alias("rows"))
    return batches.groupBy("name").agg(
        F.count("*").alias("batches"),
        F.sum("rows").alias("rows"),
        F.min("batch_id").alias("first_batch"),
        F.max("batch_id").alias("last_batch"),
    )


@query("stream_alerts", ALERTS_SQL)
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of run events that come in three deliveries, each worked off by a run that goes on from the last one's state."""
    folder = new_workspace(spark, "alerts")
    store = BronzeStore(f"{folder}/warehouse", provider=PARQUET, buckets=4)
    job = AlertJob(store, f"{folder}/out", f"alert_state_{uuid.uuid4().hex[:12]}")
    events = derive(spark, sf_dir, RUN_EVENTS)
    for part in deliveries(events, "event_ts"):
        part.write.mode("append").parquet(f"{folder}/events")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/events")
        start_alerts(spark, stream, job, f"{folder}/checkpoint", f"alerts-{uuid.uuid4().hex[:12]}").awaitTermination()
    return read_parquet(spark, f"{folder}/out").drop("batch")
