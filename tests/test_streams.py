"""Change streams, the archive, stop files and side-by-side runs."""

import json
import threading
import time
import uuid
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidewell.functions.frames import build_frame, split_frames, split_value_frames
from tidewell.functions.keys import hash_key
from tidewell.operators.decoding import JSON
from tidewell.operators.ledger import BatchFigures, latest
from tidewell.sinks.ledger import ensure_ledger, ledger_name
from tidewell.sinks.tables import PARQUET, BronzeStore, create_or_replace, data_schema
from tidewell.sources.files import RECORD_SCHEMA, read_parquet, record_file_stream
from tidewell.streaming.archive import archive_batch, start_archive
from tidewell.streaming.cdc import APPLIED, EMPTY, CdcJob, MissingTargetError, apply_batch, run_topic, topic_checkpoint
from tidewell.streaming import listener as listener_module
from tidewell.streaming.listener import ProgressListener, ProgressSink
from tidewell.streaming.runner import DONE, FAILED, run_side_by_side, run_topics
from tidewell.streaming.runner import SKIPPED as NOT_STARTED
from tidewell.streaming.stop import clear_stop, stop_path, stop_requested

KEY_TEXT = json.dumps({"type": "record", "name": "K", "fields": [{"name": "id", "type": "long"}]})


def value_text(time_type, *extra):
    row = {"type": "record", "name": "V", "fields": [
        {"name": "id", "type": "long"}, {"name": "name", "type": ["null", "string"]},
        {"name": "at", "type": ["null", {"type": "long", "connect.name": f"io.debezium.time.{time_type}"}]}, *extra,
    ]}
    return json.dumps({"type": "record", "name": "E", "fields": [
        {"name": "before", "type": ["null", row]}, {"name": "after", "type": ["null", "V"]},
        {"name": "op", "type": "string"}, {"name": "ts_ms", "type": "long"},
    ]})


SCHEMAS = [
    (1, KEY_TEXT),
    (2, value_text("Timestamp")),
    (3, value_text("MicroTimestamp", {"name": "extra", "type": ["null", "string"]})),
]
NINE_HOURS = 9 * 3600 * 1000


def registry(spark):
    return spark.createDataFrame(SCHEMAS, "schema_id INT, schema_str STRING")


def records(spark, topic, rows):
    """rows: (offset, id, op, name, schema id); an op of None is a tombstone."""
    out = []
    for offset, key, op, name, schema in rows:
        at = NINE_HOURS if schema == 2 else NINE_HOURS * 1000
        after = None if op == "d" else {"id": key, "name": name, "at": at, **({"extra": "e"} if schema == 3 else {})}
        body = None if op is None else json.dumps({"after": after, "op": op, "ts_ms": 1700000000000 + offset})
        out.append((json.dumps({"id": key}), body, schema, topic, 0, offset))
    df = spark.createDataFrame(out, "k STRING, v STRING, s INT, topic STRING, partition INT, offset LONG")
    return df.select(
        build_frame(F.lit(1), F.col("k")).alias("key"),
        F.when(F.col("v").isNotNull(), build_frame(F.col("s"), F.col("v"))).alias("value"),
        "topic",
        "partition",
        "offset",
        F.timestamp_millis(F.lit(1700000000000) + F.col("offset")).alias("timestamp"),
    )


@pytest.fixture()
def job(spark, folder):
    run = uuid.uuid4().hex[:8]
    store = BronzeStore(f"{folder}/wh", provider=PARQUET, buckets=3)
    spark.sql(f"DROP TABLE IF EXISTS {ledger_name(store)}")
    ensure_ledger(spark, store)
    rows = spark.sql(
        "SELECT 1L AS id, 'one' AS name, TIMESTAMP '2020-01-01 00:00:00' AS at, TIMESTAMP '2020-01-01 00:00:00' AS last_applied_date"
    ).withColumn("id_iceberg", hash_key([F.col("id")]))
    create_or_replace(spark, store, f"sh{run}_bronze", "items", rows)
    return CdcJob(f"srv.Sh{run}.Items", f"dag{run}", store, registry, JSON)


def bronze(spark, job):
    schema = job.topic.split(".")[1].lower() + "_bronze"
    return spark.table(job.store.name(schema, "items"))


def content(spark, job):
    return sorted((r.id, r.name) for r in bronze(spark, job).collect())


def ledger(spark, job):
    rows = spark.table(ledger_name(job.store)).filter(F.col("dag_id") == job.dag_id)
    return sorted((r.batch_id, r.event_count, r.min_offset, r.max_offset) for r in rows.collect())


def test_two_versions_in_one_batch_newest_wins(spark, job):
    batch = records(spark, job.topic, [
        (1, 1, "u", "older", 3), (2, 1, "u", "newer", 2), (3, 2, "c", "two", 2), (4, 2, "u", "two!", 3),
        (5, 3, "c", "three", 3), (6, 3, "d", None, 2), (7, 3, None, None, 2),
    ])
    result = apply_batch(split_frames(batch), 0, job)
    assert (result.status, result.events, result.tombstones) == (APPLIED, 7, 1)
    assert content(spark, job) == [(1, "newer"), (2, "two!")]
    times = {str(r[0]) for r in bronze(spark, job).select(F.col("at").cast("string")).collect()}
    assert times == {"1970-01-01 00:00:00"}
    assert ledger(spark, job) == [(0, 7, 1, 7)]


def test_replayed_batch_changes_nothing_but_the_ledger(spark, job):
    batch = split_frames(records(spark, job.topic, [(1, 1, "d", None, 2), (2, 2, "c", "two", 2)]))
    for _ in range(2):
        apply_batch(batch, 5, job)
        assert content(spark, job) == [(2, "two")]
    assert ledger(spark, job) == [(5, 2, 1, 2)] * 2
    rows = spark.table(ledger_name(job.store)).filter(F.col("dag_id") == job.dag_id)
    assert latest(rows).count() == 1


def test_empty_batch_and_missing_target(spark, job):
    empty = split_frames(records(spark, job.topic, [(1, 1, "u", "x", 2)])).limit(0)
    assert apply_batch(empty, 1, job).status == EMPTY
    elsewhere = CdcJob("srv.Nowhere.Items", job.dag_id, job.store, job.registry, JSON)
    with pytest.raises(MissingTargetError):
        apply_batch(split_frames(records(spark, "t", [(4, 1, "u", "x", 2)])), 2, elsewhere)
    assert ledger(spark, job) == [(1, 0, None, None)]


def test_batch_of_tombstones_only(spark, job):
    result = apply_batch(split_frames(records(spark, job.topic, [(1, 1, None, None, 2)])), 0, job)
    assert result.tombstones == 1
    assert content(spark, job) == [(1, "one")]


def test_unknown_schema_and_bad_payload_fail_the_batch(spark, job):
    with pytest.raises(LookupError, match="99"):
        apply_batch(split_frames(records(spark, job.topic, [(1, 1, "u", "x", 99)])), 0, job)
    bad = records(spark, job.topic, [(1, 1, "u", "x", 2)]).withColumn("value", build_frame(F.lit(2), F.lit("{nonsense")))
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        apply_batch(split_frames(bad), 0, job)
    assert content(spark, job) == [(1, "one")]


def test_records_without_key_and_schemas_registered_later(spark, job):
    batch = split_frames(records(spark, job.topic, [(1, 1, "u", "x", 2)]))
    with pytest.raises(ValueError, match="no key"):
        apply_batch(batch.withColumn("key_schema_id", F.lit(None).cast("int")), 0, job)
    asked = []

    def growing(session):
        asked.append(1)
        return session.createDataFrame(SCHEMAS[: len(asked) + 1], "schema_id INT, schema_str STRING")

    later = CdcJob(job.topic, job.dag_id, job.store, growing, JSON)
    apply_batch(batch, 1, later)
    apply_batch(batch, 2, later)
    assert len(asked) == 1
    apply_batch(split_frames(records(spark, job.topic, [(2, 1, "u", "y", 3)])), 3, later)
    assert len(asked) == 2
    assert content(spark, job) == [(1, "y")]


def test_stream_goes_on_from_its_checkpoint(spark, job, folder):
    source = f"{folder}/records"
    checkpoint = topic_checkpoint(job.store.warehouse, job.topic)
    seen = []
    for offset, rows in enumerate([[(1, 1, "u", "a", 2)], [(2, 1, "u", "b", 3), (3, 2, "c", "c", 3)], []]):
        if rows:
            records(spark, job.topic, rows).select(*RECORD_SCHEMA.names).coalesce(1).write.mode("append").parquet(source)
        run_topic(spark, job, record_file_stream(spark, source), checkpoint, lambda i, r: seen.append((i, r.events)))
    assert seen == [(0, 1), (1, 2)]
    assert content(spark, job) == [(1, "b"), (2, "c")]


def test_topics_side_by_side_with_one_ledger(spark, job, folder):
    """Three topics at a time, one of them broken; the others are finished and noted."""
    run, topics = uuid.uuid4().hex[:8], []
    for i in range(4):
        topic = f"srv.P{run}x{i}.Items"
        topics.append(topic)
        bronze(spark, job).drop("key_bucket").createOrReplaceTempView("start")
        create_or_replace(spark, job.store, f"p{run}x{i}_bronze", "items", spark.table("start"))
        rows = [(1, 1, "u", f"from {i}", 2), (2, 10 + i, "c", "new", 99 if i == 2 else 3)]
        records(spark, topic, rows).select(*RECORD_SCHEMA.names).coalesce(1).write.parquet(f"{folder}/{topic}")

    def work(topic):
        one = CdcJob(topic, job.dag_id, job.store, registry, JSON)
        run_topic(spark, one, record_file_stream(spark, f"{folder}/{topic}"), topic_checkpoint(folder, topic))

    with pytest.raises(RuntimeError, match=f"1 failed: {topics[2]}"):
        run_topics(spark, topics, work, concurrency=3)
    for i in (0, 1, 3):
        got = spark.table(job.store.name(f"p{run}x{i}_bronze", "items"))
        assert sorted((r.id, r.name) for r in got.collect()) == [(1, f"from {i}"), (10 + i, "new")]
    assert ledger(spark, job) == [(0, 2, 1, 2)] * 3


def test_one_batch_per_file(spark, job, folder):
    source = f"{folder}/records"
    for i in range(3):
        part = records(spark, job.topic, [(i, 1, "u", f"v{i}", 2)]).select(*RECORD_SCHEMA.names)
        part.coalesce(1).write.mode("append").parquet(source)
    run_topic(spark, job, record_file_stream(spark, source, 1), f"{folder}/cp")
    assert [r[0] for r in ledger(spark, job)] == [0, 1, 2]
    assert content(spark, job) == [(1, "v2")]


def test_archive_keeps_versions_and_days(spark, folder):
    rows = [(1, 1, "c", "a", 2), (2, 2, "c", "b", 3), (3, 3, "d", None, 2), (4, 4, None, None, 2)]
    batch = split_value_frames(records(spark, "srv.s.t", rows))
    assert archive_batch(batch, 0, f"{folder}/out", registry, JSON) == 4
    got = read_parquet(spark, f"{folder}/out", merge_schema=True)
    assert sorted((r.op, r.topic, r.year, r.month, r.day) for r in got.collect()) == [
        ("c", "srv.s.t", 2023, 11, 14), ("c", "srv.s.t", 2023, 11, 14), ("d", "srv.s.t", 2023, 11, 14),
    ]
    assert (Path(folder) / "out/topic=srv.s.t/year=2023/month=11/day=14").is_dir()
    assert got.filter("after.extra = 'e'").count() == 1


def test_archive_replay(spark, folder):
    batch = split_value_frames(records(spark, "srv.s.t", [(1, 1, "c", "a", 2), (2, 2, "c", "b", 3)]))
    for path, safe, want in (("plain", False, 4), ("safe", True, 2)):
        for _ in range(2):
            archive_batch(batch, 0, f"{folder}/{path}", registry, JSON, replay_safe=safe)
        archive_batch(batch.limit(0), 1, f"{folder}/{path}", registry, JSON, replay_safe=safe)
        assert read_parquet(spark, f"{folder}/{path}").count() == want


def test_stop_file_ends_a_running_archive(spark, folder):
    source, stop = f"{folder}/records", stop_path(f"file:{folder}", "dag")
    records(spark, "srv.s.t", [(1, 1, "c", "a", 2)]).select(*RECORD_SCHEMA.names).write.parquet(source)
    listener = ProgressListener(spark, stop)
    spark.streams.addListener(listener)
    try:
        query = start_archive(
            spark, record_file_stream(spark, source), f"{folder}/out", f"{folder}/cp", registry, "dag", JSON,
            interval="200 milliseconds",
        )
        deadline = time.time() + 60
        while not listener.progress and time.time() < deadline:
            time.sleep(0.2)
        assert listener.progress[0]["rows"] == 1
        assert listener.rows(spark).select("name", "batch_id", "rows").first() == ("dag", 0, 1)
        assert not stop_requested(spark, stop)
        Path(f"{folder}/spark/signal").mkdir(parents=True)
        Path(f"{folder}/spark/signal/dag").touch()
        records(spark, "srv.s.t", [(2, 2, "c", "b", 2)]).select(*RECORD_SCHEMA.names).write.mode("append").parquet(source)
        assert query.awaitTermination(60)
        deadline = time.time() + 30
        while not listener.ended and time.time() < deadline:
            time.sleep(0.2)
        assert listener.ended[0]["error"] is None
        assert run_topics(spark, ["a"], lambda n: 1 / 0, stop_file=stop)[0].status == NOT_STARTED
        clear_stop(spark, stop)
        assert not stop_requested(spark, stop)
    finally:
        spark.streams.removeListener(listener)


def test_progress_is_bounded_on_the_driver_and_whole_in_the_table(spark, folder, monkeypatch):
    monkeypatch.setattr(listener_module, "KEPT", 3)
    sink = ProgressSink(spark, f"{folder}/progress", batches_a_file=4)
    listener = ProgressListener(spark, sink=sink)
    for n in range(10):
        figures = SimpleNamespace(name="q", batchId=n, numInputRows=n, inputRowsPerSecond=1.0, processedRowsPerSecond=2.0)
        listener.onQueryProgress(SimpleNamespace(progress=figures))
    assert [p["batch_id"] for p in listener.progress] == [7, 8, 9]
    sink.wait()
    assert sink.read().count() == 8
    assert not listener.wait_for_end("r", 0.1)
    for n in range(5):
        listener.onQueryTerminated(SimpleNamespace(id=n, runId="r", exception=None))
    assert len(listener.ended) == 3 and listener.wait_for_end("r", 0.1)
    sink.wait()
    assert sorted(r.batch_id for r in sink.read().collect()) == list(range(10))
    assert len(sink.read().inputFiles()) == 3


def test_progress_that_can_not_be_written_is_given_up(spark, folder):
    Path(f"{folder}/taken").touch()
    sink = ProgressSink(spark, f"{folder}/taken/progress", batches_a_file=1)
    sink.add(("q", 0, 1, 1.0, 1.0))
    sink.wait()


def test_side_by_side_collects_failures_and_bounds_concurrency(spark):
    running, peak, lock, pools = [0], [0], threading.Lock(), {}

    def work(name):
        with lock:
            running[0] += 1
            peak[0] = max(peak[0], running[0])
        pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        time.sleep(0.2)
        with lock:
            running[0] -= 1
        if name == "bad":
            raise ValueError("broken")

    outcomes = run_side_by_side(spark, ["a", "bad", "c", "d"], work, concurrency=2)
    assert [(o.name, o.status) for o in outcomes] == [("a", DONE), ("bad", FAILED), ("c", DONE), ("d", DONE)]
    assert outcomes[1].error == "ValueError: broken"
    assert peak[0] == 2
    assert pools == {n: n for n in ("a", "bad", "c", "d")}
    with pytest.raises(RuntimeError, match="bad: ValueError"):
        run_topics(spark, ["a", "bad"], work)


def test_stop_file_survives_a_failed_run_and_goes_after_a_clean_one(spark, folder):
    stop = stop_path(f"file:{folder}", "dag")
    path = Path(f"{folder}/spark/signal/dag")
    path.parent.mkdir(parents=True)

    def stop_now(name):
        path.touch()

    assert [o.status for o in run_topics(spark, ["a", "b"], stop_now, 1, stop)] == [DONE, NOT_STARTED]
    assert not path.exists()


def test_archive_columns_match_the_bronze_projection(spark, job):
    assert data_schema(bronze(spark, job).schema).names == ["id", "name", "at", "last_applied_date", "id_iceberg"]


def test_figures_come_with_the_pass_that_writes(spark, job, folder, monkeypatch):
    """From the second batch on nothing is counted by itself, and a new schema version is noticed all the same."""
    apply_batch(split_frames(records(spark, job.topic, [(1, 1, "u", "x", 2)])), 0, job)
    known = {}
    first = split_value_frames(records(spark, "t", [(1, 1, "u", "x", 2)]))
    assert archive_batch(first, 0, f"{folder}/out", registry, JSON, known=known) == 1
    more = split_value_frames(records(spark, "t", [(2, 1, "u", "y", 3), (3, 1, "u", "y", 3)]))
    assert archive_batch(more, 1, f"{folder}/out", registry, JSON, known=known) == 2
    assert next(iter(known)) == 3 and spark.read.option("mergeSchema", True).parquet(f"{folder}/out").count() == 3

    def refuse(*_):
        raise AssertionError("counted in a pass of its own")

    monkeypatch.setattr(BatchFigures, "counted", refuse)
    result = apply_batch(split_frames(records(spark, job.topic, [(2, 1, "u", "y", 2), (3, 2, "d", None, 2)])), 1, job)
    assert (result.status, result.events) == (APPLIED, 2)
    result = apply_batch(split_frames(records(spark, job.topic, [(4, 1, "u", "z", 3), (5, 5, "u", "w", 2)])), 2, job)
    assert (result.status, result.events) == (APPLIED, 2)
    assert content(spark, job) == [(1, "z"), (5, "w")]
    assert ledger(spark, job) == [(0, 1, 1, 1), (1, 2, 2, 3), (2, 2, 4, 5)]
