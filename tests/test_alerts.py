"""Alerts from batch to batch: any cut of the events gives what all events at once give."""

import random

import pytest

from tidewell.operators.health import alert_transitions, alerts_after, effective_events
from tidewell.sinks.tables import PARQUET, BronzeStore
from tidewell.streaming.alerts import AlertJob, alert_batch, ensure_state, states_before

SCHEMA = "dag_id STRING, task_id STRING, run_id STRING, event_ts TIMESTAMP_NTZ, event_id LONG, try_number INT, state STRING"


def rows(n=160, seed=3):
    """One run has a third of the events; times tie, and some runs have one event only."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        run = "hot" if rng.random() < 0.35 else f"run_{rng.randrange(12)}"
        state = rng.choice(["FAILED", "FAILED", "RETRY", "RECOVERED"])
        out.append(("dag", "task", run, f"2024-01-01 00:{i // 8:02d}:00", i, rng.choice([1, 2]), state))
    return out


def frame(spark, events):
    return spark.createDataFrame(events, SCHEMA.replace("TIMESTAMP_NTZ", "STRING")).selectExpr(
        "* EXCEPT (event_ts)", "CAST(event_ts AS TIMESTAMP_NTZ) AS event_ts"
    )


def found(df):
    return sorted((r["event_id"], r["state"], r["previous_state"], r["opens_thread"]) for r in df.collect())


@pytest.fixture()
def job(spark, folder):
    job = AlertJob(BronzeStore(f"{folder}/wh", provider=PARQUET, buckets=3), f"{folder}/out", f"state_{folder[-6:].lower()}")
    ensure_state(spark, job)
    return job


@pytest.mark.parametrize("cuts", [(), (1, 2, 90), (40, 80, 120)])
def test_any_cut_gives_the_same(spark, job, cuts):
    events = rows()
    edges = [0, *cuts, len(events)]
    for batch_id, (a, b) in enumerate(zip(edges, edges[1:])):
        alert_batch(frame(spark, events[a:b]), batch_id, job)
    assert found(spark.read.parquet(job.output_path)) == found(alert_transitions(frame(spark, events)))


def test_a_repeated_batch_replaces_itself(spark, job):
    events = rows(90, seed=5)
    for batch_id in (0, 1, 1, 2, 2, 2):
        alert_batch(frame(spark, events[30 * batch_id : 30 * batch_id + 30]), batch_id, job)
    assert found(spark.read.parquet(job.output_path)) == found(alert_transitions(frame(spark, events)))


def test_a_batch_that_changes_nothing_leaves_no_trace(spark, job):
    alert_batch(frame(spark, [("d", "t", "r", "2024-01-01 00:00:00", 1, 1, "RECOVERED")]), 0, job)
    assert spark.table(job.state_name).isEmpty()


def test_carried_states_come_first_whatever_their_time(spark):
    late = frame(spark, [("d", "t", "r", "1999-01-01 00:00:00", 1, 2, "RETRY"), ("d", "t", "r", None, 2, 2, "FAILED")])
    carried = spark.createDataFrame([("d", "t", "r", "FAILED"), ("d", "t", "other", "RETRY")], "dag_id STRING, task_id STRING, run_id STRING, state STRING")
    got = found(alerts_after(effective_events(late), carried))
    # A NULL time sorts before the others of its batch; the carried state is still what it is compared with.
    assert got == [(1, "RETRY", "FAILED", False)]


def test_states_as_they_were_before_a_batch(spark):
    states = spark.createDataFrame(
        [("d", "t", "a", "RETRY", "FAILED", 4, "k1"), ("d", "t", "b", "RETRY", None, 4, "k2"), ("d", "t", "c", "FAILED", None, 3, "k3")],
        "dag_id STRING, task_id STRING, run_id STRING, state STRING, state_before STRING, batch_id LONG, id_iceberg STRING",
    )
    assert sorted((r["run_id"], r["state"]) for r in states_before(states, 4).collect()) == [("a", "FAILED"), ("c", "FAILED")]
    assert sorted((r["run_id"], r["state"]) for r in states_before(states, 5).collect()) == [("a", "RETRY"), ("b", "RETRY"), ("c", "FAILED")]
