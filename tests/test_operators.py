"""Change application, previous values, ledger, drift and maintenance on small fixtures."""

import datetime as dt
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators import drift, health, introspect, ledger, maintenance
from tidewell.operators.changes import apply_changes, newest_changes, union_versions
from tidewell.operators.decoding import column_types, key_columns, reader_schema
from tidewell.operators.ordered import CHUNK, with_previous
from tidewell.session import staged

ROW = "id_iceberg STRING, v INT"
CHANGE = f"{ROW}, __op STRING, __offset LONG"


def applied(spark, target, changes):
    got = apply_changes(spark.createDataFrame(target, ROW), spark.createDataFrame(changes, CHANGE))
    return sorted(tuple(r) for r in got.collect())


def test_changes_edge_rows(spark):
    target = [("keep", 1), ("upd", 1), ("del", 1), ("back", 1), ("noop", 1)]
    changes = [
        ("upd", 2, "u", 1), ("upd", 3, "u", 2), ("del", None, "d", 3), ("unknown", None, "d", 4),
        ("back", None, "d", 5), ("back", 9, "c", 6), ("new", 5, "c", 7), ("gone", 5, "c", 8), ("gone", None, "d", 9),
        ("noop", 7, "u", 10), ("noop", 8, None, 11),
    ]
    want = [("back", 9), ("keep", 1), ("new", 5), ("noop", 7), ("upd", 3)]
    assert applied(spark, target, changes) == want


def test_changes_in_any_order_and_applied_twice(spark):
    rng = random.Random(5)
    target = [(f"k{i}", i) for i in range(50)]
    changes = [(f"k{rng.randrange(80)}", i, rng.choice("cud"), i) for i in range(400)]
    once = applied(spark, target, changes)
    state = dict(target)
    for key, value, op, _ in changes:
        if op == "d":
            state.pop(key, None)
        else:
            state[key] = value
    assert once == sorted(state.items())
    shuffled = changes[:]
    rng.shuffle(shuffled)
    assert applied(spark, target, shuffled) == once
    assert applied(spark, once, changes) == once


def test_any_cut_into_batches_gives_the_same_rows(spark):
    rng = random.Random(7)
    target = [(f"k{i}", i) for i in range(20)]
    changes = [(f"k{rng.randrange(30)}", i, rng.choice(["c", "u", "d", None]), i) for i in range(200)]
    whole = applied(spark, target, changes)
    for cuts in ([0, 1, 200], [0, 60, 61, 130, 200]):
        rows = target
        for since, until in zip(cuts, cuts[1:]):
            rows = applied(spark, rows, changes[since:until])
        assert rows == whole


def test_dedup_cuts_rows_before_the_shuffle(spark):
    plan = newest_changes(spark.createDataFrame([("a", 1, "u", 1)], CHANGE))._jdf.queryExecution().toString()
    partial = plan.rindex("row_number(), 1, Partial")
    assert plan.rindex("Exchange hashpartitioning") < partial


def test_versions_with_different_columns(spark):
    a = spark.createDataFrame([(1, "x")], "i INT, s STRING")
    b = spark.createDataFrame([(2,)], "i INT")
    assert sorted(map(tuple, union_versions([a, b]).collect())) == [(1, "x"), (2, None)]


def brute_previous(rows):
    last, out = {}, []
    for key, pos, value in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        out.append((key, pos, value, last.get(key)))
        last[key] = value
    return sorted(out, key=str)


@pytest.mark.parametrize("chunks", [1, 3, 16])
def test_previous_value_with_a_hot_key(spark, chunks):
    """One key with most rows, NULL keys and NULL values; the hot key spans several chunks."""
    rng = random.Random(chunks)
    keys = ["hot"] * 600 + [f"k{i % 90}" for i in range(300)] + [None] * 50
    rows = [(k, i, rng.choice(["A", "B", None])) for i, k in enumerate(keys)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k STRING, pos LONG, v STRING")
    got = with_previous(df, ["k"], ["pos"], "v", "prev", chunks)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_previous(rows)


def test_previous_value_of_no_rows(spark):
    df = spark.createDataFrame([], "k STRING, pos LONG, v STRING")
    assert with_previous(df, ["k"], ["pos"], "v", "prev").count() == 0


def test_hot_key_is_spread_over_chunks(spark):
    df = spark.range(9000).select(F.when(F.col("id") < 6000, "hot").otherwise("cold").alias("k"), "id")
    ranged = staged(df.repartitionByRange(8, "k", "id").withColumn(CHUNK, F.spark_partition_id()), "t")
    sizes = [r["count"] for r in ranged.groupBy("k", CHUNK).count().collect()]
    assert max(sizes) < 3000


def test_alerts_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(500):
        run = rng.choice(["r1"] * 6 + ["r2", "r3"])
        rows.append(("d", "t", run, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), i, rng.randrange(1, 4),
                     rng.choice(["FAILED", "FAILED", "RETRY", "RECOVERED"])))
    schema = "dag_id STRING, task_id STRING, run_id STRING, event_ts TIMESTAMP, event_id LONG, try_number INT, state STRING"
    state, want = {}, []
    for r in rows:
        run, number, now = r[2], r[5], r[6]
        if now == "RECOVERED" and number <= 1:
            continue
        before = state.get(run)
        if now == "FAILED" and before == "FAILED":
            continue
        want.append((r[4], before is None))
        state[run] = now
    alerts = health.alert_transitions(spark.createDataFrame(rows, schema))
    assert sorted((r.event_id, r.opens_thread) for r in alerts.collect()) == want
    counts = health.monthly_failures(alerts).collect()
    failed = sum(1 for i, _ in want if rows[i][6] == "FAILED")
    assert [(r.month, r.failures) for r in counts] == [("202401", failed)]


def test_freshness_of_a_table_never_loaded(spark):
    rows = spark.createDataFrame([("a", None), ("b", dt.datetime(2024, 1, 1))], "t STRING, at TIMESTAMP")
    now = F.lit("2024-01-01 00:01:00").cast("timestamp")
    got = {r.t: r.status for r in health.freshness(rows, ("t",), "at", now, 30, 90).collect()}
    assert got == {"a": "error", "b": "warn"}


def test_retention_keeps_ties_nulls_and_one_row_per_key(spark):
    def row(dag, table, day, batch):
        at = None if day is None else dt.datetime(2024, 1, day)
        return (dag, "s", table, 1, None, at, None, None, batch, None)

    rows = [
        row("idle", "t", 1, 1), row("idle", "t", 2, 2), row("idle", "t", 2, 3),
        row("busy", "t", 1, 4), row("busy", "t", 20, 5), row("busy", "t", None, 6),
        row(None, "t", 1, 7), row("idle", None, 1, 8),
    ]
    kept = ledger.retain(spark.createDataFrame(rows, ledger.LEDGER_DDL), F.lit("2024-01-10").cast("timestamp"))
    assert sorted(r.batch_id for r in kept.collect()) == [2, 3, 5, 6, 7, 8]


def test_ledger_row_of_an_empty_batch(spark):
    row = ledger.ledger_row(spark, ("d", "s", "it's"), ledger.BatchFigures(), 4)
    assert row.schema.simpleString() == spark.createDataFrame([], ledger.LEDGER_DDL).schema.simpleString()
    got = row.first()
    assert (got.table_name, got.event_count, got.max_event_ts, got.batch_id) == ("it's", 0, None, 4)
    assert got.processed_at is not None


def envelope(fields, first="before"):
    record = {"type": "record", "name": "Value", "fields": fields}
    return json.dumps({"type": "record", "name": "E", "fields": [
        {"name": "op", "type": "string"},
        {"name": first, "type": ["null", record]},
        {"name": "after", "type": ["null", "Value"]},
    ]})


def test_column_types_of_schema_texts(spark):
    texts = [
        (1, envelope([{"name": "id", "type": "int"}, {"name": "n", "type": ["null", "string"]},
                      {"name": "d", "type": [{"type": "int", "connect.name": "X.Date"}, "null"]},
                      {"name": "b", "type": {"type": "bytes", "scale": 1}},
                      {"name": "nothing", "type": "null"}, {"name": "only_null", "type": ["null"]}])),
        (2, json.dumps({"type": "record", "name": "E", "fields": [{"name": "op", "type": "string"}]})),
        (3, "not json"),
    ]
    got = column_types(spark.createDataFrame(texts, "schema_id INT, schema_str STRING"))
    assert sorted((r.schema_id, r.column_name, r.logical_type) for r in got.collect()) == [
        (1, "b", "bytes"), (1, "d", "X.Date"), (1, "id", "int"), (1, "n", "string"), (1, "nothing", "null"),
    ]


def test_key_columns_in_order(spark):
    text = json.dumps({"type": "record", "name": "K", "fields": [{"name": "b", "type": "int"}, {"name": "a", "type": "int"}]})
    got = key_columns(spark.createDataFrame([(1, text)], "schema_id INT, schema_str STRING")).orderBy("position")
    assert [r.column_name for r in got.collect()] == ["b", "a"]


def test_reader_schema_of_an_envelope():
    got = reader_schema(envelope([{"name": "id", "type": "long"}, {"name": "t", "type": ["null", {"type": "long", "connect.name": "x"}]}]))
    assert got.simpleString() == "struct<op:string,before:struct<id:bigint,t:bigint>,after:struct<id:bigint,t:bigint>>"


def test_reader_schema_of_all_kinds_of_types():
    fields = [
        {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["a", "b"]}},
        {"name": "again", "type": ["null", "E"]},
        {"name": "f", "type": {"type": "fixed", "name": "F", "size": 4}},
        {"name": "a", "type": ["null", {"type": "array", "items": ["null", "long"]}]},
        {"name": "m", "type": {"type": "map", "values": "double"}},
        {"name": "n", "type": ["null"]},
    ]
    got = reader_schema(json.dumps({"type": "record", "name": "R", "fields": fields}))
    assert got.simpleString() == "struct<e:string,again:string,f:binary,a:array<bigint>,m:map<string,double>,n:void>"


SOURCE = "table_schema STRING, table_name STRING, position INT, column_name STRING, column_type STRING, nullable BOOLEAN, column_comment STRING"


def report_of(spark, source, target, keys=()):
    matched = drift.schema_report(
        drift.keyed_by_bronze(spark.createDataFrame(source, SOURCE)),
        spark.createDataFrame(target, drift.TARGET_COLUMNS_DDL),
        spark.createDataFrame(list(keys), "bronze_schema STRING, bronze_table STRING"),
        spark.createDataFrame([("s_bronze", "t", "about t")], "bronze_schema STRING, bronze_table STRING, table_comment STRING"),
        spark.createDataFrame([("s_bronze", "t", None)], "bronze_schema STRING, bronze_table STRING, table_comment STRING"),
        "mysql",
    )
    return sorted(((r.check, r.column_name, r.source_value, r.target_value) for r in matched.collect()), key=str)


def test_report_of_one_table(spark):
    source = [
        ("S", "T", 1, "Id", "int(11)", False, "the key"),
        ("S", "T", 2, "Name", "varchar(9)", True, ""),
        ("S", "T", 3, "Price", "decimal(9,2)", True, None),
        ("S", "T", 4, "Added", "date", True, "x"),
        ("S", "T", 5, "id_iceberg", "int", True, "taken"),
    ]
    target = [
        ("s_bronze", "t", 1, "name", "string", True, ""),
        ("s_bronze", "t", 2, "id", "bigint", True, ""),
        ("s_bronze", "t", 3, "price", "decimal(9,4)", True, ""),
        ("s_bronze", "t", 4, "last_applied_date", "timestamp", True, ""),
        ("s_bronze", "t", 5, "id_iceberg", "string", True, ""),
    ]
    got = report_of(spark, source, target)
    assert [g[:2] for g in got] == [
        ("column_comment", "Id"), ("column_comment", "id_iceberg"), ("column_count", None), ("column_order", None),
        ("nullable", "Id"), ("primary_key", None), ("table_comment", None), ("type_class", "Id"),
        ("type_parameters", "Price"), ("unreflected", "Added"), ("unreflected", "id_iceberg"),
    ]
    assert ("column_count", None, "5", "3") in got


def test_report_without_differences(spark):
    source = [("S", "T", 7, "Id", "int", True, None)]
    target = [("s_bronze", "t", 1, "id", "int", True, ""), ("s_bronze", "t", 2, "id_iceberg", "string", True, "")]
    got = report_of(spark, source, target, [("s_bronze", "t"), ("s_bronze", "t")])
    assert [g[0] for g in got] == ["table_comment"]


def test_partition_key_prefers_auto_increment(spark):
    rows = [("s", "a", "d", 1, "date", ""), ("s", "a", "id", 2, "int", "auto_increment"),
            ("s", "b", "x", 1, "varchar", ""), ("s", "b", "y", 3, "datetime", ""), ("s", "b", "z", 2, "int", ""),
            ("s", "c", "x", 1, "text", "")]
    schema = "table_schema STRING, table_name STRING, column_name STRING, ordinal_position INT, data_type STRING, extra STRING"
    got = introspect.partition_keys_mysql(spark.createDataFrame(rows, schema)).collect()
    assert {(r.table_name, r.column_name) for r in got} == {("a", "id"), ("b", "z")}


def test_snapshots_keep_the_newest(spark):
    rows = [("t", i, dt.datetime(2024, 1, i + 1)) for i in range(8)] + [("u", 1, dt.datetime(2023, 1, 1))]
    df = spark.createDataFrame(rows, "table_name STRING, snapshot_id LONG, committed_at TIMESTAMP")
    cutoff = F.lit("2024-01-07").cast("timestamp")
    got = maintenance.snapshots_to_expire(df, cutoff, 3).collect()
    assert sorted((r.table_name, r.snapshot_id) for r in got) == [("t", i) for i in range(5)]
    got = maintenance.snapshots_to_expire(df, F.lit("2024-01-03").cast("timestamp"), 3).collect()
    assert sorted(r.snapshot_id for r in got) == [0, 1]


def test_compaction_plan_skips_large_and_lone_files(spark):
    mib = 1 << 20
    rows = [("a", 10 * mib), ("a", 20 * mib), ("a", 128 * mib), ("b", 1), ("c", 95 * mib), ("c", 95 * mib)]
    plan = maintenance.compaction_plan(spark.createDataFrame(rows, "directory STRING, length LONG")).collect()
    assert {(r.directory, r.input_files, r.output_files) for r in plan} == {("a", 2, 1)}


def test_equal_offsets_are_settled_by_the_partition(spark):
    rows = [("k", "a", 7, 0), ("k", "b", 7, 2), ("k", "c", 7, 1), ("k", "d", 6, 9)]
    changes = spark.createDataFrame(rows, "id_iceberg STRING, v STRING, __offset LONG, __partition INT")
    assert [r.v for r in newest_changes(changes).collect()] == ["b"]


def test_compaction_groups_leave_large_files_alone(spark):
    mb = 1 << 20
    sizes = {"a": [5, 90, 120, 40, 100, 30, 7], "b": [10], "c": [64, 64, 64, 64]}
    files = [(d, f"{d}/{i:02d}", n * mb) for d, own in sizes.items() for i, n in enumerate(own)]
    df = spark.createDataFrame(files, "directory string, path string, length long").repartition(3)
    groups = {}
    for r in maintenance.compaction_groups(df, 128 * mb, 96 * mb).collect():
        groups.setdefault((r["directory"], r["group_no"]), []).append(r["path"])
    assert {k: sorted(v) for k, v in groups.items()} == {
        ("a", 0): ["a/00", "a/01", "a/03"],
        ("a", 1): ["a/05", "a/06"],
        ("c", 0): ["c/00", "c/01"],
        ("c", 1): ["c/02", "c/03"],
    }
    assert maintenance.compaction_groups(df.limit(0)).collect() == []


def fewest_moves(places):
    """Columns outside a longest increasing run, all subsets tried from the largest on."""
    for size in range(len(places), -1, -1):
        for chosen in itertools.combinations(range(len(places)), size):
            if all(places[a] < places[b] for a, b in zip(chosen, chosen[1:])):
                return len(places) - size


def test_fewest_columns_are_moved(spark):
    rng = random.Random(5)
    orders = {f"t{n}": rng.sample(range(n % 9), n % 9) for n in range(60)}
    orders["t_long"] = [*range(1, 1500), 0]
    source = [("S", t, i, f"C{i}", "int", True, None) for t, places in orders.items() for i in range(len(places))]
    target = [
        ("s_bronze", t, 10 * p, f"c{i}", "int", True, "") for t, places in orders.items() for i, p in enumerate(places)
    ]
    matched = drift.matched_columns(
        drift.keyed_by_bronze(spark.createDataFrame(source, SOURCE)),
        spark.createDataFrame(target, drift.TARGET_COLUMNS_DDL),
    )
    moved = {}
    for r in drift.column_moves(matched).collect():
        assert (r.check, r.source_value) == ("column_move", str(int(r.column_name[1:]) + 1))
        assert r.target_value == str(orders[r.bronze_table][int(r.column_name[1:])] + 1)
        moved.setdefault(r.bronze_table, set()).add(int(r.column_name[1:]))
    assert moved.pop("t_long") == {1499}
    for t, places in orders.items():
        if t != "t_long":
            stay = [p for i, p in enumerate(places) if i not in moved.get(t, set())]
            assert stay == sorted(stay) and len(places) - len(stay) == fewest_moves(places)
