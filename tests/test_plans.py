"""What Spark makes of the registered queries."""

import re

import pytest
from compare import assert_same

from tidewell.operators import ledger, maintenance
from tidewell.operators.changes import apply_newest, newest_changes
from tidewell.plans.upkeep import retention_delete
from tidewell.queries.ledgers import IDLE_LEDGER
from tidewell.queries.registry import derive
from tidewell.queries import cdc, upkeep
from tidewell.queries.all import ORACLES, QUERIES
from tidewell.session import staged
from tidewell.sinks import tables

STREAMS = [name for name in QUERIES if name.startswith("stream_")]


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STREAMS)))
def test_no_cross_joins_and_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Cross\b", text)
    assert not re.search(r"EvalPython|MapInPandas|FlatMapGroups|MapInArrow|PythonUDF", text)


def test_columns_and_filters_reach_the_scan(spark, small):
    text = plan(QUERIES["snapshots_to_expire"](spark, small))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert scans and all("props" not in scan and "value" not in scan for scan in scans)
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts,2024-01-20T00:00)]" in text


def test_top_rows_are_cut_before_the_shuffle(spark, small):
    for name, limit in (("cdc_dedup", 1), ("composite_key_dedup", 1), ("ledger_latest", 1), ("snapshots_to_expire", 5)):
        assert f"row_number(), {limit}, Partial" in plan(QUERIES[name](spark, small)), name


def without_broadcast(spark, build):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(build())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_nothing_is_broadcast_beyond_the_threshold(spark, small):
    """Only the tables of proven size carry a broadcast hint; these operators have none."""
    changes = cdc.changes(spark, small)
    target = cdc.bronze_orders(spark, small)
    referenced = upkeep.derive(spark, small, upkeep.REFERENCED)
    snapshots = upkeep.derive(spark, small, upkeep.SNAPSHOTS)
    text = without_broadcast(spark, lambda: apply_newest(target, newest_changes(changes)))
    text += without_broadcast(spark, lambda: maintenance.files_of_expired(referenced, snapshots.limit(10)))
    text += without_broadcast(spark, lambda: ledger.merge(*[QUERIES["ledger_latest"](spark, small)] * 2))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_ledger_delete_is_an_equi_join_with_the_rows_of_retain(spark, small):
    """Formats run the DELETE; here its condition selects, which Spark plans alike."""
    derive(spark, small, IDLE_LEDGER).createOrReplaceTempView("ledger_rows")
    text = retention_delete("ledger_rows", "2024-01-24 00:00:00").replace("DELETE FROM", "SELECT * FROM")
    gone = spark.sql(text)
    assert "NestedLoop" not in gone._jdf.queryExecution().executedPlan().toString()
    kept = QUERIES["ledger_retention"](spark, small)
    assert gone.count() > 0 and gone.count() + kept.count() == spark.table("ledger_rows").count()
    assert gone.join(kept, "batch_id").count() == 0


def test_expired_files_need_one_join(spark, small):
    referenced = upkeep.derive(spark, small, upkeep.REFERENCED)
    snapshots = upkeep.derive(spark, small, upkeep.SNAPSHOTS)
    optimized = maintenance.files_of_expired(referenced, snapshots)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bJoin ", optimized)) <= 2  # one for each branch of the referenced files


def test_changes_are_applied_without_moving_the_table(spark, small, folder):
    """Bucket meets bucket: with broadcasts off the table's rows are sorted where they are read, and never exchanged."""
    store = tables.BronzeStore(folder, provider=tables.PARQUET, buckets=8)
    tables.create_or_replace(spark, store, "plans_bronze", "orders", cdc.bronze_orders(spark, small))
    name = store.name("plans_bronze", "orders")
    newest = newest_changes(cdc.changes(spark, small).filter("__op IS NOT NULL"))
    placed = staged(newest.withColumn(tables.BUCKET_COLUMN, tables.key_bucket(8)), "placed")

    def executed():
        merged = tables.merged_buckets(spark, name, placed, list(range(8)))
        return merged._jdf.queryExecution().executedPlan().toString()

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = executed()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = text.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line and "LeftAnti" in line)
    # The table is the join's left child: the lines below it as far as the right child.
    left = []
    for line in lines[join + 1 :]:
        left.append(line)
        if "FileScan" in line:
            break
    assert "Bucketed: true" in text and "orders" in left[-1]
    assert not any("Exchange" in line for line in left), left


@pytest.mark.parametrize(("name", "buckets"), [("compact_roundtrip", 4), ("maintenance_outcomes", 2)])
def test_a_task_that_appends_has_rows_of_one_bucket(spark, small, monkeypatch, name, buckets):
    added = []

    def append(spark, table, rows, provider):
        present = set(spark.table(table).inputFiles())
        tables.append_rows(spark, table, rows, provider)
        added.extend(set(spark.table(table).inputFiles()) - present)

    monkeypatch.setattr(upkeep, "append_rows", append)
    # Buckets of so few rows would share a task.
    coalescing = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalescing)
    spark.conf.set(coalescing, "false")
    try:
        assert_same(QUERIES[name](spark, small), ORACLES[name], small)
    finally:
        spark.conf.set(coalescing, before)
    # The table is read by one task, which would write a file for each bucket.
    assert len(added) == len({re.search(r"/part-(\d+)", path)[1] for path in added}) == buckets
