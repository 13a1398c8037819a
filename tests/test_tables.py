"""Bronze tables in plain Parquet, the ledger table and their maintenance."""

import datetime as dt
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidewell.functions.keys import hash_key
from tidewell.operators.ledger import BatchFigures, ledger_row
from tidewell.operators.maintenance import list_files
from tidewell.plans import validate
from tidewell.plans.upkeep import (
    UnlistedFileError,
    compact_buckets,
    compact_table,
    cutoff_text,
    live_files,
    maintain_ledger,
    maintain_tables,
    procedure_calls,
    unused_files,
)
from tidewell.sinks.ledger import append_ledger, ensure_ledger, ledger_name, merge_ledger
from tidewell.sinks.tables import (
    BUCKET_COLUMN,
    PARQUET,
    BronzeStore,
    append_rows,
    buckets_for,
    comment_statements,
    create_or_replace,
    key_bucket,
    merge_changes,
    set_column_comment,
    set_table_comment,
    table_comment,
)
from tidewell.sources.catalog import list_tables, table_or_none
from tidewell.streaming.runner import run_side_by_side


@pytest.fixture()
def store(folder):
    return BronzeStore(folder, provider=PARQUET, buckets=4)


@pytest.fixture()
def schema():
    return f"s{uuid.uuid4().hex[:10]}_bronze"


def keyed(spark, rows):
    df = spark.createDataFrame(rows, "id INT, v STRING")
    return df.withColumn("id_iceberg", hash_key([F.col("id")]))


def changes(spark, rows):
    df = spark.createDataFrame(rows, "id INT, v STRING, __op STRING")
    return df.withColumn("id_iceberg", hash_key([F.col("id")]))


def content(spark, name):
    return sorted((r.id, r.v) for r in spark.table(name).collect())


def test_full_refresh_twice_with_another_schema(spark, store, schema):
    create_or_replace(spark, store, schema, "t", keyed(spark, [(1, "a"), (2, "b")]))
    name = store.name(schema, "t")
    assert content(spark, name) == [(1, "a"), (2, "b")]
    create_or_replace(spark, store, schema, "t", keyed(spark, [(3, "c")]).withColumn("w", F.lit(1.5)))
    assert spark.table(name).columns == ["id", "v", "id_iceberg", "w", BUCKET_COLUMN]
    assert content(spark, name) == [(3, "c")]


def test_table_without_key_has_no_buckets(spark, store, schema):
    create_or_replace(spark, store, schema, "t", spark.range(5).withColumn("v", F.lit("x")))
    assert spark.table(store.name(schema, "t")).columns == ["id", "v"]


def test_readers_never_miss_a_table_that_is_refreshed(spark, store, schema):
    name = store.name(schema, "t")
    create_or_replace(spark, store, schema, "t", spark.range(100).withColumn("v", F.lit(0)))
    seen, done = [], threading.Event()

    def read():
        while not done.is_set():
            seen.append(spark.table(name).agg(F.count("*").alias("n"), F.countDistinct("v").alias("versions")).first())

    with ThreadPoolExecutor(1) as pool:
        reading = pool.submit(read)
        try:
            for version in range(1, 6):
                create_or_replace(spark, store, schema, "t", spark.range(100).withColumn("v", F.lit(version)))
        finally:
            done.set()
        reading.result()
    assert seen and all(tuple(r) == (100, 1) for r in seen)
    assert spark.table(name).first().v == 5


def test_refresh_under_the_name_of_the_catalog(spark, folder, schema):
    store = BronzeStore(folder, catalog="spark_catalog", provider=PARQUET, buckets=2)
    for rows in ([(1, "a")], [(2, "b"), (3, "c")]):
        create_or_replace(spark, store, schema, "t", keyed(spark, rows))
        assert content(spark, store.name(schema, "t")) == rows


def test_refresh_that_fails_leaves_the_table(spark, store, schema):
    create_or_replace(spark, store, schema, "t", keyed(spark, [(1, "a")]))
    name = store.name(schema, "t")
    for failing in (keyed(spark, [(2, "b")]).withColumn("w", F.raise_error("no")), spark.range(2).select(F.raise_error("no").alias("id"))):
        with pytest.raises(Exception, match="no"):
            create_or_replace(spark, store, schema, "t", failing)
        assert content(spark, name) == [(1, "a")]
    create_or_replace(spark, store, schema, "t", spark.range(3))
    assert spark.table(name).columns == ["id"] and spark.table(name).count() == 3
    assert [t.name for t in spark.catalog.listTables(schema)] == ["t"]


def test_compaction_of_a_table_without_key(spark, store, schema):
    name = store.name(schema, "t")
    create_or_replace(spark, store, schema, "t", spark.range(0, 500, 1, 6).withColumn("v", F.lit("x")))
    assert live_files(spark, name).count() == 6
    assert compact_table(spark, name) == 1
    assert live_files(spark, name).count() == 1
    assert spark.table(name).agg(F.sum("id"), F.count("v")).first() == (124750, 500)
    assert compact_table(spark, name) == 0


def test_table_that_reads_from_itself_is_replaced(spark, store, schema):
    create_or_replace(spark, store, schema, "t", keyed(spark, [(1, "a")]))
    name = store.name(schema, "t")
    create_or_replace(spark, store, schema, "t", spark.table(name).drop(BUCKET_COLUMN).withColumn("v", F.lit("z")))
    assert content(spark, name) == [(1, "z")]


def test_merge_writes_deletes_and_empties_a_bucket(spark, store, schema):
    rows = [(i, "old") for i in range(40)]
    create_or_replace(spark, store, schema, "t", keyed(spark, rows))
    name = store.name(schema, "t")
    emptied = [r.id for r in spark.table(name).filter(f"{BUCKET_COLUMN} = 2").collect()]
    batch = [(i, None, "d") for i in emptied] + [(100, "new", "c"), (101, None, "d")]
    left = [i for i in range(40) if i not in emptied]
    batch += [(left[0], "upd", "u"), (left[1], "ignored", None)]
    want = sorted([(i, "upd" if i == left[0] else "old") for i in left] + [(100, "new")])
    for _ in range(2):
        merge_changes(spark, store, schema, "t", changes(spark, batch))
        assert content(spark, name) == want
    merge_changes(spark, store, schema, "t", changes(spark, [(i, "again", "u") for i in emptied]))
    assert content(spark, name) == sorted(want + [(i, "again") for i in emptied if (i, "again") not in want])


def test_merge_leaves_other_buckets_alone(spark, store, schema):
    create_or_replace(spark, store, schema, "t", keyed(spark, [(i, "old") for i in range(40)]))
    name = store.name(schema, "t")
    before = {r.path for r in live_files(spark, name).collect()}
    merge_changes(spark, store, schema, "t", changes(spark, [(1, "new", "u")]))
    after = {r.path for r in live_files(spark, name).collect()}
    assert len(before & after) == 3 and len(after - before) == 1


def test_merge_into_an_empty_table(spark, store, schema):
    create_or_replace(spark, store, schema, "t", keyed(spark, [(1, "a")]).limit(0))
    merge_changes(spark, store, schema, "t", changes(spark, [(1, "new", "u"), (2, None, "d")]))
    assert content(spark, store.name(schema, "t")) == [(1, "new")]


def test_buckets_by_size():
    assert [buckets_for(n) for n in (0, 1 << 30, (1 << 30) + 1, 100 << 40)] == [1, 1, 2, 102_400]


def test_compaction_and_unused_files(spark, store, schema):
    create_or_replace(spark, store, schema, "t", keyed(spark, [(i, "a") for i in range(40)]))
    name = store.name(schema, "t")
    more = keyed(spark, [(i, "b") for i in range(40, 80)]).withColumn(BUCKET_COLUMN, key_bucket(4))
    append_rows(spark, name, more, PARQUET)
    rows = content(spark, name)
    before = live_files(spark, name).count()
    assert before >= 8
    done = maintain_tables(spark, store, [schema], 1)
    assert [tuple(r) for r in done.collect()] == [(name, "compact", "done"), (name, "remove_orphans", "nothing to do")]
    assert content(spark, name) == rows
    assert live_files(spark, name).count() == 4
    listed = list_files(spark, store.location(schema, "t")).count()
    assert listed > 4
    assert unused_files(spark, name, F.lit("2100-01-01").cast("timestamp")).count() == listed - 4
    assert unused_files(spark, name, F.lit("2000-01-01").cast("timestamp")).count() == 0
    # As seen from two days later, the files that compaction replaced are old.
    later = dt.datetime.now(dt.UTC) + dt.timedelta(days=2)
    done = maintain_tables(spark, store, [schema], 1, now=later)
    assert [r.status for r in done.collect()] == ["nothing to do", "done"]
    assert list_files(spark, store.location(schema, "t")).count() == 4
    assert content(spark, name) == rows


def test_nothing_is_unused_when_paths_do_not_match(spark, store, schema, folder):
    create_or_replace(spark, store, schema, "t", keyed(spark, [(i, "a") for i in range(9)]))
    keyed(spark, [(1, "a")]).write.parquet(f"{folder}/other")
    with pytest.raises(UnlistedFileError):
        unused_files(spark, store.name(schema, "t"), F.lit("2100-01-01").cast("timestamp"), f"{folder}/other")


def test_compaction_into_several_files(spark, store, schema):
    create_or_replace(spark, store, schema, "t", keyed(spark, [(i, "a" * 50) for i in range(2000)]))
    name = store.name(schema, "t")
    for part in range(3):
        more = keyed(spark, [(i, "b" * 50) for i in range(2000 * (part + 1), 2000 * (part + 2))])
        append_rows(spark, name, more.withColumn(BUCKET_COLUMN, key_bucket(4)), PARQUET)
    rows = content(spark, name)
    size = live_files(spark, name).agg(F.sum("length")).first()[0]
    compact_buckets(spark, name, target_bytes=size // 8, min_bytes=size)
    assert content(spark, name) == rows
    assert 4 < live_files(spark, name).count() <= 16


@pytest.mark.parametrize("buckets", [1, 2, 4])
def test_each_file_of_a_compaction_has_a_task_of_its_own(spark, folder, schema, buckets):
    store = BronzeStore(folder, provider=PARQUET, buckets=buckets)
    create_or_replace(spark, store, schema, "t", keyed(spark, [(i, "a" * 50) for i in range(4000)]))
    name = store.name(schema, "t")
    more = keyed(spark, [(i, "b" * 50) for i in range(4000, 8000)]).withColumn(BUCKET_COLUMN, key_bucket(buckets))
    append_rows(spark, name, more, PARQUET)
    rows = content(spark, name)
    size = live_files(spark, name).agg(F.sum("length")).first()[0]
    compact_buckets(spark, name, target_bytes=size // (4 * buckets), min_bytes=size)
    assert content(spark, name) == rows
    tasks = spark.table(name).groupBy(F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1).alias("task")).count()
    counts = sorted(r["count"] for r in tasks.collect())
    assert len(counts) >= 4 * buckets and counts[-1] < 1.3 * 8000 / len(counts)


def test_a_large_bucket_is_loaded_by_several_tasks(spark, store, schema):
    want = keyed(spark, [(i, "a") for i in range(2000)])
    create_or_replace(spark, store, schema, "small", want)
    assert live_files(spark, store.name(schema, "small")).count() == 4
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "8k")
    try:
        create_or_replace(spark, store, schema, "t", want)
    finally:
        spark.conf.set(advisory, before)
    name = store.name(schema, "t")
    assert live_files(spark, name).count() >= 8
    assert content(spark, name) == content(spark, store.name(schema, "small"))
    merge_changes(spark, store, schema, "t", changes(spark, [(1999, "z", "u"), (0, None, "d")]))
    merged = {r.id: r.v for r in spark.table(name).collect()}
    assert len(merged) == 1999 and 0 not in merged and merged[1999] == "z"


def test_ledger_is_created_once_appended_and_cleaned(spark, store):
    # The ledger's name is fixed, so a table another test left behind goes first.
    spark.sql(f"DROP TABLE IF EXISTS {ledger_name(store)}")
    assert not maintain_ledger(spark, store, 7)
    for _ in range(2):
        ensure_ledger(spark, store)
    for day in (1, 2, 20):
        at = dt.datetime(2024, 1, day)
        append_ledger(spark, store, ledger_row(spark, ("d", "s", "t"), BatchFigures(1, "2024-01-01 00:00:00.5", 1, 2), day, 0.5, at))
    append_ledger(spark, store, ledger_row(spark, ("d", "s", "idle"), BatchFigures(1), 9, at=dt.datetime(2024, 1, 1)))
    assert maintain_ledger(spark, store, 7, dt.datetime(2024, 1, 21))
    assert sorted(r.batch_id for r in spark.table(ledger_name(store)).collect()) == [9, 20]
    append_ledger(spark, store, ledger_row(spark, ("d", "s", "t"), BatchFigures(0), 21))
    assert spark.table(ledger_name(store)).count() == 3
    merge_ledger(spark, store, ledger_row(spark, ("d", "s", "idle"), BatchFigures(5), 30))
    merge_ledger(spark, store, ledger_row(spark, ("d", "s", "fresh"), BatchFigures(6), 31))
    assert sorted(r.batch_id for r in spark.table(ledger_name(store)).collect()) == [20, 21, 30, 31]
    spark.sql(f"DROP TABLE {ledger_name(store)}")


def test_ledger_takes_rows_of_many_streams(spark, store):
    spark.sql(f"DROP TABLE IF EXISTS {ledger_name(store)}")
    ensure_ledger(spark, store)

    def append(topic):
        for batch in range(3):
            append_ledger(spark, store, ledger_row(spark, ("d", "s", topic), BatchFigures(1), batch))

    outcomes = run_side_by_side(spark, [f"t{i}" for i in range(6)], append, concurrency=6)
    assert {o.status for o in outcomes} == {"done"}
    assert spark.table(ledger_name(store)).select("table_name", "batch_id").distinct().count() == 18
    spark.sql(f"DROP TABLE {ledger_name(store)}")


def test_comments_with_quotes(spark, store, schema):
    create_or_replace(spark, store, schema, "t", keyed(spark, [(1, "a")]))
    name = store.name(schema, "t")
    assert table_comment(spark, name) == ""
    set_table_comment(spark, name, "it's 'so' \\ 상품 목록")
    set_column_comment(spark, name, "v", "it's \\ 상품 번호")
    assert table_comment(spark, name) == "it's 'so' \\ 상품 목록"
    assert spark.table(name).schema["v"].metadata["comment"] == "it's \\ 상품 번호"


def test_comments_of_many_tables_with_one_that_fails(spark, store, schema, monkeypatch):
    monkeypatch.setattr(validate, "TABLES_AT_ONCE", 2)
    rows = []
    for n in range(5):
        create_or_replace(spark, store, schema, f"t{n}", keyed(spark, [(1, "a")]))
        rows += [(schema, f"t{n}", "column_comment", c, f"{c} of 't{n}'") for c in ("id", "v")]
        rows += [(schema, f"t{n}", "table_comment", None, f"table {n}"), (schema, f"t{n}", "column_count", None, "7")]
    rows.append((schema, "gone", "column_comment", "id", "lost"))
    ddl = "bronze_schema STRING, bronze_table STRING, check STRING, column_name STRING, source_value STRING"
    with pytest.raises(RuntimeError, match="1 failed: .*gone"):
        validate.sync_comments(spark, store, spark.createDataFrame(rows, ddl))
    for n in range(5):
        loaded = spark.table(store.name(schema, f"t{n}")).schema
        assert [loaded[c].metadata["comment"] for c in ("id", "v")] == [f"id of 't{n}'", f"v of 't{n}'"]
        assert table_comment(spark, store.name(schema, f"t{n}")) == f"table {n}"
    assert validate.sync_comments(spark, store, spark.createDataFrame(rows[:-1], ddl)) == 15


def test_comments_in_one_statement():
    comments = {"a": "it's", "b`c": "x"}
    one = "ALTER TABLE t ALTER COLUMN `a` COMMENT 'it\\'s', `b``c` COMMENT 'x'"
    assert comment_statements("t", comments, at_once=True) == [one]
    assert len(comment_statements("t", comments, at_once=False)) == 2
    assert comment_statements("t", {}, at_once=True) == []


def test_listing_skips_missing_schemas_and_views(spark, store, schema):
    create_or_replace(spark, store, schema, "t", keyed(spark, [(1, "a")]))
    spark.range(1).createOrReplaceTempView("a_view")
    assert list_tables(spark, ["no_such_schema", schema]) == [store.name(schema, "t")]
    assert table_or_none(spark, "no_such_schema.t") is None


def test_procedure_calls():
    calls = procedure_calls("lake", "lake.s.t", cutoff_text(1, dt.datetime(2024, 1, 2, 3, 4, 5, 999)), 7, 100, 50)
    assert list(calls) == ["compact", "expire_snapshots", "remove_orphans"]
    assert "'target-file-size-bytes', '100', 'min-file-size-bytes', '50'" in calls["compact"]
    assert "older_than => TIMESTAMP '2024-01-01 03:04:05', retain_last => 7" in calls["expire_snapshots"]
    assert calls["remove_orphans"].startswith("CALL lake.system.remove_orphan_files(table => 'lake.s.t'")


def test_failed_tables_are_named_after_the_others_were_done(spark, store, schema):
    native = BronzeStore(store.warehouse, provider="iceberg")
    for table in ("a", "b"):
        create_or_replace(spark, store, schema, table, keyed(spark, [(1, "a")]))
    with pytest.raises(RuntimeError, match=rf"{schema}.a.*{schema}.b"):
        maintain_tables(spark, native, [schema], 1)


def test_row_level_formats_get_a_merge_that_resolves(spark, store, schema):
    """No such format is at hand: Spark analyses the MERGE and then finds that the table cannot do it."""
    create_or_replace(spark, store, schema, "t", keyed(spark, [(1, "a")]))
    native = BronzeStore(store.warehouse, catalog="spark_catalog", provider="iceberg")
    batch = changes(spark, [(1, "b", "u")])
    with pytest.raises(Exception, match="does not support MERGE INTO TABLE"):
        merge_changes(spark, native, schema, "t", batch.withColumn(BUCKET_COLUMN, F.lit(0)))
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        merge_changes(spark, native, schema, "t", batch.drop("v"))
