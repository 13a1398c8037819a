"""Maintenance: which files to rewrite, which snapshots to expire, which files nobody needs."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import maintenance
from tidewell.plans.snapshot import bronze_rows, load_many
from tidewell.plans.upkeep import compact_buckets, live_files, maintain_tables
from tidewell.plans.validate import sync_comments
from tidewell.queries.loads import SNAPSHOT_SQL
from tidewell.queries.registry import RUN_TIME, derive, query, table
from tidewell.session import new_workspace, staged
from tidewell.sinks.tables import (
    PARQUET,
    BronzeStore,
    append_rows,
    create_or_replace,
    data_schema,
    placed_rows,
    table_comment,
)
from tidewell.streaming.runner import raise_failures

FILES = "SELECT 'd/' || l_suppkey AS directory, l_linenumber * 20000000 AS length FROM {lineitem}"


@query(
    "compaction_plan",
    f"""
    SELECT directory, count(*) AS input_files, CAST(sum(length) AS BIGINT) AS input_bytes,
           CAST(ceil(sum(length) / 134217728.0) AS BIGINT) AS output_files
    FROM ({FILES}) WHERE length < 100663296 GROUP BY directory
    HAVING count(*) >= 2 AND ceil(sum(length) / 134217728.0) < count(*)
    """,
)
def compaction_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.compaction_plan(derive(spark, sf_dir, FILES))


LISTED_FILES = """
    SELECT DISTINCT 'd/' || (l_suppkey % 7) AS directory, 'd/' || (l_suppkey % 7) || '/' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS path,
           l_linenumber * 20000000 + l_orderkey AS length
    FROM {lineitem}
"""


@query(
    "compaction_groups",
    f"""
    WITH placed AS (
        SELECT directory, path, length,
               (sum(length) OVER (PARTITION BY directory ORDER BY path) - length) // 134217728 AS group_no
        FROM ({LISTED_FILES}) WHERE length < 100663296
    )
    SELECT directory, path, length, CAST(group_no AS BIGINT) AS group_no FROM placed
    QUALIFY count(*) OVER (PARTITION BY directory, group_no) > 1
    """,
)
def compaction_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small files of a few crowded directories, gathered to files of the target size; large files are not touched."""
    return maintenance.compaction_groups(derive(spark, sf_dir, LISTED_FILES))


SNAPSHOTS = "SELECT 'tb_' || user_id AS table_name, event_id AS snapshot_id, ts AS committed_at FROM {events}"
CUTOFF = dt.datetime(2024, 1, 20)
CUTOFF_SQL = "TIMESTAMP '2024-01-20 00:00:00'"

EXPIRED_SQL = f"""
    SELECT * FROM ({SNAPSHOTS})
    QUALIFY committed_at < {CUTOFF_SQL}
        AND row_number() OVER (PARTITION BY table_name ORDER BY committed_at DESC, snapshot_id DESC) > 5
"""


def _expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.snapshots_to_expire(derive(spark, sf_dir, SNAPSHOTS), F.lit(CUTOFF).cast("timestamp_ntz"))


@query("snapshots_to_expire", EXPIRED_SQL)
def snapshots_to_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expired(spark, sf_dir)


# Each snapshot has a file of its own, and shares one with others of its table.
REFERENCED = """
    SELECT 'tb_' || user_id AS table_name, event_id AS snapshot_id, 'own-' || event_id AS path, event_id * 10 AS length
    FROM {events}
    UNION ALL
    SELECT 'tb_' || user_id, event_id, 'shared-' || (event_id % 40), 4096 FROM {events}
"""


@query(
    "files_of_expired",
    f"""
    WITH expired AS ({EXPIRED_SQL}), referenced AS ({REFERENCED})
    SELECT table_name, path, length FROM referenced
    GROUP BY ALL HAVING bool_and(snapshot_id IN (SELECT snapshot_id FROM expired))
    """,
)
def files_of_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.files_of_expired(derive(spark, sf_dir, REFERENCED), _expired(spark, sf_dir))


LISTED = """
    SELECT 'w/' || o_orderkey || '.parquet' AS path, o_orderkey * 100 AS length, o_orderdate AS "modificationTime"
    FROM {orders}
"""
KNOWN = "SELECT 'w/' || l_orderkey || '.parquet' AS path FROM {lineitem}"


@query(
    "orphan_files",
    f"""
    SELECT path, length, "modificationTime" FROM ({LISTED}) AS f
    WHERE "modificationTime" < TIMESTAMP '1998-01-01 00:00:00' AND path NOT IN (SELECT path FROM ({KNOWN}))
    """,
)
def orphan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    cutoff = F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")
    listed = derive(spark, sf_dir, LISTED.replace('"', "`"))
    return maintenance.orphan_files(listed, derive(spark, sf_dir, KNOWN), cutoff)


@query("compact_roundtrip", SNAPSHOT_SQL)
def compact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bronze table that grew by appends, compacted; the rows stay and the files get fewer."""
    store = BronzeStore(new_workspace(spark, "compact"), provider=PARQUET, buckets=4)
    schema = f"compact_{uuid.uuid4().hex[:12]}_bronze"
    rows = bronze_rows(table(spark, sf_dir, "orders"), ["o_orderkey"], RUN_TIME)
    open_orders = F.col("o_orderstatus") == "O"
    create_or_replace(spark, store, schema, "orders", rows.filter(open_orders))
    name = store.name(schema, "orders")
    append_rows(spark, name, placed_rows(rows.filter(~open_orders), store.buckets), PARQUET)
    before = live_files(spark, name).count()
    rewritten = compact_buckets(spark, name)
    after = live_files(spark, name).count()
    if rewritten and after >= before:
        raise AssertionError(f"{before} files became {after}")
    return spark.table(name).select(*data_schema(spark.table(name).schema).names)


# A table for each priority of orders; the comments say what the loaded rows are.
COMMENTED = """
    SELECT 'p_' || substr(o_orderpriority, 1, 1) AS bronze_table, o_orderpriority || ' it{quote}s' AS table_comment,
           'up to ' || max(o_orderkey) AS key_comment, CAST(min(o_orderdate) AS DATE) || ' and later' AS date_comment,
           count(*) AS rows
    FROM {orders} GROUP BY o_orderpriority
"""
COMMENTED_SQL = COMMENTED.replace("{quote}", "''").replace("bronze_table", "table_name")


@query("comments_synced", COMMENTED_SQL)
def comments_synced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze tables of orders by priority; comments from a drift report, as the catalog tells them afterwards."""
    store = BronzeStore(new_workspace(spark, "comments"), provider=PARQUET, buckets=1)
    schema = f"comments_{uuid.uuid4().hex[:12]}_bronze"
    wanted = staged(derive(spark, sf_dir, COMMENTED.replace("{quote}", "\\'")), "comments")
    orders = table(spark, sf_dir, "orders").withColumn("bronze_table", F.concat(F.lit("p_"), F.substring("o_orderpriority", 1, 1)))
    names = [r.bronze_table for r in wanted.select("bronze_table").collect()]  # one for each priority

    def load(name: str) -> None:
        create_or_replace(spark, store, schema, name, orders.filter(F.col("bronze_table") == name).drop("bronze_table"))

    raise_failures(load_many(spark, names, load))
    issues = F.inline(
        F.array(
            _comment("table_comment", None, "table_comment"),
            _comment("column_comment", "o_orderkey", "key_comment"),
            _comment("column_comment", "o_orderdate", "date_comment"),
        )
    )
    report = wanted.select(F.lit(schema).alias("bronze_schema"), "bronze_table", issues)
    sync_comments(spark, store, report)
    found = []
    for name in names:
        loaded = spark.table(store.name(schema, name))
        texts = {
            "table_name": name,
            "table_comment": table_comment(spark, store.name(schema, name)),
            "key_comment": loaded.schema["o_orderkey"].metadata["comment"],
            "date_comment": loaded.schema["o_orderdate"].metadata["comment"],
        }
        found.append(loaded.agg(F.count("*").alias("rows")).withColumns({k: F.lit(v) for k, v in texts.items()}))
    return reduce(DataFrame.unionByName, found)


def _comment(check: str, column: str | None, value: str) -> Column:
    return F.struct(
        F.lit(check).alias("check"), F.lit(column).cast("string").alias("column_name"), F.col(value).alias("source_value")
    )


@query(
    "maintenance_outcomes",
    """
    WITH loaded AS (SELECT 'orders' AS table_name, count(*) AS rows FROM orders
                    UNION ALL SELECT 'brands', count(DISTINCT p_brand) FROM part)
    SELECT table_name, step, CASE WHEN table_name = 'orders' AND step = 'compact' THEN 'done' ELSE 'nothing to do' END
           AS status, rows
    FROM loaded CROSS JOIN (VALUES ('compact'), ('remove_orphans')) AS steps(step)
    """,
)
def maintenance_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upkeep of a schema: one table grew by appends, the other, an aggregate, is a single file; the rows stay."""
    store = BronzeStore(new_workspace(spark, "upkeep"), provider=PARQUET, buckets=2)
    schema = f"upkeep_{uuid.uuid4().hex[:12]}_bronze"
    orders = bronze_rows(table(spark, sf_dir, "orders"), ["o_orderkey"], RUN_TIME)
    is_open = F.col("o_orderstatus") == "O"
    create_or_replace(spark, store, schema, "orders", orders.filter(is_open))
    append_rows(spark, store.name(schema, "orders"), placed_rows(orders.filter(~is_open), store.buckets), PARQUET)
    brands = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("parts"))
    create_or_replace(spark, store, schema, "brands", brands.coalesce(1))
    done = maintain_tables(spark, store, [schema], retention_days=1)
    done = done.withColumn("table_name", F.substring_index("table_name", ".", -1))
    counted = [
        spark.table(store.name(schema, name)).groupBy(F.lit(name).alias("table_name")).agg(F.count("*").alias("rows"))
        for name in ("orders", "brands")
    ]
    return done.join(counted[0].unionByName(counted[1]), "table_name").select("table_name", "step", "status", "rows")
