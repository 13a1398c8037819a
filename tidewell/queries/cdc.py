"""Change application on bronze orders.

Changes come from ``events``: each event writes or deletes an order. One in five has a key that
orders do not have, so inserts and deletes of unknown keys occur, and a few have no operation.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.keys import row_key
from tidewell.functions.names import KEY_COLUMN, LOAD_TIME_COLUMN
from tidewell.operators.changes import (
    OFFSET,
    OP,
    apply_changes,
    deletes,
    newest_changes,
    newest_per_key,
    union_versions,
    upserts,
    with_operation,
)
from tidewell.plans.snapshot import bronze_rows
from tidewell.queries.registry import RUN_TIME, RUN_TIME_SQL, derive, query, table
from tidewell.session import new_workspace
from tidewell.sinks.tables import PARQUET, BronzeStore, create_or_replace, data_schema, merge_changes

CHANGES = """
    SELECT CASE WHEN event_id % 5 = 0 THEN -1 - user_id * 100 - event_id % 20
                ELSE user_id * 100 + event_id % 20 END AS o_orderkey,
           user_id AS o_custkey, upper(substr(event_type, 1, 1)) AS o_orderstatus, value AS o_totalprice,
           ts AS o_orderdate, event_type AS o_orderpriority, ts AS last_applied_date,
           CASE WHEN event_id % 97 = 0 THEN NULL
                ELSE CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END END AS __op,
           event_id AS __offset
    FROM {events}
"""

NEWEST_SQL = f"""
    SELECT *, md5(CAST(o_orderkey AS VARCHAR)) AS id_iceberg FROM ({CHANGES})
    QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY __offset DESC) = 1
"""

# Changes without an operation go first, so a run over all changes and runs over parts of them agree.
EFFECTIVE_SQL = NEWEST_SQL.replace("QUALIFY", "WHERE __op IS NOT NULL QUALIFY")

COLUMNS_SQL = """
    o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, last_applied_date, id_iceberg
"""

APPLIED_SQL = """
    WITH newest AS ({newest}),
    bronze AS (SELECT *, {now} AS last_applied_date, md5(CAST(o_orderkey AS VARCHAR)) AS id_iceberg FROM orders)
    SELECT {columns} FROM bronze WHERE NOT EXISTS
        (SELECT 1 FROM newest n WHERE n.id_iceberg = bronze.id_iceberg AND n.__op IS NOT NULL)
    UNION ALL
    SELECT {columns} FROM newest WHERE __op <> 'd'
"""


def applied_sql(newest: str) -> str:
    return APPLIED_SQL.format(newest=newest, now=RUN_TIME_SQL, columns=COLUMNS_SQL)


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_rows(table(spark, sf_dir, "orders"), ["o_orderkey"], RUN_TIME)


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive(spark, sf_dir, CHANGES).withColumn(LOAD_TIME_COLUMN, F.col(LOAD_TIME_COLUMN).cast("timestamp"))
    return rows.withColumn(KEY_COLUMN, row_key(rows, ["o_orderkey"]))


@query("cdc_dedup", NEWEST_SQL)
def cdc_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_changes(changes(spark, sf_dir))


@query("cdc_upserts", f"SELECT * EXCLUDE (__op, __offset) FROM ({NEWEST_SQL}) WHERE __op <> 'd'")
def cdc_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upserts(newest_changes(changes(spark, sf_dir))).drop(OP, OFFSET)


@query("cdc_deletes", f"SELECT * EXCLUDE (__op, __offset) FROM ({NEWEST_SQL}) WHERE __op = 'd'")
def cdc_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deletes(newest_changes(changes(spark, sf_dir))).drop(OP, OFFSET)


@query("cdc_apply", applied_sql(EFFECTIVE_SQL))
def cdc_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_changes(bronze_orders(spark, sf_dir), changes(spark, sf_dir))


MULTI_SQL = EFFECTIVE_SQL.replace(
    "event_type AS o_orderpriority", "CASE WHEN event_id % 2 = 0 THEN event_type END AS o_orderpriority"
)


@query("cdc_apply_multiversion", applied_sql(MULTI_SQL))
def cdc_apply_multiversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two schema versions, the older without one column, deduplicated together."""
    rows = changes(spark, sf_dir)
    older = rows.filter(F.col(OFFSET) % 2 != 0).drop("o_orderpriority")
    newer = rows.filter(F.col(OFFSET) % 2 == 0)
    return apply_changes(bronze_orders(spark, sf_dir), union_versions([older, newer]))


@query(
    "composite_key_dedup",
    """
    SELECT * FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
    """,
)
def composite_key_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items as a change log of a table with a key of two columns."""
    order = [F.desc(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")]
    return newest_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], order)


@query("bronze_merge", applied_sql(EFFECTIVE_SQL))
def bronze_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes applied to a bronze table, which rewrites the buckets they fall into."""
    store = BronzeStore(new_workspace(spark, "merge"), provider=PARQUET, buckets=8)
    schema = f"merge_{uuid.uuid4().hex[:12]}_bronze"
    create_or_replace(spark, store, schema, "orders", bronze_orders(spark, sf_dir))
    merge_changes(spark, store, schema, "orders", newest_changes(with_operation(changes(spark, sf_dir))))
    merged = spark.table(store.name(schema, "orders"))
    return merged.select(*data_schema(merged.schema).names)
