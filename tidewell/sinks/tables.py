"""Bronze tables: full refresh, row-level changes, comments.

With a table format that has row-level operations (Iceberg, Delta) changes go through MERGE. For
plain Parquet tables the catalog's own partitions do the job: the table is partitioned by a bucket
of the key hash, only buckets with changes are rewritten, each to a new folder, and the partition
is then pointed to that folder. Readers see a bucket before or after a batch, never half written,
and a batch that is applied again gives the same rows.
"""

from __future__ import annotations

import logging
import math
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.names import KEY_COLUMN
from tidewell.operators.changes import DELETE, OP, apply_newest
from tidewell.session import staged_while

log = logging.getLogger(__name__)

BUCKET_COLUMN = "key_bucket"
BUCKET_BYTES = 1 << 30
MAX_BUCKETS = "spark.sql.sources.bucketing.maxBuckets"
AUTO_BUCKETED = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
PARQUET = "parquet"
ICEBERG = "iceberg"

# Properties of a bronze table.
FORMAT_PROPERTIES = {"format-version": "2"}
KEYED_PROPERTIES = {
    "write.metadata.delete-after-commit.enabled": "true",
    "write.metadata.previous-versions-max": "5",
    "history.expire.max-snapshot-age-ms": "86400000",
}


@dataclass(frozen=True)
class BronzeStore:
    """Where bronze tables live and in which format.

    ``buckets`` applies to Parquet tables. If it is not set, a table gets as many as its size in
    the source asks for.
    """

    warehouse: str
    catalog: str | None = None
    provider: str = ICEBERG
    buckets: int | None = None

    @property
    def row_level(self) -> bool:
        return self.provider != PARQUET

    def name(self, schema: str, table: str) -> str:
        return ".".join(filter(None, (self.catalog, schema, table)))

    def location(self, schema: str, table: str | None = None) -> str:
        return "/".join(filter(None, (self.warehouse.rstrip("/"), schema, table)))


def create_schema(spark: SparkSession, store: BronzeStore, schema: str) -> None:
    name = ".".join(f"`{part}`" for part in (store.catalog, schema) if part)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{_escaped(store.location(schema))}'")


def data_schema(schema: T.StructType) -> T.StructType:
    """Columns of a bronze table without the one that only places the rows."""
    return T.StructType([field for field in schema.fields if field.name != BUCKET_COLUMN])


def buckets_for(size_bytes: int) -> int:
    """Buckets of about a gigabyte at any size, so that a few changes rewrite little of a large table."""
    return max(1, math.ceil(size_bytes / BUCKET_BYTES))


def planned_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the rows' size, for tables whose source tells none.

    A source without statistics counts as Spark's default size, which is far too large to be true.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    unknown = int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1)).rstrip("bB"))
    return size if size < unknown else 0


def key_bucket(buckets: int) -> Column:
    """The number of Spark's bucket of a key."""
    return F.pmod(F.hash(KEY_COLUMN), F.lit(buckets)).cast("int")


def placed_rows(df: DataFrame, buckets: int) -> DataFrame:
    """Keyed rows with their buckets, dealt out by bucket; adaptive execution cuts large ones into several tasks, and so
    into several files. Tasks of the source would each sort whatever they read and write a file for every bucket."""
    return df.withColumn(BUCKET_COLUMN, key_bucket(buckets)).hint("rebalance", buckets, KEY_COLUMN)


def create_or_replace(
    spark: SparkSession,
    store: BronzeStore,
    schema: str,
    table: str,
    df: DataFrame,
    size_bytes: int | None = None,
) -> None:
    """Full refresh of a bronze table, keyed if ``df`` has the key hash.

    Row-level formats replace a table at once. A Parquet table without a key that keeps its columns is pointed to the new
    rows, also at once. Any other is made whole under a name of its own and then takes the place of the old one: between
    two statements to the catalog, however long its partitions took, there is no table.
    """
    create_schema(spark, store, schema)
    name = store.name(schema, table)
    keyed = KEY_COLUMN in df.columns
    if store.row_level:
        writer = df.writeTo(name).using(store.provider)
        properties = FORMAT_PROPERTIES | (KEYED_PROPERTIES if keyed else {})
        for key, value in {"location": store.location(schema, table), **properties}.items():
            writer = writer.tableProperty(key, value)
        writer.createOrReplace()
        return
    folder = new_folder(store.location(schema, table))
    buckets = store.buckets or buckets_for(planned_bytes(df) if size_bytes is None else size_bytes)
    if keyed:
        allow_buckets(spark, buckets)
        write_buckets(spark, name, placed_rows(df, buckets), folder, buckets)
    else:
        df.write.parquet(folder)
    columns = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if not keyed and _columns_of(spark, name) == columns:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
        return
    if keyed:
        columns.append((BUCKET_COLUMN, "int"))
    ddl = ", ".join(f"`{column}` {kind}" for column, kind in columns)
    layout = f"PARTITIONED BY ({BUCKET_COLUMN}) CLUSTERED BY ({KEY_COLUMN}) INTO {buckets} BUCKETS" if keyed else ""
    new = _beside(name)
    spark.sql(
        f"CREATE TABLE {new} ({ddl}) USING parquet {layout} TBLPROPERTIES ('buckets' = '{buckets}') LOCATION '{folder}'"
    )
    if keyed:
        spark.catalog.recoverPartitions(new)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    within_catalog = ".".join(name.split(".")[-2:])
    spark.sql(f"ALTER TABLE {new} RENAME TO {within_catalog}")
    spark.catalog.refreshTable(name)


def _columns_of(spark: SparkSession, name: str) -> list[tuple[str, str]] | None:
    """Columns of a table, or None if it is not there."""
    if not spark.catalog.tableExists(name):
        return None
    return [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema.fields]


def _beside(name: str) -> str:
    """A new name in the schema of a table."""
    *schema, table = name.split(".")
    return ".".join([*schema, f"{table}_{uuid.uuid4().hex}"])


def merge_changes(
    spark: SparkSession,
    store: BronzeStore,
    schema: str,
    table: str,
    newest: DataFrame,
    op: str = OP,
    staged: bool = False,
) -> None:
    """Apply one row per key: write it, or delete it where the operation says so.

    ``staged`` says that reading ``newest`` several times costs no more than reading a file.
    """
    name = store.name(schema, table)
    if not store.row_level:
        _merge_into_buckets(spark, name, newest, op, staged)
        return
    columns = [f.name for f in spark.table(name).schema.fields]
    values = {c: F.col(f"s.`{c}`") for c in columns}
    writes = F.col(f"s.{op}") != DELETE
    (
        newest.alias("s")
        .mergeInto(name, F.col(f"{name}.{KEY_COLUMN}") == F.col(f"s.{KEY_COLUMN}"))
        .whenMatched(F.col(f"s.{op}") == DELETE)
        .delete()
        .whenMatched(writes)
        .update(values)
        .whenNotMatched(writes)
        .insert(values)
        .merge()
    )


def merged_buckets(spark: SparkSession, name: str, newest: DataFrame, changed: list[int], op: str = OP) -> DataFrame:
    """Rows of some buckets after their newest changes (with their buckets) are applied.

    Changes go to the buckets of the table, whose own rows need no exchange: a join by key is one of bucket with bucket.
    """
    target = spark.table(name).filter(F.col(BUCKET_COLUMN).isin(changed))
    return apply_newest(target, newest.repartition(bucket_count(spark, name), KEY_COLUMN), KEY_COLUMN, op)


def _merge_into_buckets(spark: SparkSession, name: str, newest: DataFrame, op: str, staged: bool) -> None:
    buckets = bucket_count(spark, name)
    placed = newest.filter(F.col(op).isNotNull()).withColumn(BUCKET_COLUMN, key_bucket(buckets))
    # Used for the bucket numbers, the keys to take out and the rows to write.
    with nullcontext(placed) if staged else staged_while(placed, "newest") as placed:
        # At most one row per bucket of the table.
        changed = sorted(row[0] for row in placed.select(BUCKET_COLUMN).distinct().collect())
        if not changed:
            return
        folder = new_folder(table_folder(spark, name))
        with reading_buckets(spark):
            write_buckets(spark, name, merged_buckets(spark, name, placed, changed, op), folder, buckets)
        point_partitions(spark, name, folder, changed)


def bucket_count(spark: SparkSession, name: str) -> int:
    value = spark.sql(f"SHOW TBLPROPERTIES {name} ('buckets')").first()
    return int(value["value"])


def new_folder(base: str) -> str:
    """Where the next version of a table, or of some of its buckets, is written."""
    return f"{base}/v={uuid.uuid4().hex}"


def table_folder(spark: SparkSession, name: str) -> str:
    """The folder that holds all versions of a Parquet table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
    return re.sub(r"/v=[0-9a-f]+/?$", "", described.data_type).rstrip("/")


def allow_buckets(spark: SparkSession, buckets: int) -> None:
    """A hundred thousand buckets are Spark's limit unless it is told otherwise; sessions of this library are."""
    if buckets > int(spark.conf.get(MAX_BUCKETS, "100000")):
        spark.conf.set(MAX_BUCKETS, str(buckets))


@contextmanager
def reading_buckets(spark: SparkSession) -> Iterator[None]:
    """A task for each bucket, also where Spark would cut files by size: what stays of a bucket and what is new of it
    then meet in the task that writes it. Should another thread put the option back meanwhile, a bucket gets two files."""
    before = spark.conf.get(AUTO_BUCKETED)
    spark.conf.set(AUTO_BUCKETED, "false")
    try:
        yield
    finally:
        spark.conf.set(AUTO_BUCKETED, before)


def write_buckets(spark: SparkSession, name: str, df: DataFrame, folder: str, buckets: int) -> None:
    """Rows with their buckets as files of a clustered table.

    Spark names a bucket's files only where it writes to a table, so one stands in for the folder as long as that takes.
    """
    stand_in = _beside(name)
    try:
        (
            df.write.format(PARQUET)
            .partitionBy(BUCKET_COLUMN)
            .bucketBy(buckets, KEY_COLUMN)
            .option("path", folder)
            .saveAsTable(stand_in)
        )
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {stand_in}")


def point_partitions(spark: SparkSession, name: str, folder: str, buckets: list[int]) -> None:
    """Make the catalog read these buckets from a new folder."""
    present = {int(row[0].split("=")[1]) for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for bucket in buckets:
        spec = f"PARTITION ({BUCKET_COLUMN} = {bucket})"
        path = f"{folder}/{BUCKET_COLUMN}={bucket}"
        if bucket in present:
            spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{path}'")
        else:
            spark.sql(f"ALTER TABLE {name} ADD {spec} LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def repoint_table(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Replace the rows of an unpartitioned Parquet table: write them elsewhere, then switch over."""
    folder = new_folder(table_folder(spark, name))
    rows.select(*spark.table(name).columns).write.parquet(folder)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)


def append_rows(spark: SparkSession, name: str, rows: DataFrame, provider: str) -> None:
    """Append to a table, matching columns by name."""
    if provider == PARQUET:
        rows.select(*spark.table(name).columns).write.mode("append").insertInto(name)
    else:
        rows.writeTo(name).append()


def set_column_comment(spark: SparkSession, name: str, column: str, comment: str) -> None:
    set_column_comments(spark, name, {column: comment}, at_once=True)


def set_column_comments(spark: SparkSession, name: str, comments: dict[str, str], at_once: bool) -> None:
    """Comments of several columns: in one statement for row-level formats, one by one where the session's own catalog
    keeps the table, which takes no more than a column in a statement."""
    for statement in comment_statements(name, comments, at_once):
        spark.sql(statement)


def comment_statements(name: str, comments: dict[str, str], at_once: bool) -> list[str]:
    changes = []
    for column, comment in comments.items():
        quoted = column.replace("`", "``")
        changes.append(f"`{quoted}` COMMENT '{_escaped(comment)}'")
    if at_once and changes:
        changes = [", ".join(changes)]
    return [f"ALTER TABLE {name} ALTER COLUMN {change}" for change in changes]


def set_table_comment(spark: SparkSession, name: str, comment: str) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('comment' = '{_escaped(comment)}')")


def table_comment(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Comment'").first()
    return (described.data_type or "") if described else ""


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
