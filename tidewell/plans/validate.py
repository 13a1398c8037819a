"""Schema checks of loaded tables, and comments carried over from the source."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.names import parse_source_table
from tidewell.operators import drift
from tidewell.session import staged
from tidewell.sinks.tables import BUCKET_COLUMN, BronzeStore, set_column_comments, set_table_comment, table_comment
from tidewell.sources.jdbc import JdbcSource
from tidewell.sources.metadata import SourceMetadata
from tidewell.streaming.runner import DONE, raise_failures, run_side_by_side

TABLES_AT_ONCE = 100


def validate_tables(
    spark: SparkSession, source: JdbcSource, store: BronzeStore, tables: Sequence[str], sync: bool = True
) -> DataFrame:
    """Report of all differences of the given tables; with ``sync`` comments are carried over."""
    names = [parse_source_table(table, source.dialect) for table in tables]
    bronze = [store.name(name.bronze_schema, name.bronze_table) for name in names]
    metadata = SourceMetadata(spark, source, tables)
    target = drift.catalog_columns(spark, bronze).filter(f"column_name <> '{BUCKET_COLUMN}'")
    target_tables = spark.createDataFrame(
        [
            (name.bronze_schema, name.bronze_table, table_comment(spark, full))
            for name, full in zip(names, bronze, strict=True)
            if spark.catalog.tableExists(full)
        ],
        "bronze_schema STRING, bronze_table STRING, table_comment STRING",
    )
    report = drift.schema_report(
        drift.keyed_by_bronze(metadata.columns()),
        target,
        drift.keyed_by_bronze(metadata.primary_keys()),
        drift.keyed_by_bronze(metadata.table_comments()),
        target_tables,
        source.dialect,
    )
    if sync:
        # The report is written down first: comments change what it would find.
        report = staged(report, "report")
        sync_comments(spark, store, report)
    return report


def sync_comments(spark: SparkSession, store: BronzeStore, report: DataFrame, concurrency: int = 4) -> int:
    """Carry differing comments over to the bronze tables, some tables side by side; returns how many comments.

    A table's comments are gathered before they leave Spark, and the driver holds ``TABLES_AT_ONCE`` tables at a time. A
    table that fails does not hold up the others; the failures are raised at the end.
    """
    columns = F.col("check") == "column_comment"
    pair = F.struct("column_name", "source_value")
    per_table = (
        report.filter("check IN ('column_comment', 'table_comment')")
        .groupBy(*drift.BRONZE)
        .agg(
            F.sort_array(F.collect_list(F.when(columns, pair))).alias("columns"),
            F.max(F.when(~columns, F.col("source_value"))).alias("comment"),
        )
    )
    rows, outcomes, synced = per_table.toLocalIterator(), [], 0
    while some := {store.name(r.bronze_schema, r.bronze_table): r for r in islice(rows, TABLES_AT_ONCE)}:

        def carry_over(name: str, some: dict[str, Row] = some) -> None:
            row = some[name]
            set_column_comments(spark, name, dict(map(tuple, row.columns)), at_once=store.row_level)
            if row.comment is not None:
                set_table_comment(spark, name, row.comment)

        done = run_side_by_side(spark, some, carry_over, concurrency)
        carried = [some[o.name] for o in done if o.status == DONE]
        synced += sum(len(r.columns) + (r.comment is not None) for r in carried)
        outcomes += [o for o in done if o.status != DONE]
    raise_failures(outcomes)
    return synced
