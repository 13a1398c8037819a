"""Differences between source tables and the bronze tables they load into.

Both sides are frames of column rows keyed by (bronze_schema, bronze_table), so one plan checks
any number of tables. Names are compared without regard to case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.functions.names import KEY_COLUMN, META_COLUMNS, bronze_schema_of
from tidewell.functions.source_types import expected_type, type_class
from tidewell.session import staged

BRONZE = ("bronze_schema", "bronze_table")

TARGET_COLUMNS_DDL = """
    bronze_schema STRING, bronze_table STRING, position INT, column_name STRING,
    data_type STRING, nullable BOOLEAN, column_comment STRING
"""


def keyed_by_bronze(rows: DataFrame) -> DataFrame:
    """Source metadata rows under the name of the bronze table."""
    return rows.withColumns(
        {"bronze_schema": bronze_schema_of(F.col("table_schema")), "bronze_table": F.lower("table_name")}
    ).drop("table_schema", "table_name")


def catalog_columns(spark: SparkSession, tables: list[str]) -> DataFrame:
    """Column rows of catalog tables; a table that is not there has none."""
    rows = []
    for name in tables:
        if not spark.catalog.tableExists(name):
            continue
        schema, table = name.split(".")[-2:]
        for position, field in enumerate(spark.table(name).schema.fields, start=1):
            rows.append((
                schema, table, position, field.name, field.dataType.simpleString(), field.nullable,
                field.metadata.get("comment", ""),
            ))
    return spark.createDataFrame(rows, TARGET_COLUMNS_DDL)


def matched_columns(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns of both sides side by side, with NULL for a missing one.

    ``s`` is the source column, ``t`` the target column unless loading added it, and ``any_t`` the
    target column in any case.
    """
    left = source.select(*BRONZE, F.lower("column_name").alias("name"), F.struct(*source.columns).alias("s"))
    right = target.select(*BRONZE, F.lower("column_name").alias("name"), F.struct(*target.columns).alias("any_t"))
    added = F.col("any_t.column_name").isin(*META_COLUMNS)
    return left.join(right, [*BRONZE, "name"], "full_outer").withColumn("t", F.when(~added, F.col("any_t")))


def unreflected_columns(matched: DataFrame) -> DataFrame:
    """Source columns that the target lacks."""
    return _column_issues(matched, [_unreflected()])


def type_differences(matched: DataFrame, dialect: str) -> DataFrame:
    """``type_class`` is a different type; ``type_parameters`` the same type with another precision or scale."""
    return _column_issues(matched, _type_issues(dialect))


def nullable_differences(matched: DataFrame) -> DataFrame:
    return _column_issues(matched, [_nullable()])


def column_comment_differences(matched: DataFrame) -> DataFrame:
    """Source comments that the target column does not have; empty source comments are ignored."""
    return _column_issues(matched, [_comment()])


def column_differences(matched: DataFrame, dialect: str) -> DataFrame:
    """All checks of single columns, in one pass."""
    return _column_issues(matched, [_unreflected(), *_type_issues(dialect), _nullable(), _comment()])


def _column_issues(matched: DataFrame, issues: list[Column]) -> DataFrame:
    found = F.explode(F.array_compact(F.array(*issues)))
    return matched.select(*BRONZE, F.col("s.column_name").alias("column_name"), found.alias("issue")).select(
        *BRONZE, F.col("issue.check").alias("check"), "column_name", "issue.source_value", "issue.target_value"
    )


def _issue(condition: Column, check: str, source: Column, target: Column) -> Column:
    return F.when(
        condition,
        F.struct(
            F.lit(check).alias("check"),
            source.cast("string").alias("source_value"),
            target.cast("string").alias("target_value"),
        ),
    )


def _unreflected() -> Column:
    missing = F.col("s").isNotNull() & F.col("t").isNull()
    return _issue(missing, "unreflected", F.col("s.column_type"), F.lit(None))


def _type_issues(dialect: str) -> list[Column]:
    expected, actual = expected_type(F.col("s.column_type"), dialect), F.col("t.data_type")
    same_class = type_class(expected) == type_class(actual)
    return [
        _issue(~same_class, "type_class", expected, actual),
        _issue(same_class & (expected != actual), "type_parameters", expected, actual),
    ]


def _nullable() -> Column:
    source, target = F.col("s.nullable"), F.col("t.nullable")
    return _issue(source != target, "nullable", source, target)


def _comment() -> Column:
    """Columns that loading added count here: a source may have columns of those names."""
    source = F.col("s.column_comment")
    target = F.when(F.col("any_t").isNotNull(), F.coalesce("any_t.column_comment", F.lit("")))
    return _issue((source != "") & (source != target), "column_comment", source, target)


def column_counts(matched: DataFrame) -> DataFrame:
    """Tables whose sides differ in their number of columns; a table without a target is not compared."""
    counts = matched.groupBy(*BRONZE).agg(
        F.count("s").alias("source"), F.count("t").alias("target"), F.count("any_t").alias("any_target")
    )
    return _report(counts.filter("source <> target AND any_target > 0"), "column_count", "source", "target")


def column_order(matched: DataFrame) -> DataFrame:
    """Tables whose common columns come in a different order.

    The window holds the columns of one table, which the databases limit to a few thousand.
    """
    both = matched.filter("s IS NOT NULL AND t IS NOT NULL")
    of_table = Window.partitionBy(*BRONZE)
    ranks = both.select(
        *BRONZE,
        F.row_number().over(of_table.orderBy("s.position")).alias("source_rank"),
        F.row_number().over(of_table.orderBy("t.position")).alias("target_rank"),
    )
    moved = ranks.groupBy(*BRONZE).agg(F.bool_or(F.col("source_rank") != F.col("target_rank")).alias("moved"))
    return _report(moved.filter("moved"), "column_order")


def column_moves(matched: DataFrame) -> DataFrame:
    """The fewest columns to move so that the target has the source's order, with their places among the common columns.

    The others are a longest run of columns that come in the same order on both sides; where several runs are as long,
    its columns are chosen from the last one on, each the latest of the source that fits. A row holds the columns of one
    table, which the databases limit to a few thousand.
    """
    column = F.struct(
        F.col("s.position").alias("position"), F.col("t.position").alias("t"), F.col("s.column_name").alias("name")
    )
    tables = (
        matched.filter("s IS NOT NULL AND t IS NOT NULL")
        .groupBy(*BRONZE)
        .agg(F.array_sort(F.collect_list(column)).alias("columns"))
        .withColumn("lengths", _run_lengths(F.col("columns")))
        .withColumn("kept", _longest_run(F.col("columns"), F.col("lengths")))
    )
    placed = tables.select(*BRONZE, "columns", "kept", F.posexplode("columns").alias("i", "column"))
    moved = placed.filter(~F.array_contains("kept", F.col("column.name")))
    before = F.size(F.filter("columns", lambda c: c["t"] < F.col("column.t")))
    named = moved.select(*BRONZE, F.col("column.name").alias("moved"), (F.col("i") + 1).alias("s"), (before + 1).alias("t"))
    return _report(named, "column_move", "s", "t", "moved")


def _run_lengths(columns: Column) -> Column:
    """For each column the length of the longest run that ends with it."""

    def longer(runs: Column, column: Column) -> Column:
        before = F.filter(runs, lambda r: r["t"] < column["t"])
        length = 1 + F.coalesce(F.array_max(F.transform(before, lambda r: r["length"])), F.lit(0))
        return F.concat(runs, F.array(F.struct(column["t"].alias("t"), length.alias("length"))))

    none = F.array().cast("array<struct<t:int,length:int>>")
    return F.transform(F.aggregate(columns, none, longer), lambda r: r["length"])


def _longest_run(columns: Column, lengths: Column) -> Column:
    """Names of one longest run, from its end."""
    start = F.struct(
        (F.array_max(lengths) + 1).alias("length"), F.lit(2**31 - 1).alias("t"), F.array().cast("array<string>").alias("kept")
    )
    from_end = F.reverse(F.arrays_zip(columns.alias("column"), lengths.alias("length")))

    def step(run: Column, c: Column) -> Column:
        taken = F.struct(
            c["length"].alias("length"),
            c["column"]["t"].alias("t"),
            F.concat(run["kept"], F.array(c["column"]["name"])).alias("kept"),
        )
        return F.when((c["length"] == run["length"] - 1) & (c["column"]["t"] < run["t"]), taken).otherwise(run)

    return F.aggregate(from_end, start, step)["kept"]


def table_comment_differences(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source table comments that the target does not have; empty source comments are ignored."""
    left = source.filter("table_comment <> ''").select(*BRONZE, F.col("table_comment").alias("source_comment"))
    right = target.select(*BRONZE, F.coalesce("table_comment", F.lit("")).alias("target_comment"))
    changed = left.join(right, list(BRONZE)).filter("source_comment <> target_comment")
    return _report(changed, "table_comment", "source_comment", "target_comment")


def primary_key_check(primary_keys: DataFrame, matched: DataFrame) -> DataFrame:
    """Per bronze table: does the source have a primary key, does the target have the key hash, do they agree."""
    hashed = (
        matched.filter("any_t IS NOT NULL")
        .groupBy(*BRONZE)
        .agg(F.bool_or(F.col("any_t.column_name") == KEY_COLUMN).alias("has_key_hash"))
    )
    keyed = primary_keys.select(*BRONZE).distinct().withColumn("keyed", F.lit(True))
    has_source_key = F.coalesce("keyed", F.lit(False))
    return hashed.join(keyed, list(BRONZE), "left").select(
        *BRONZE,
        has_source_key.alias("has_source_key"),
        "has_key_hash",
        (has_source_key == F.col("has_key_hash")).alias("passed"),
    )


def primary_key_differences(primary_keys: DataFrame, matched: DataFrame) -> DataFrame:
    failed = primary_key_check(primary_keys, matched).filter("NOT passed")
    return _report(failed, "primary_key", "has_source_key", "has_key_hash")


def schema_report(
    source: DataFrame,
    target: DataFrame,
    primary_keys: DataFrame,
    source_tables: DataFrame,
    target_tables: DataFrame,
    dialect: str,
) -> DataFrame:
    """All checks of all tables in one report; the matched columns are staged, so both sides are read once."""
    matched = staged(matched_columns(source, target), "matched")
    parts = [
        column_counts(matched),
        column_order(matched),
        column_differences(matched, dialect),
        primary_key_differences(primary_keys, matched),
        table_comment_differences(source_tables, target_tables),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def _report(
    rows: DataFrame, check: str, source: str | None = None, target: str | None = None, column: str | None = None
) -> DataFrame:
    """Report rows about whole tables, or the column of them that is named."""

    def text(name: str | None) -> Column:
        return (F.lit(None) if name is None else F.col(name)).cast("string")

    return rows.select(
        *BRONZE,
        F.lit(check).alias("check"),
        text(column).alias("column_name"),
        text(source).alias("source_value"),
        text(target).alias("target_value"),
    )
