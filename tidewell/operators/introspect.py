"""Answers about source tables from their metadata rows, for all tables at once.

Input frames have the columns of the source's own catalog views (see ``sources.metadata``). Table
names are (table_schema, table_name) pairs throughout, for both dialects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLE = ("table_schema", "table_name")

# Column types that a scan may be split by.
MYSQL_SPLIT_TYPES = ("int", "bigint", "date", "datetime", "timestamp")
SQLSERVER_SPLIT_TYPES = ("date", "datetime", "datetime2")


def primary_keys_mysql(key_usage: DataFrame) -> DataFrame:
    """One row per key column; ``position`` gives the order within the key."""
    return key_usage.filter("constraint_name = 'PRIMARY'").select(
        *TABLE, F.col("ordinal_position").alias("position"), "column_name"
    )


def primary_keys_sqlserver(constraints: DataFrame, key_usage: DataFrame) -> DataFrame:
    """The same, where the kind of a constraint is kept apart from its columns."""
    primary = constraints.filter("constraint_type = 'PRIMARY KEY'").select(*TABLE, "constraint_name")
    return key_usage.join(primary, [*TABLE, "constraint_name"]).select(
        *TABLE, F.col("ordinal_position").alias("position"), "column_name"
    )


def partition_keys_mysql(columns: DataFrame) -> DataFrame:
    """The auto-increment column of each table, or its first column of a type that can be split."""
    auto = F.col("extra") == "auto_increment"
    candidates = columns.filter(F.col("data_type").isin(*MYSQL_SPLIT_TYPES) | F.col("extra").like("auto_increment"))
    return _first_column(candidates, F.when(auto, 0).otherwise(1))


def partition_keys_sqlserver(columns: DataFrame) -> DataFrame:
    """The identity column of each table, or its first date column.

    ``timestamp`` is a row version there, not a time, and is no candidate.
    """
    identity = F.coalesce(F.col("is_identity") == 1, F.lit(False))
    candidates = columns.filter(F.col("data_type").isin(*SQLSERVER_SPLIT_TYPES) | identity)
    return _first_column(candidates, F.when(identity, 0).otherwise(1))


def _first_column(candidates: DataFrame, rank) -> DataFrame:
    first = F.min(F.struct(rank.alias("rank"), "ordinal_position", "column_name"))
    return candidates.groupBy(*TABLE).agg(first.alias("first")).select(*TABLE, "first.column_name")


def column_list(columns: DataFrame) -> DataFrame:
    """Columns and their declared types; ``position`` gives the order."""
    return columns.select(*TABLE, F.col("ordinal_position").alias("position"), "column_name", "column_type")


def sizes_mysql(tables: DataFrame) -> DataFrame:
    size = F.round((F.col("data_length") + F.col("index_length")) / F.lit(1024.0) / F.lit(1024.0), 0)
    return tables.select(*TABLE, "table_rows", size.alias("table_size"))


def sizes_sqlserver(tables: DataFrame, indexes: DataFrame, partitions: DataFrame, units: DataFrame) -> DataFrame:
    """Rows and size in MiB of each table from its pages of 8 KiB.

    Pages are summed per partition, and partitions per index, before they are joined, so neither a
    partition with most of the pages nor a table with most of the partitions is a hot spot. The
    largest row count is taken and the sizes are added up.
    """
    pages = units.groupBy(F.col("container_id").alias("partition_id")).agg(F.sum("total_pages").alias("pages"))
    figures = [F.max("rows").alias("rows"), F.sum("pages").alias("pages")]
    per_object = (
        partitions.join(pages, "partition_id")
        .groupBy("object_id", "index_id")
        .agg(*figures)
        .join(indexes.select("object_id", "index_id"), ["object_id", "index_id"])
        .groupBy("object_id")
        .agg(*figures)
    )
    size = F.col("pages") * F.lit(8.0) / F.lit(1024.0)
    sized = tables.join(per_object, "object_id")
    return sized.select(*TABLE, F.col("rows").alias("table_rows"), size.alias("table_size"))


def column_comments_mysql(columns: DataFrame) -> DataFrame:
    return columns.select(*TABLE, "column_name", F.coalesce("column_comment", F.lit("")).alias("column_comment"))


def column_comments_sqlserver(columns: DataFrame, properties: DataFrame) -> DataFrame:
    """Descriptions of columns; a column without one has an empty comment."""
    return column_comments_mysql(with_descriptions(columns, properties))


def table_comments_mysql(tables: DataFrame) -> DataFrame:
    return tables.select(*TABLE, F.nullif("table_comment", F.lit("")).alias("table_comment"))


def table_comments_sqlserver(tables: DataFrame, properties: DataFrame) -> DataFrame:
    """Descriptions of tables; those without one are left out."""
    described = _descriptions(properties).filter("minor_id = 0")
    return tables.join(described.select(F.col("major_id").alias("object_id"), "value"), "object_id").select(
        *TABLE, F.nullif("value", F.lit("")).alias("table_comment")
    )


def _descriptions(properties: DataFrame) -> DataFrame:
    return properties.filter("name = 'MS_Description'")


def nullability(columns: DataFrame) -> DataFrame:
    return columns.select(*TABLE, "column_name", (F.col("is_nullable") == "YES").alias("nullable"))




def described_columns(columns: DataFrame) -> DataFrame:
    """Position, type, nullability and comment of each column, as the drift checks take them."""
    return columns.select(
        *TABLE,
        F.col("ordinal_position").alias("position"),
        "column_name",
        "column_type",
        (F.col("is_nullable") == "YES").alias("nullable"),
        F.coalesce("column_comment", F.lit("")).alias("column_comment"),
    )


def with_descriptions(columns: DataFrame, properties: DataFrame) -> DataFrame:
    """Columns with their description as ``column_comment``, NULL where they have none."""
    described = _descriptions(properties).filter("minor_id <> 0")
    return columns.drop("column_comment").join(
        described.select(
            F.col("major_id").alias("object_id"),
            F.col("minor_id").alias("column_id"),
            F.col("value").alias("column_comment"),
        ),
        ["object_id", "column_id"],
        "left",
    )
