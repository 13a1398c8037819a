"""Names of source tables, topics and the bronze tables they load into."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

MYSQL = "mysql"
SQLSERVER = "sqlserver"

# The columns that loading adds to a bronze table, and the suffix of its schema.
LOAD_TIME_COLUMN = "last_applied_date"
KEY_COLUMN = "id_iceberg"
STAGED_TIME_COLUMN = "update_ts_dms"
META_COLUMNS = (LOAD_TIME_COLUMN, KEY_COLUMN)
BRONZE_SUFFIX = "_bronze"


class SourceTable(NamedTuple):
    schema: str
    table: str

    @property
    def bronze_schema(self) -> str:
        return self.schema.lower() + BRONZE_SUFFIX

    @property
    def bronze_table(self) -> str:
        return self.table.lower()

    def bronze_name(self, catalog: str | None = None) -> str:
        name = f"{self.bronze_schema}.{self.bronze_table}"
        return f"{catalog}.{name}" if catalog else name

    def parquet_path(self, base: str) -> str:
        """Raw Parquet keeps the case of the source name."""
        return f"{base.rstrip('/')}/{self.schema}/{self.table}"


def parse_source_table(name: str, dialect: str | None = None) -> SourceTable:
    """``db.table`` or, for SQL Server, ``db.schema.table``; without a dialect both are taken."""
    parts = name.split(".")
    allowed = {MYSQL: (2,), SQLSERVER: (2, 3), None: (2, 3)}[dialect]
    if len(parts) not in allowed or not all(parts):
        raise ValueError(f"'{name}' does not name a source table")
    return SourceTable(parts[0], parts[-1])


def parse_topic(topic: str) -> SourceTable:
    """``prefix.schema.table``."""
    parts = topic.split(".")
    if len(parts) != 3 or not all(parts):
        raise ValueError(f"'{topic}' is not prefix.schema.table")
    return SourceTable(parts[1], parts[2])


def bronze_schema_of(schema: Column) -> Column:
    return F.concat(F.lower(schema), F.lit(BRONZE_SUFFIX))


def bronze_parts_of_topic(topic: Column) -> tuple[Column, Column]:
    """Column form of :func:`parse_topic`; a topic that is not made of three parts gives NULLs."""
    parts = F.split(topic, r"\.")
    whole = F.size(parts) == 3
    return (
        F.when(whole, bronze_schema_of(F.get(parts, F.lit(1)))),
        F.when(whole, F.lower(F.get(parts, F.lit(2)))),
    )
