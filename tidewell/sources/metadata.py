"""Metadata rows of a source database.

The database filters and projects its catalog views for all wanted tables in one query per view;
``operators.introspect`` answers the questions. Column names are given in lower case, since the
case that drivers report differs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.names import MYSQL, parse_source_table
from tidewell.operators import introspect
from tidewell.sources.jdbc import JdbcSource

# Views and columns of the two catalogs.
MYSQL_VIEWS = {
    "columns": (
        "information_schema.COLUMNS",
        "TABLE_SCHEMA, TABLE_NAME, COLUMN_NAME, ORDINAL_POSITION, DATA_TYPE, COLUMN_TYPE, EXTRA, IS_NULLABLE, "
        "COLUMN_COMMENT",
    ),
    "key_usage": (
        "information_schema.KEY_COLUMN_USAGE",
        "TABLE_SCHEMA, TABLE_NAME, CONSTRAINT_NAME, COLUMN_NAME, ORDINAL_POSITION",
    ),
    "tables": (
        "information_schema.TABLES",
        "TABLE_SCHEMA, TABLE_NAME, TABLE_COMMENT, TABLE_ROWS, DATA_LENGTH, INDEX_LENGTH",
    ),
}

# Fixed values. SQL Server names the database of a table its catalog.
SQLSERVER_QUERIES = {
    "columns": """
        SELECT TABLE_CATALOG AS TABLE_SCHEMA, TABLE_NAME, COLUMN_NAME, ORDINAL_POSITION, DATA_TYPE,
               DATA_TYPE AS COLUMN_TYPE, IS_NULLABLE,
               OBJECT_ID(CONCAT(TABLE_SCHEMA, '.', TABLE_NAME)) AS OBJECT_ID,
               COLUMNPROPERTY(OBJECT_ID(CONCAT(TABLE_SCHEMA, '.', TABLE_NAME)), COLUMN_NAME, 'ColumnId') AS COLUMN_ID,
               COLUMNPROPERTY(OBJECT_ID(CONCAT(TABLE_SCHEMA, '.', TABLE_NAME)), COLUMN_NAME, 'IsIdentity') AS IS_IDENTITY
        FROM INFORMATION_SCHEMA.COLUMNS WHERE {tables}""",
    "key_usage": """
        SELECT TABLE_CATALOG AS TABLE_SCHEMA, TABLE_NAME, CONSTRAINT_NAME, COLUMN_NAME, ORDINAL_POSITION
        FROM INFORMATION_SCHEMA.KEY_COLUMN_USAGE WHERE {tables}""",
    "constraints": """
        SELECT TABLE_CATALOG AS TABLE_SCHEMA, TABLE_NAME, CONSTRAINT_NAME, CONSTRAINT_TYPE
        FROM INFORMATION_SCHEMA.TABLE_CONSTRAINTS WHERE {tables}""",
    "tables": """
        SELECT TABLE_CATALOG AS TABLE_SCHEMA, TABLE_NAME, OBJECT_ID(CONCAT(TABLE_SCHEMA, '.', TABLE_NAME)) AS OBJECT_ID
        FROM INFORMATION_SCHEMA.TABLES WHERE {tables}""",
    "indexes": "SELECT object_id, index_id FROM sys.indexes",
    "partitions": "SELECT partition_id, object_id, index_id, rows FROM sys.partitions",
    "units": "SELECT container_id, total_pages FROM sys.allocation_units",
    "properties": """
        SELECT major_id, minor_id, name, CAST(value AS NVARCHAR(MAX)) AS value
        FROM sys.extended_properties WHERE name = 'MS_Description'""",
}


class SourceMetadata:
    """Metadata of some tables of one database, by their full names."""

    def __init__(self, spark: SparkSession, source: JdbcSource, tables: Sequence[str]):
        self.spark = spark
        self.source = source
        self.names = [parse_source_table(name, source.dialect) for name in tables]
        # Bronze has no place for a schema within a database, so two such tables would share all their rows.
        if len({(name.bronze_schema, name.bronze_table) for name in self.names}) < len(self.names):
            raise ValueError(f"several of {', '.join(tables)} would have the same bronze table")
        self.full_names = list(tables)

    def view(self, name: str) -> DataFrame:
        if self.source.dialect == MYSQL:
            view, columns = MYSQL_VIEWS[name]
            return self._read(f"SELECT {columns} FROM {view} WHERE {self._mysql_filter()}", "")
        parts = [
            self._read(SQLSERVER_QUERIES[name].format(tables=self._sqlserver_filter(db)), db)
            for db in dict.fromkeys(table.schema for table in self.names)
        ]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows

    def primary_keys(self) -> DataFrame:
        if self.source.dialect == MYSQL:
            return introspect.primary_keys_mysql(self.view("key_usage"))
        return introspect.primary_keys_sqlserver(self.view("constraints"), self.view("key_usage"))

    def partition_keys(self) -> DataFrame:
        columns = self.view("columns")
        if self.source.dialect == MYSQL:
            return introspect.partition_keys_mysql(columns)
        return introspect.partition_keys_sqlserver(columns)

    def columns(self) -> DataFrame:
        """Column rows with type, nullability and comment."""
        columns = self.view("columns")
        if self.source.dialect != MYSQL:
            columns = introspect.with_descriptions(columns, self.view("properties"))
        return introspect.described_columns(columns)

    def column_comments(self) -> DataFrame:
        if self.source.dialect == MYSQL:
            return introspect.column_comments_mysql(self.view("columns"))
        return introspect.column_comments_sqlserver(self.view("columns"), self.view("properties"))

    def nullability(self) -> DataFrame:
        return introspect.nullability(self.view("columns"))

    def table_comments(self) -> DataFrame:
        if self.source.dialect == MYSQL:
            return introspect.table_comments_mysql(self.view("tables"))
        return introspect.table_comments_sqlserver(self.view("tables"), self.view("properties"))

    def sizes(self) -> DataFrame:
        if self.source.dialect == MYSQL:
            return introspect.sizes_mysql(self.view("tables"))
        return introspect.sizes_sqlserver(
            self.view("tables"), self.view("indexes"), self.view("partitions"), self.view("units")
        )

    def primary_key_of(self, table: str) -> list[str]:
        """Key columns of one table, in key order."""
        rows = self._of(self.primary_keys(), table).orderBy("position").collect()
        return [row.column_name for row in rows]

    def partition_key_of(self, table: str) -> str | None:
        row = self._of(self.partition_keys(), table).first()
        return row.column_name if row else None

    def schema_of(self, table: str) -> dict[str, str]:
        """Declared column types of one table, in column order."""
        rows = self._of(introspect.column_list(self.view("columns")), table).orderBy("position").collect()
        return {row.column_name: row.column_type for row in rows}

    def size_of(self, table: str) -> int | None:
        """Bytes of one table as far as the source knows them."""
        row = self._of(self.sizes(), table).first()
        return None if row is None or row.table_size is None else int(row.table_size * 1024 * 1024)

    def _of(self, rows: DataFrame, table: str) -> DataFrame:
        name = parse_source_table(table, self.source.dialect)
        return rows.filter((F.col("table_schema") == name.schema) & (F.col("table_name") == name.table))

    def _read(self, sql: str, database: str) -> DataFrame:
        rows = self.source.query(self.spark, " ".join(sql.split()), database)
        return rows.toDF(*[name.lower() for name in rows.columns])

    def _mysql_filter(self) -> str:
        pairs = ", ".join(f"({_text(t.schema)}, {_text(t.table)})" for t in self.names)
        return f"(TABLE_SCHEMA, TABLE_NAME) IN ({pairs})"

    def _sqlserver_filter(self, database: str) -> str:
        """Tables of one database, in the schema their full name gives (``dbo`` if it gives none)."""
        wanted = []
        for full_name, table in zip(self.full_names, self.names, strict=True):
            if table.schema == database:
                parts = full_name.split(".")
                schema = parts[1] if len(parts) == 3 else "dbo"
                wanted.append(f"(TABLE_SCHEMA = {_text(schema)} AND TABLE_NAME = {_text(table.table)})")
        return "(" + " OR ".join(wanted) + ")"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"
