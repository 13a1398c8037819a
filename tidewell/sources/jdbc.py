"""Tables and queries of a source database."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidewell.functions.names import MYSQL, SQLSERVER
from tidewell.operators.ranges import literal, range_predicates, ranges_sql


# Driver classes, and the connection settings of each database.
DRIVERS = {MYSQL: "com.mysql.cj.jdbc.Driver", SQLSERVER: "com.microsoft.sqlserver.jdbc.SQLServerDriver"}
MYSQL_SETTINGS = "zeroDateTimeBehavior=convertToNull&useUnicode=true&characterEncoding=UTF-8"
SQLSERVER_SETTINGS = "encrypt=false;"


def bounds_of(column: str, suffix: str = "bound") -> str:
    """Smallest and largest value of a column, whose name is quoted already, for a SELECT list."""
    return f"min({column}) AS lower_{suffix}, max({column}) AS upper_{suffix}"


def bounds_sql(table: str, column: str) -> str:
    """The query for the smallest and largest value of a column."""
    return f"SELECT {bounds_of(column)} FROM {table}"


@dataclass(frozen=True)
class JdbcSource:
    """Connection to one MySQL or SQL Server instance.

    ``reader`` is the name of the Spark data source; anything that takes the options of ``jdbc``
    can stand in for it.
    """

    dialect: str
    host: str
    port: int
    user: str
    password: str = field(repr=False)
    reader: str = "jdbc"
    extra: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.dialect not in (MYSQL, SQLSERVER):
            raise ValueError(f"unknown dialect '{self.dialect}'")

    def options(self, database: str = "") -> dict[str, str]:
        """Options of the reader: zero dates of MySQL are NULL, SQL Server is not encrypted."""
        url = f"jdbc:{self.dialect}://{self.host}:{self.port}"
        if self.dialect == MYSQL:
            url += f"/{database}?{MYSQL_SETTINGS}"
        else:
            url += (f";databaseName={database}" if database else "") + f";{SQLSERVER_SETTINGS}"
        login = {"user": self.user, "password": self.password}
        return {"url": url, "driver": DRIVERS[self.dialect], **login, **self.extra}

    def quoted(self, name: str) -> str:
        if self.dialect == MYSQL:
            return "`" + name.replace("`", "``") + "`"
        return "[" + name.replace("]", "]]") + "]"

    def query(self, spark: SparkSession, sql: str, database: str = "") -> DataFrame:
        """Rows of a query that the database runs."""
        return spark.read.format(self.reader).options(**self.options(database)).option("query", sql).load()

    def table(self, spark: SparkSession, table: str, database: str = "") -> DataFrame:
        """A whole table over one connection."""
        return spark.read.format(self.reader).options(**self.options(database)).option("dbtable", table).load()

    def table_by_ranges(
        self, spark: SparkSession, table: str, column: str, lower: Any, upper: Any, partitions: int, database: str = ""
    ) -> DataFrame:
        """A whole table over several connections, each reading one range of a column."""
        return (
            spark.read.format(self.reader)
            .options(**self.options(database))
            .option("dbtable", table)
            .option("partitionColumn", column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(partitions))
            .load()
        )

    def bounds(self, spark: SparkSession, table: str, column: str, database: str = "") -> tuple[Any, Any]:
        """Smallest and largest value of a column, found by the database."""
        row = self.query(spark, bounds_sql(table, self.quoted(column)), database).first()
        return (None, None) if row is None else (row[0], row[1])

    def borders(self, spark: SparkSession, table: str, column: str, ranges: int, database: str = "") -> list[Any]:
        """Lower bounds of ranges with about as many rows each, but the first's; found by the database, for keys of any
        type it can order. As many rows as there are ranges come back."""
        rows = self.query(spark, ranges_sql(table, self.quoted(column), ranges), database).collect()
        return [row["lower_bound"] for row in sorted(rows, key=lambda row: row["range_no"])[1:]]

    def literal(self, value: Any) -> str:
        text = literal(value)
        return text.replace("\\", "\\\\") if self.dialect == MYSQL and isinstance(value, str) else text

    def table_by_predicates(
        self, spark: SparkSession, table: str, predicates: Sequence[str], database: str = ""
    ) -> DataFrame:
        """A whole table over several connections, each reading the rows that meet one condition."""
        if self.reader == "jdbc":
            options = self.options(database)
            return spark.read.jdbc(options.pop("url"), table, predicates=list(predicates), properties=options)
        parts = [self.query(spark, f"SELECT * FROM {table} WHERE {condition}", database) for condition in predicates]
        return reduce(DataFrame.unionByName, parts)

    def table_by_even_ranges(
        self, spark: SparkSession, table: str, column: str, partitions: int, database: str = ""
    ) -> DataFrame:
        """A whole table in ranges of a key that hold about as many rows each."""
        borders = [self.literal(value) for value in self.borders(spark, table, column, partitions, database)]
        return self.table_by_predicates(spark, table, range_predicates(self.quoted(column), borders), database)

    def scan(
        self, spark: SparkSession, table: str, partition_column: str | None, partitions: int, database: str = ""
    ) -> DataFrame:
        """By ranges where the table has a column for it and any rows, over one connection otherwise."""
        if partition_column:
            lower, upper = self.bounds(spark, table, partition_column, database)
            if lower is not None:
                return self.table_by_ranges(spark, table, partition_column, lower, upper, partitions, database)
        return self.table(spark, table, database)
