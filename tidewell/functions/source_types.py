"""Spark types expected for the column types of the source databases."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.names import MYSQL

# Source type name -> Spark type name.
MYSQL_TYPES = {
    "char": "string",
    "varchar": "string",
    "text": "string",
    "tinytext": "string",
    "mediumtext": "string",
    "longtext": "string",
    "tinyint": "int",
    "smallint": "int",
    "mediumint": "int",
    "int": "int",
    "int unsigned": "bigint",
    "bigint": "bigint",
    "float": "float",
    "double": "double",
    "decimal": "decimal(10,0)",
    "boolean": "boolean",
    "blob": "binary",
    "tinyblob": "binary",
    "mediumblob": "binary",
    "longblob": "binary",
    "time": "timestamp",
    "date": "date",
    "datetime": "timestamp",
    "timestamp": "timestamp",
    "enum": "string",
    "set": "string",
    "json": "string",
}

# Fixed values. SQL Server's tinyint runs from 0 to 255, which a signed byte cannot hold.
SQLSERVER_TYPES = {
    "bigint": "bigint",
    "int": "int",
    "smallint": "smallint",
    "tinyint": "smallint",
    "bit": "boolean",
    "decimal": "decimal(38,10)",
    "numeric": "decimal(38,10)",
    "money": "decimal(19,4)",
    "smallmoney": "decimal(10,4)",
    "float": "double",
    "real": "float",
    "date": "date",
    "datetime": "timestamp",
    "datetime2": "timestamp",
    "smalldatetime": "timestamp",
    "time": "string",
    "char": "string",
    "varchar": "string",
    "text": "string",
    "nchar": "string",
    "nvarchar": "string",
    "ntext": "string",
    "binary": "binary",
    "varbinary": "binary",
    "image": "binary",
    "uniqueidentifier": "string",
    "xml": "string",
    "sql_variant": "string",
}

_PARAMETERS = r"\s*\([^)]*\)?"
_TYPE_WORDS = r"^(\w+(?:\s+\w+)?)"
_FIRST_PARAMETER = r"\(\s*(\d+)"
_SECOND_PARAMETER = r"\(\s*\d+\s*,\s*(\d+)"


def expected_type(column_type: Column, dialect: str) -> Column:
    """Name of the Spark type expected for a source column type.

    ``int(10) unsigned`` and ``int unsigned`` are one type, so the parameters are taken
    out before the name is looked up; unknown names are strings.
    """
    names = MYSQL_TYPES if dialect == MYSQL else SQLSERVER_TYPES
    lookup = F.create_map(*[F.lit(text) for pair in names.items() for text in pair])
    cleaned = F.trim(F.lower(column_type))
    words = F.regexp_replace(
        F.regexp_extract(F.regexp_replace(cleaned, _PARAMETERS, " "), _TYPE_WORDS, 1), r"\s+", " "
    )
    first = F.substring_index(words, " ", 1)
    found = F.coalesce(F.try_element_at(lookup, words), F.try_element_at(lookup, first), F.lit("string"))
    if dialect != MYSQL:
        return found
    precision = F.regexp_extract(cleaned, _FIRST_PARAMETER, 1)
    scale = F.regexp_extract(cleaned, _SECOND_PARAMETER, 1)
    return (
        F.when((first == "tinyint") & (precision == "1"), F.lit("boolean"))
        .when(
            (first == "decimal") & (precision != ""),
            F.concat(F.lit("decimal("), precision, F.lit(","), F.when(scale == "", "0").otherwise(scale), F.lit(")")),
        )
        .otherwise(found)
    )


def type_class(type_name: Column) -> Column:
    """Type name without its parameters: ``decimal(10,2)`` -> ``decimal``."""
    return F.substring_index(type_name, "(", 1)


def resolve_type(column_type: str, dialect: str) -> T.DataType:
    """The same rule for a single name, on the driver."""
    names = MYSQL_TYPES if dialect == MYSQL else SQLSERVER_TYPES
    cleaned = column_type.strip().lower()
    match = re.match(_TYPE_WORDS, re.sub(_PARAMETERS, " ", cleaned))
    if match is None:
        return T.StringType()
    words = " ".join(match.group(1).split())
    first = words.split()[0]
    precision = re.search(_FIRST_PARAMETER, cleaned)
    if dialect == MYSQL and precision:
        if first == "tinyint" and precision.group(1) == "1":
            return T.BooleanType()
        if first == "decimal":
            scale = re.search(_SECOND_PARAMETER, cleaned)
            return T.DecimalType(int(precision.group(1)), int(scale.group(1)) if scale else 0)
    return spark_type(names.get(words) or names.get(first) or "string")


_SPARK_TYPES = {
    t.simpleString(): t
    for t in (
        T.StringType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(),
        T.BooleanType(), T.BinaryType(), T.DateType(), T.TimestampType(),
    )
}


def spark_type(name: str) -> T.DataType:
    decimal = re.fullmatch(r"decimal\((\d+),(\d+)\)", name)
    return T.DecimalType(int(decimal[1]), int(decimal[2])) if decimal else _SPARK_TYPES[name]
