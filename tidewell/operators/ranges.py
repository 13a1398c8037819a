"""Ranges of a key that hold about as many rows each, whatever the key's type and however its values are spread."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.ordered import with_total_before


def equi_depth_ranges(df: DataFrame, column: str, ranges: int) -> DataFrame:
    """``range_no`` (from 0), ``lower_bound``, ``upper_bound`` and ``rows`` of at most ``ranges`` ranges of a column.

    A key is in the range that the number of rows with a smaller key says, so rows of one key stay together: a range
    exceeds the mean by less than its last key's rows. NULL keys are in none. Keys are counted before they are ordered, and
    the running total is passed on between chunks of them.
    """
    keys = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count("*").alias("rows"))
    placed = with_total_before(keys, ["key"], "rows", "before")
    total = placed.agg(F.sum("rows")).first()[0] or 1
    return (
        placed.groupBy(F.floor(F.expr(f"(before * {ranges}) div {total}")).alias("range_no"))
        .agg(F.min("key").alias("lower_bound"), F.max("key").alias("upper_bound"), F.sum("rows").alias("rows"))
    )


def ranges_sql(table: str, column: str, ranges: int) -> str:
    """The same as a query that a database runs, which gives back one row for each range; names are quoted already."""
    return (
        "SELECT range_no, MIN(k) AS lower_bound, MAX(k) AS upper_bound, SUM(n) AS row_count FROM ("
        f"SELECT k, n, FLOOR((SUM(n) OVER (ORDER BY k) - n) * {ranges} / SUM(n) OVER ()) AS range_no FROM ("
        f"SELECT {column} AS k, CAST(COUNT(*) AS DECIMAL(19,0)) AS n FROM {table} WHERE {column} IS NOT NULL "
        f"GROUP BY {column}) counted) placed GROUP BY range_no"
    )


def literal(value: Any) -> str:
    """A value as SQL text; a text has no backslashes doubled, which MySQL needs unless told otherwise."""
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, (bytes, bytearray)):
        return f"0x{bytes(value).hex()}"
    if isinstance(value, (str, dt.date)):
        text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)
        return "'" + text.replace("'", "''") + "'"
    return str(value)


def range_predicates(column: str, borders: Sequence[str]) -> list[str]:
    """Conditions of which every row meets exactly one, from the lower bounds of all ranges but the first, as SQL text.

    Rows with a NULL key go with the first range.
    """
    if not borders:
        return ["1 = 1"]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(borders, borders[1:])]
    return [f"{column} < {borders[0]} OR {column} IS NULL", *inner, f"{column} >= {borders[-1]}"]
