"""Comparison of a registered query with its SQL in DuckDB."""

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_rows(sql, sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return names, result.fetchall()


def normalised(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, (int, decimal.Decimal)):
        return f"{float(value):.9g}" if isinstance(value, decimal.Decimal) else str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def as_sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(normalised(r[i]) for i in order) for r in rows)


def assert_same(df, sql, sf_dir):
    got_names, got = as_sorted(df.columns, [tuple(r) for r in df.collect()])
    want_names, want = as_sorted(*oracle_rows(sql, sf_dir))
    assert got_names == want_names
    assert len(got) == len(want), (len(got), len(want))
    different = [(g, w) for g, w in zip(got, want) if g != w]
    assert not different, different[:3]
