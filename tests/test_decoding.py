"""Schema versions decoded in one pass."""

import datetime as dt
import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F

from tidewell.functions.frames import build_frame, split_frames
from tidewell.functions.logical_types import DATE, MICRO_TIMESTAMP, TIMESTAMP
from tidewell.operators.changes import OP
from tidewell.operators.decoding import JSON, decode_all_changes, resolve_pairs, schema_pairs


def value_schema(**types):
    fields = [{"name": name, "type": ["null", kind]} for name, kind in types.items()]
    row = {"type": "record", "name": "Value", "fields": fields}
    envelope = [
        {"name": "after", "type": ["null", row]},
        {"name": "op", "type": "string"},
        {"name": "ts_ms", "type": ["null", "long"]},
    ]
    return json.dumps({"type": "record", "name": "Envelope", "fields": envelope})


def key_schema(**types):
    fields = [{"name": name, "type": kind} for name, kind in types.items()]
    return json.dumps({"type": "record", "name": "Key", "fields": fields})


def logical(name):
    return {"type": "int" if name == DATE else "long", "connect.name": name}


SCHEMAS = {
    1: key_schema(id="long"),
    2: key_schema(id="long", code="string"),
    10: value_schema(id="long", code="string", at=logical(TIMESTAMP), amount="double"),
    11: value_schema(id="long", code="string", at=logical(MICRO_TIMESTAMP), amount="string", day=logical(DATE)),
    12: value_schema(id="int", code="string", flag="boolean"),
}


def registry(spark):
    return spark.createDataFrame(list(SCHEMAS.items()), "schema_id INT, schema_str STRING")


def records(spark, rows):
    """(value id, key id, key, envelope or None) as framed records."""
    texts = [(v, k, json.dumps(key), None if e is None else json.dumps(e), i) for i, (v, k, key, e) in enumerate(rows)]
    df = spark.createDataFrame(texts, "v INT, k INT, key STRING, value STRING, offset LONG")
    framed = df.select(
        build_frame(F.col("k"), F.col("key")).alias("key"),
        F.when(F.col("value").isNotNull(), build_frame(F.col("v"), F.col("value"))).alias("value"),
        F.lit("srv.a.b").alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.lit(None).cast("timestamp").alias("timestamp"),
    )
    return split_frames(framed)


TARGET = "id BIGINT, code STRING, at TIMESTAMP, amount DECIMAL(10,2), day DATE, flag BOOLEAN, last_applied_date TIMESTAMP, id_iceberg STRING"


def decoded(spark, rows):
    given = records(spark, rows)
    target = spark.createDataFrame([], TARGET).schema
    return decode_all_changes(given, schema_pairs(given, registry), target, JSON)


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_each_version_is_read_with_its_own_types(spark):
    noon = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)
    seconds = int(noon.timestamp())
    rows = decoded(
        spark,
        [
            (10, 1, {"id": 1}, {"after": {"id": 1, "code": "x", "at": seconds * 1000, "amount": 1.5}, "op": "c", "ts_ms": 5}),
            (11, 2, {"id": 2, "code": " y "}, {"after": {"id": 2, "code": " y ", "at": seconds * 10**6, "amount": "2.25", "day": 3}, "op": "u", "ts_ms": None}),
            (12, 1, {"id": 3}, {"after": {"id": 3, "code": None, "flag": True, "amount": 9}, "op": "u", "ts_ms": 7}),
            (12, 1, {"id": 4}, {"after": None, "op": "d", "ts_ms": 7}),
            (10, 1, {"id": 5}, None),
        ],
    ).orderBy("__offset").selectExpr("*", "CAST(at AS STRING) AS at_text").collect()
    assert [(r["id"], r["code"], r["at_text"], r["amount"] and float(r["amount"]), r["day"], r["flag"], r[OP]) for r in rows] == [
        (1, "x", "2024-01-01 03:00:00", 1.5, None, None, "c"),
        (2, " y ", "2024-01-01 03:00:00", 2.25, dt.date(1970, 1, 4), None, "u"),
        (3, None, None, None, None, True, "u"),  # the version knows no amount
        (None, None, None, None, None, None, "d"),
    ]
    assert [r["id_iceberg"] for r in rows] == [md5("1"), md5("2|y"), md5("3"), md5("4")]


def test_payloads_that_do_not_fit_fail_the_job(spark):
    bad = [(10, 1, {"id": 1}, {"after": {"id": "no number"}, "op": "c", "ts_ms": 5})]
    with pytest.raises(Exception, match="VARIANT"):
        decoded(spark, bad).collect()


def test_a_version_without_key_is_refused(spark):
    given = records(spark, [(10, 3, {}, {"after": {"id": 1}, "op": "c", "ts_ms": 5})])
    pairs = resolve_pairs([(10, 3)], lambda s: s.createDataFrame([(10, SCHEMAS[10]), (3, key_schema())], "schema_id INT, schema_str STRING"), spark, {})
    with pytest.raises(ValueError, match="no key"):
        decode_all_changes(given, pairs, spark.createDataFrame([], TARGET).schema, JSON)


def test_eight_versions_are_one_scan(spark, folder):
    """The plan does not grow with the number of versions."""
    records(spark, [(10, 1, {"id": 1}, {"after": {"id": 1}, "op": "c", "ts_ms": 5})]).write.parquet(f"{folder}/records")
    given = spark.read.parquet(f"{folder}/records")
    target = spark.createDataFrame([], TARGET).schema
    texts = [{**SCHEMAS, **{i: SCHEMAS[10 + i % 3] for i in range(20, 28)}}]
    known = lambda s: s.createDataFrame(list(texts[0].items()), "schema_id INT, schema_str STRING")

    def plan(ids):
        pairs = resolve_pairs([(i, 1) for i in ids], known, spark, {})
        return decode_all_changes(given, pairs, target, JSON)._jdf.queryExecution().executedPlan().toString()

    three, eight = plan(range(20, 23)), plan(range(20, 28))
    assert len(re.findall("FileScan parquet", eight)) == 1 and "Union" not in eight
    assert len(eight.splitlines()) == len(three.splitlines())
