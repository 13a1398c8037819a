"""Frames, schema texts and logical types."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.frames import build_frame, split_frames
from tidewell.functions.logical_types import (
    DATE,
    MICRO_TIME,
    MICRO_TIMESTAMP,
    TIMESTAMP,
    ZONED_TIMESTAMP,
    cast_logical,
)
from tidewell.functions.names import MYSQL, SQLSERVER
from tidewell.functions.source_types import expected_type
from tidewell.operators.changes import OFFSET, OP
from tidewell.operators.decoding import JSON, column_types, decode_all_changes, key_columns, schema_pairs
from tidewell.operators.ledger import batch_stats, schema_ids
from tidewell.queries.registry import derive, query, table
from tidewell.session import staged

KEY_ID = 11
VALUE_IDS = (21, 22)
TOPIC = "srv.Shop.Orders"


def _value_schema(date_type: str, extra: list[dict]) -> str:
    row = {
        "type": "record",
        "name": "Value",
        "fields": [
            {"name": "o_orderkey", "type": "long"},
            {"name": "o_custkey", "type": ["null", "long"]},
            {"name": "o_orderstatus", "type": ["null", "string"]},
            {"name": "o_totalprice", "type": ["null", "double"]},
            {"name": "o_orderdate", "type": ["null", {"type": "long", "connect.name": date_type}]},
            {"name": "o_orderpriority", "type": ["null", "string"]},
            *extra,
        ],
    }
    return json.dumps(
        {
            "type": "record",
            "name": "Envelope",
            "fields": [
                {"name": "before", "type": ["null", row], "default": None},
                {"name": "after", "type": ["null", "Value"], "default": None},
                {"name": "op", "type": "string"},
                {"name": "ts_ms", "type": ["null", "long"]},
            ],
        }
    )


# The older version has times in milliseconds; the newer in microseconds, and one column more.
SCHEMA_TEXTS = {
    KEY_ID: json.dumps({"type": "record", "name": "Key", "fields": [{"name": "o_orderkey", "type": "long"}]}),
    VALUE_IDS[0]: _value_schema(TIMESTAMP, []),
    VALUE_IDS[1]: _value_schema(MICRO_TIMESTAMP, [{"name": "note", "type": ["null", "string"]}]),
}

TARGET_DDL = """
    o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP,
    o_orderpriority STRING, last_applied_date TIMESTAMP, id_iceberg STRING
"""


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SCHEMA_TEXTS.items()), "schema_id INT, schema_str STRING")


def framed_events(spark: SparkSession, sf_dir: str, topic: Column | None = None) -> DataFrame:
    """Every event as the broker record of an order change; deletes are followed by no tombstone here."""
    events = table(spark, sf_dir, "events").withColumn("instant", F.col("ts").cast("timestamp"))
    order_key = F.when(F.col("event_id") % 5 == 0, -1 - F.col("user_id") * 100 - F.col("event_id") % 20).otherwise(
        F.col("user_id") * 100 + F.col("event_id") % 20
    )
    newer = F.col("event_id") % 2 == 0
    micros = F.unix_micros("instant")
    op = (
        F.when(F.col("event_id") % 97 == 0, F.lit(None))
        .when(F.col("event_type") == "error", "d")
        .when(F.col("event_type") == "signup", "c")
        .otherwise("u")
    )
    image = F.struct(
        order_key.alias("o_orderkey"),
        F.col("user_id").alias("o_custkey"),
        F.upper(F.substring("event_type", 1, 1)).alias("o_orderstatus"),
        F.col("value").alias("o_totalprice"),
        F.when(newer, micros).otherwise(F.unix_millis("instant")).alias("o_orderdate"),
        F.col("event_type").alias("o_orderpriority"),
        F.when(newer, F.col("props")).alias("note"),
    )
    envelope = F.struct(image.alias("after"), op.alias("op"), F.unix_millis("instant").alias("ts_ms"))
    value_id = F.when(newer, VALUE_IDS[1]).otherwise(VALUE_IDS[0])
    return events.select(
        build_frame(F.lit(KEY_ID), F.to_json(F.struct(order_key.alias("o_orderkey")))).alias("key"),
        build_frame(value_id, F.to_json(envelope)).alias("value"),
        (F.lit(TOPIC) if topic is None else topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("instant").alias("timestamp"),
    )


# Wall clock of Seoul, nine hours ahead of UTC; the older version keeps milliseconds only.
DECODED_SQL = """
    SELECT CASE WHEN event_id % 5 = 0 THEN -1 - user_id * 100 - event_id % 20
                ELSE user_id * 100 + event_id % 20 END AS o_orderkey,
           user_id AS o_custkey, upper(substr(event_type, 1, 1)) AS o_orderstatus, value AS o_totalprice,
           CASE WHEN event_id % 2 = 0 THEN ts ELSE date_trunc('milliseconds', ts) END - INTERVAL 9 HOUR AS o_orderdate,
           event_type AS o_orderpriority, date_trunc('milliseconds', ts) AS last_applied_date,
           md5(CAST(CASE WHEN event_id % 5 = 0 THEN -1 - user_id * 100 - event_id % 20
                         ELSE user_id * 100 + event_id % 20 END AS VARCHAR)) AS id_iceberg,
           CASE WHEN event_id % 97 = 0 THEN NULL
                ELSE CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END END AS __op,
           event_id AS __offset
    FROM events
"""


@query("decode_envelope", DECODED_SQL)
def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of two schema versions as target rows with their operation and offset."""
    records = split_frames(staged(framed_events(spark, sf_dir), "records"))
    target = spark.createDataFrame([], TARGET_DDL).schema
    rows = decode_all_changes(records, schema_pairs(records, registry), target, JSON)
    return rows.select(*target.names, OP, OFFSET)


FRAMES = """
    SELECT event_id, CAST(100 + user_id % 300 AS INT) AS key_id,
           CAST(70000 + event_id % 70000 AS INT) AS value_id, user_id, event_type, props
    FROM {events}
"""


@query(
    "frame_split",
    f"""
    SELECT event_id AS offset_no, key_id AS key_schema_id,
           CASE WHEN event_id % 13 = 0 THEN NULL ELSE value_id END AS value_schema_id,
           CAST(user_id AS VARCHAR) AS key_text,
           CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN '' ELSE props END AS value_text
    FROM ({FRAMES})
    """,
)
def frame_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and payloads of frames, among them tombstones and empty payloads."""
    rows = derive(spark, sf_dir, FRAMES)
    payload = F.when(F.col("event_id") % 17 == 0, "").otherwise(F.col("props"))
    records = rows.select(
        build_frame(F.col("key_id"), F.col("user_id").cast("string")).alias("key"),
        F.when(F.col("event_id") % 13 != 0, build_frame(F.col("value_id"), payload)).alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )
    return split_frames(records).select(
        F.col("offset").alias("offset_no"),
        "key_schema_id",
        "value_schema_id",
        F.col("key").cast("string").alias("key_text"),
        F.col("value").cast("string").alias("value_text"),
    )


@query(
    "schema_ids",
    f"SELECT DISTINCT CASE WHEN event_id % 2 = 0 THEN {VALUE_IDS[1]} ELSE {VALUE_IDS[0]} END AS value_schema_id, "
    f"{KEY_ID} AS key_schema_id FROM events",
)
def distinct_schema_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_ids(split_frames(framed_events(spark, sf_dir)))


@query(
    "batch_stats",
    """
    SELECT count(*) AS event_count, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS max_event_ts,
           min(event_id) AS min_offset, max(event_id) AS max_offset, CAST(0 AS BIGINT) AS tombstones FROM events
    """,
)
def stats_of_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = batch_stats(split_frames(framed_events(spark, sf_dir)))
    return stats.selectExpr(
        "events AS event_count", "newest AS max_event_ts", "first AS min_offset", "last AS max_offset", "tombstones"
    )


@query(
    "logical_casts",
    """
    SELECT event_id, CAST(ts AS DATE) AS date_value,
           TIMESTAMP '1970-01-01 00:00:00' + (ts - date_trunc('day', ts)) AS time_value,
           CASE WHEN event_id % 101 <> 0 THEN date_trunc('milliseconds', ts) - INTERVAL 9 HOUR END AS millis_value,
           CASE WHEN event_id % 103 <> 0 THEN ts - INTERVAL 9 HOUR END AS micros_value,
           ts AS zoned_value, event_type AS other_value
    FROM events
    """,
)
def logical_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire values of every logical type; a zero time is a missing one."""
    instant = F.col("ts").cast("timestamp")
    day_micros = 86_400_000_000
    wire = table(spark, sf_dir, "events").select(
        "event_id",
        F.unix_date(F.to_date("ts")).alias("days"),
        (F.unix_micros(instant) % day_micros).alias("time_micros"),
        F.when(F.col("event_id") % 101 == 0, F.lit(0)).otherwise(F.unix_millis(instant)).alias("millis"),
        F.when(F.col("event_id") % 103 == 0, F.lit(0)).otherwise(F.unix_micros(instant)).alias("micros"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("zoned"),
        "event_type",
    )
    return wire.select(
        "event_id",
        cast_logical(F.col("days"), DATE).alias("date_value"),
        cast_logical(F.col("time_micros"), MICRO_TIME).alias("time_value"),
        cast_logical(F.col("millis"), TIMESTAMP).alias("millis_value"),
        cast_logical(F.col("micros"), MICRO_TIMESTAMP).alias("micros_value"),
        cast_logical(F.col("zoned"), ZONED_TIMESTAMP).cast("timestamp").alias("zoned_value"),
        cast_logical(F.col("event_type"), "string").alias("other_value"),
    )


SCHEMA_TEXT = """
    SELECT p_partkey AS schema_id,
           '{"type":"record","name":"Envelope","fields":[{"name":"' ||
           CASE WHEN p_size % 2 = 0 THEN 'before' ELSE 'after' END ||
           '","type":["null",{"type":"record","name":"Value","fields":[{"name":"id","type":"long"},{"name":"c_' ||
           p_size || '","type":' ||
           CASE p_partkey % 5
                WHEN 0 THEN '{"type":"int","connect.name":"io.debezium.time.Date"}'
                WHEN 1 THEN '["null",{"type":"long","connect.version":1,"connect.name":"io.debezium.time.MicroTimestamp"}]'
                WHEN 2 THEN '["null","string"]'
                WHEN 3 THEN '{"type":"bytes","scale":2}'
                ELSE '[{"type":"string","connect.name":"io.debezium.time.ZonedTimestamp"},"null"]' END ||
           '},{"name":"last","type":["null","double"],"default":null}]}]},{"name":"op","type":"string"}]}' AS schema_str
    FROM """


@query(
    "schema_types",
    """
    SELECT p_partkey AS schema_id, 0 AS position, 'id' AS column_name, 'long' AS logical_type FROM part
    UNION ALL
    SELECT p_partkey, 1, 'c_' || p_size,
           CASE p_partkey % 5 WHEN 0 THEN 'io.debezium.time.Date' WHEN 1 THEN 'io.debezium.time.MicroTimestamp'
                WHEN 2 THEN 'string' WHEN 3 THEN 'bytes' ELSE 'io.debezium.time.ZonedTimestamp' END FROM part
    UNION ALL
    SELECT p_partkey, 2, 'last', 'double' FROM part
    """,
)
def schema_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column types of one schema text per part."""
    parts = table(spark, sf_dir, "part")
    return column_types(parts.selectExpr(*_select_list(SCHEMA_TEXT)))


KEY_TEXT = """
    SELECT s_suppkey AS schema_id,
           '{"type":"record","name":"Key","fields":[{"name":"nation_' || s_nationkey || '","type":"int"}' ||
           CASE WHEN s_suppkey % 2 = 0 THEN ',{"name":"id","type":["null","long"]}' ELSE '' END || ']}' AS schema_str
    FROM """


@query(
    "key_columns",
    """
    SELECT s_suppkey AS schema_id, 0 AS position, 'nation_' || s_nationkey AS column_name FROM supplier
    UNION ALL
    SELECT s_suppkey, 1, 'id' FROM supplier WHERE s_suppkey % 2 = 0
    """,
)
def key_columns_of_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_columns(table(spark, sf_dir, "supplier").selectExpr(*_select_list(KEY_TEXT)))


def _select_list(sql: str) -> list[str]:
    """The two expressions of the texts above; braces in them rule out a formatted query."""
    body = sql.strip().removeprefix("SELECT").removesuffix("FROM").strip()
    first, rest = body.split(",", 1)
    return [first, rest]



MYSQL_TYPES_DERIVED = """
    SELECT o_orderkey,
           CASE o_orderkey % 9
                WHEN 0 THEN 'int(' || (o_custkey % 11 + 1) || ') unsigned'
                WHEN 1 THEN '  VARCHAR(' || o_custkey || ')  '
                WHEN 2 THEN 'decimal(' || (o_custkey % 20 + 12) || ',' || (o_custkey % 12) || ')'
                WHEN 3 THEN 'decimal(' || (o_custkey % 38 + 1) || ')'
                WHEN 4 THEN 'tinyint(' || (o_custkey % 4 + 1) || ')'
                WHEN 5 THEN 'enum(''a'',''b' || o_custkey || ''')'
                WHEN 6 THEN 'bigint unsigned'
                WHEN 7 THEN 'geometry'
                ELSE 'datetime(' || (o_custkey % 6) || ')' END AS column_type
    FROM {orders}
"""


@query(
    "type_mapping_mysql",
    f"""
    SELECT o_orderkey, column_type,
           CASE WHEN column_type LIKE 'int%unsigned' OR column_type LIKE 'bigint%' THEN 'bigint'
                WHEN column_type LIKE 'decimal(%,%' THEN column_type
                WHEN column_type LIKE 'decimal%' THEN replace(column_type, ')', ',0)')
                WHEN column_type = 'tinyint(1)' THEN 'boolean'
                WHEN column_type LIKE 'tinyint%' THEN 'int'
                WHEN column_type LIKE 'datetime%' THEN 'timestamp'
                ELSE 'string' END AS spark_type
    FROM ({MYSQL_TYPES_DERIVED})
    """,
)
def type_mapping_mysql(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive(spark, sf_dir, MYSQL_TYPES_DERIVED)
    return rows.select("o_orderkey", "column_type", expected_type(F.col("column_type"), MYSQL).alias("spark_type"))


SQLSERVER_TYPES_DERIVED = """
    SELECT o_orderkey,
           CASE o_orderkey % 12
                WHEN 0 THEN 'bigint' WHEN 1 THEN 'tinyint' WHEN 2 THEN 'bit' WHEN 3 THEN 'Money'
                WHEN 4 THEN 'smallmoney' WHEN 5 THEN 'numeric' WHEN 6 THEN 'float' WHEN 7 THEN 'real'
                WHEN 8 THEN 'nvarchar(' || o_custkey || ')' WHEN 9 THEN 'datetime2' WHEN 10 THEN 'hierarchyid'
                ELSE 'varbinary(' || o_custkey || ')' END AS column_type
    FROM {orders}
"""


@query(
    "type_mapping_sqlserver",
    f"""
    SELECT o_orderkey, column_type,
           CASE o_orderkey % 12 WHEN 0 THEN 'bigint' WHEN 1 THEN 'smallint' WHEN 2 THEN 'boolean'
                WHEN 3 THEN 'decimal(19,4)' WHEN 4 THEN 'decimal(10,4)' WHEN 5 THEN 'decimal(38,10)'
                WHEN 6 THEN 'double' WHEN 7 THEN 'float' WHEN 9 THEN 'timestamp' WHEN 11 THEN 'binary'
                ELSE 'string' END AS spark_type
    FROM ({SQLSERVER_TYPES_DERIVED})
    """,
)
def type_mapping_sqlserver(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive(spark, sf_dir, SQLSERVER_TYPES_DERIVED)
    return rows.select("o_orderkey", "column_type", expected_type(F.col("column_type"), SQLSERVER).alias("spark_type"))
