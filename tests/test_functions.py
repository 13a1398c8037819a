"""Types, names, keys, frames and logical types."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.frames import build_frame, split_frames
from tidewell.functions.keys import hash_key, row_key
from tidewell.functions.logical_types import (
    DATE,
    MICRO_TIME,
    MICRO_TIMESTAMP,
    TIMESTAMP,
    ZONED_TIMESTAMP,
    cast_logical,
)
from tidewell.functions.names import bronze_parts_of_topic, parse_source_table, parse_topic
from tidewell.functions.projections import (
    project_to_schema,
    stamp_or_rename,
    trim_and_shift_to_utc,
    trim_strings,
    with_date_partitions,
)
from tidewell.functions.source_types import MYSQL_TYPES, SQLSERVER_TYPES, expected_type, resolve_type, spark_type

TYPE_CASES = {
    "mysql": {
        "int": "int", "smallint": "int", "tinyint": "int", "bigint": "bigint", "float": "float",
        "double": "double", "boolean": "boolean", "varchar(255)": "string", "char(10)": "string",
        "text": "string", "tinytext": "string", "mediumtext": "string", "longtext": "string",
        "enum('a','b')": "string", "set('x','y')": "string", "json": "string", "date": "date",
        "datetime": "timestamp", "timestamp": "timestamp", "time": "timestamp", "tinyint(1)": "boolean",
        "tinyint(4)": "int", "decimal(10,2)": "decimal(10,2)", "decimal(5)": "decimal(5,0)",
        "decimal": "decimal(10,0)", "int unsigned": "bigint", "int(10) unsigned": "bigint",
        "INT(10)  UNSIGNED": "bigint", "bigint unsigned": "bigint", "tinyint(1) unsigned": "boolean",
        "tinyint unsigned": "int", "decimal(12,3) unsigned": "decimal(12,3)", "datetime(6)": "timestamp",
        "blob": "binary", "tinyblob": "binary", "mediumblob": "binary", "longblob": "binary",
        "  varchar(255)  ": "string", "geometry": "string", "": "string",
    },
    "sqlserver": {
        "int": "int", "bigint": "bigint", "smallint": "smallint", "tinyint": "smallint", "bit": "boolean",
        "float": "double", "real": "float", "varchar": "string", "nvarchar": "string", "char": "string",
        "nchar": "string", "text": "string", "ntext": "string", "uniqueidentifier": "string",
        "xml": "string", "sql_variant": "string", "date": "date", "datetime": "timestamp",
        "datetime2": "timestamp", "smalldatetime": "timestamp", "time": "string",
        "decimal": "decimal(38,10)", "numeric": "decimal(38,10)", "money": "decimal(19,4)",
        "smallmoney": "decimal(10,4)", "binary": "binary", "varbinary": "binary", "image": "binary",
        "hierarchyid": "string", "geometry": "string",
    },
}


@pytest.mark.parametrize("dialect", sorted(TYPE_CASES))
def test_types_as_column_and_on_driver(spark, dialect):
    cases = TYPE_CASES[dialect]
    rows = spark.createDataFrame([(k,) for k in cases], "t STRING")
    got = {r[0]: r[1] for r in rows.select("t", expected_type(F.col("t"), dialect)).collect()}
    assert got == cases
    assert {name: resolve_type(name, dialect) for name in cases} == {n: spark_type(t) for n, t in cases.items()}


@pytest.mark.parametrize("dialect", sorted(TYPE_CASES))
def test_column_and_driver_agree_on_any_text(spark, dialect):
    rng = random.Random(11)
    names = [*MYSQL_TYPES, *SQLSERVER_TYPES, "geometry", "double precision", "bit varying", ""]
    tails = ["", "(1)", "(4)", "(10,2)", "( 38 , 10 )", "('a','1')", "(max)", "(", "()", " (3)"]
    ends = ["", " unsigned", " UNSIGNED zerofill", "  ", "\tunsigned", " character set utf8"]
    texts = sorted({
        "".join((rng.choice(["", "  "]), rng.choice([str.lower, str.upper])(rng.choice(names)), rng.choice(tails), rng.choice(ends)))
        for _ in range(1500)
    })
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = {r[0]: r[1] for r in rows.select("t", expected_type(F.col("t"), dialect)).collect()}
    assert {t: spark_type(got[t]) for t in texts} == {t: resolve_type(t, dialect) for t in texts}


def test_source_names():
    table = parse_source_table("store.TB_ITEMS", "mysql")
    assert table.bronze_name("lake") == "lake.store_bronze.tb_items"
    assert table.parquet_path("/raw/") == "/raw/store/TB_ITEMS"
    assert parse_source_table("Store.dbo.tb", "sqlserver").bronze_name() == "store_bronze.tb"
    assert parse_topic("p.Shop.Orders").bronze_name() == "shop_bronze.orders"


@pytest.mark.parametrize("name,dialect", [("a", "mysql"), ("a.b.c", "mysql"), ("a.b.c.d", "sqlserver"), ("a.", None)])
def test_bad_source_names(name, dialect):
    with pytest.raises(ValueError):
        parse_source_table(name, dialect)


def test_bad_topic(spark):
    with pytest.raises(ValueError):
        parse_topic("a.b")
    rows = spark.createDataFrame([("a.b",), ("p.S.T",)], "t STRING").select(*bronze_parts_of_topic(F.col("t")))
    assert [tuple(r) for r in rows.collect()] == [(None, None), ("s_bronze", "t")]


def test_key_skips_nulls_and_ignores_padding(spark):
    df = spark.createDataFrame([(1, "a  ", None), (1, "a", None)], "i INT, s STRING, n STRING")
    keys = {r[0] for r in df.select(row_key(df, ["i", "s", "n"])).collect()}
    want = spark.range(1).select(hash_key([F.lit(1), F.lit("a")])).first()[0]
    assert keys == {want}


def test_frames_round_trip_with_tombstone_and_empty_payload(spark):
    rows = spark.createDataFrame([(1, 300, b"abc"), (2, 2147483647, b""), (3, 1, None)], "o LONG, id INT, p BINARY")
    value = F.when(F.col("p").isNotNull(), build_frame(F.col("id"), F.col("p")))
    records = rows.select(
        build_frame(F.lit(7), F.lit("k")).alias("key"), value.alias("value"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), F.col("o").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"),
    )
    got = [(r.key_schema_id, r.value_schema_id, r.value) for r in split_frames(records).orderBy("offset").collect()]
    assert got == [(7, 300, b"abc"), (7, 2147483647, b""), (7, None, None)]


def test_logical_types(spark):
    row = (18641, 18291000000, 1758712669000, 1758712669557813, "2025-09-24T02:17:49.557813Z", 0)
    df = spark.createDataFrame([row], "d INT, t LONG, ms LONG, us LONG, z STRING, zero LONG")
    got = df.select(
        cast_logical(F.col("d"), DATE).cast("string"),
        cast_logical(F.col("t"), MICRO_TIME).cast("string"),
        cast_logical(F.col("ms"), TIMESTAMP).cast("string"),
        cast_logical(F.col("us"), MICRO_TIMESTAMP).cast("string"),
        cast_logical(F.col("z"), ZONED_TIMESTAMP).cast("timestamp").cast("string"),
        cast_logical(F.col("zero"), TIMESTAMP),
        cast_logical(F.col("zero"), TIMESTAMP, "UTC", zero_is_null=False).cast("string"),
        cast_logical(F.col("z"), None),
    ).first()
    assert tuple(got) == (
        "2021-01-14", "1970-01-01 05:04:51", "2025-09-24 02:17:49", "2025-09-24 02:17:49.557813",
        "2025-09-24 02:17:49.557813", None, "1970-01-01 00:00:00", "2025-09-24T02:17:49.557813Z",
    )


def test_trim_keeps_tabs_and_other_types(spark):
    df = spark.createDataFrame([("  a\t ", 1, None)], "s STRING, i INT, n STRING")
    assert tuple(trim_strings(df).first()) == ("a\t", 1, None)


def test_shift_to_utc_handles_both_timestamp_types(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 09:00:00' AS a, TIMESTAMP_NTZ '2024-01-01 09:00:00' AS b, ' x ' AS c")
    got = trim_and_shift_to_utc(df, "Asia/Seoul")
    assert trim_and_shift_to_utc(df).drop("c").collect() == df.drop("c").collect()
    assert [f.dataType for f in got.schema] == [f.dataType for f in df.schema]
    assert tuple(got.select(F.col("a").cast("string"), F.col("b").cast("string"), "c").first()) == (
        "2024-01-01 00:00:00", "2024-01-01 00:00:00", "x",
    )


def test_staged_time_is_renamed_or_stamped(spark):
    staged = spark.sql("SELECT 1 AS a, TIMESTAMP '2024-01-01 00:00:00' AS update_ts_dms")
    assert stamp_or_rename(staged).columns == ["a", "last_applied_date"]
    fresh = stamp_or_rename(spark.sql("SELECT 1 AS a"), dt.datetime(2024, 2, 3, 4, 5, 6))
    assert fresh.select(F.col("last_applied_date").cast("string")).first()[0] == "2024-02-03 04:05:06"


def test_projection_drops_reorders_casts_and_fails_on_a_missing_column(spark):
    df = spark.createDataFrame([("7", 1, "x")], "a STRING, b INT, extra STRING")
    target = T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.IntegerType())])
    assert project_to_schema(df, target).schema.simpleString() == "struct<b:string,a:int>"
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        project_to_schema(df, T.StructType([*target.fields, T.StructField("missing", T.IntegerType())]))


def test_bad_values_fail_or_become_null(spark):
    df = spark.createDataFrame([("seven",)], "a STRING")
    target = T.StructType([T.StructField("a", T.IntegerType())])
    assert project_to_schema(df, target, lenient=True).first()[0] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        project_to_schema(df, target).collect()


def test_date_partitions(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-03-05 23:59:59' AS timestamp")
    assert tuple(with_date_partitions(df).select("year", "month", "day").first()) == ("2024", "03", "05")
