"""The database path, over a stand-in for the JDBC reader that answers from a file."""

import datetime as dt
import decimal
import json

import pytest
from pyspark.sql import functions as F

from tidewell.__main__ import main
from tidewell.functions.keys import hash_key
from tidewell.operators.ranges import equi_depth_ranges, literal, range_predicates, ranges_sql
from tidewell.plans.snapshot import load_many, load_staged, load_table, stage_table
from tidewell.plans.validate import validate_tables
from tidewell.sinks.tables import PARQUET, BronzeStore, table_comment
from tidewell.sources.jdbc import JdbcSource
from tidewell.sources.kafka import KafkaSource
from tidewell.sources.metadata import SourceMetadata


def register_reader(spark):
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Range(InputPartition):
        def __init__(self, column, low, high, first):
            self.column, self.low, self.high, self.first = column, low, high, first

    class Reader(DataSourceReader):
        def __init__(self, options, answer):
            self.options, self.answer = options, answer

        def partitions(self):
            count = int(self.options.get("numpartitions", "1"))
            column = self.options.get("partitioncolumn")
            if not column:
                return [Range(None, None, None, True)]
            low, high = int(self.options["lowerbound"]), int(self.options["upperbound"])
            step = max(1, (high - low) // count)
            cuts = [low + step * i for i in range(1, count)]
            return [Range(column, a, b, a is None) for a, b in zip([None, *cuts], [*cuts, None])]

        def read(self, partition):
            names = [part.split()[0] for part in self.answer["schema"].split(", ")]
            for row in self.answer["rows"]:
                value = row[names.index(partition.column)] if partition.column else None
                above = partition.low is None or (value is not None and value >= partition.low)
                below = partition.high is None or (value is None and partition.first) or (value is not None and value < partition.high)
                if above and below:
                    yield tuple(row)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return "answers"

        def _answer(self):
            import json

            with open(self.options["answers"]) as file:
                answers = json.load(file)
            if "dbtable" in self.options:
                return answers["table " + self.options["dbtable"]]
            found = [a for text, a in answers.items() if text in self.options["query"]]
            if len(found) != 1:
                raise ValueError(f"no single answer to {self.options['query']}")
            return found[0]

        def schema(self):
            return self._answer()["schema"]

        def reader(self, schema):
            return Reader({k.lower(): v for k, v in self.options.items()}, self._answer())

    spark.dataSource.register(Source)


TABLE = {"schema": "id int, char36 string, extra string", "rows": [(i, f"c{i}   ", None) for i in range(1, 21)]}
BOUNDS = "SELECT min(`id`) AS lower_bound, max(`id`) AS upper_bound FROM store.TB_ITEMS"


def mysql_answers():
    return {
        "FROM information_schema.COLUMNS WHERE (TABLE_SCHEMA, TABLE_NAME) IN (('store', 'TB_ITEMS'))": {
            "schema": "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, ORDINAL_POSITION int, "
            "DATA_TYPE string, COLUMN_TYPE string, EXTRA string, IS_NULLABLE string, COLUMN_COMMENT string",
            "rows": [
                ("store", "TB_ITEMS", "id", 1, "int", "int(11)", "auto_increment", "NO", "상품 번호"),
                ("store", "TB_ITEMS", "char36", 2, "char", "char(36)", "", "YES", "char"),
                ("store", "TB_ITEMS", "added", 3, "varchar", "varchar(9)", "", "YES", ""),
            ],
        },
        "FROM information_schema.KEY_COLUMN_USAGE": {
            "schema": "TABLE_SCHEMA string, TABLE_NAME string, CONSTRAINT_NAME string, COLUMN_NAME string, "
            "ORDINAL_POSITION int",
            "rows": [("store", "TB_ITEMS", "PRIMARY", "id", 1), ("store", "TB_ITEMS", "uk", "char36", 1)],
        },
        "FROM information_schema.TABLES": {
            "schema": "TABLE_SCHEMA string, TABLE_NAME string, TABLE_COMMENT string, TABLE_ROWS bigint, "
            "DATA_LENGTH bigint, INDEX_LENGTH bigint",
            "rows": [("store", "TB_ITEMS", "상품 목록", 20, 1 << 31, 1 << 30)],
        },
        BOUNDS: {"schema": "lower_bound int, upper_bound int", "rows": [(1, 20)]},
        "table store.TB_ITEMS": TABLE,
    }


def sqlserver_answers():
    return {
        "INFORMATION_SCHEMA.COLUMNS WHERE ((TABLE_SCHEMA = 'dbo' AND TABLE_NAME = 'tb_day'))": {
            "schema": "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, ORDINAL_POSITION int, "
            "DATA_TYPE string, COLUMN_TYPE string, IS_NULLABLE string, OBJECT_ID int, COLUMN_ID int, IS_IDENTITY int",
            "rows": [
                ("store", "tb_day", "made", 1, "date", "date", "YES", 5, 1, 0),
                ("store", "tb_day", "id", 2, "int", "int", "NO", 5, 2, 1),
            ],
        },
        "INFORMATION_SCHEMA.KEY_COLUMN_USAGE": {
            "schema": "TABLE_SCHEMA string, TABLE_NAME string, CONSTRAINT_NAME string, COLUMN_NAME string, "
            "ORDINAL_POSITION int",
            "rows": [("store", "tb_day", "pk", "made", 2), ("store", "tb_day", "pk", "id", 1), ("store", "tb_day", "uq", "made", 1)],
        },
        "INFORMATION_SCHEMA.TABLE_CONSTRAINTS": {
            "schema": "TABLE_SCHEMA string, TABLE_NAME string, CONSTRAINT_NAME string, CONSTRAINT_TYPE string",
            "rows": [("store", "tb_day", "pk", "PRIMARY KEY"), ("store", "tb_day", "uq", "UNIQUE")],
        },
        "FROM INFORMATION_SCHEMA.TABLES": {
            "schema": "TABLE_SCHEMA string, TABLE_NAME string, OBJECT_ID int",
            "rows": [("store", "tb_day", 5)],
        },
        "FROM sys.indexes": {"schema": "object_id int, index_id int", "rows": [(5, 1), (5, 2)]},
        "FROM sys.partitions": {
            "schema": "partition_id bigint, object_id int, index_id int, rows bigint",
            "rows": [(50, 5, 1, 7), (51, 5, 2, 7)],
        },
        "FROM sys.allocation_units": {
            "schema": "container_id bigint, total_pages bigint",
            "rows": [(50, 100), (50, 28), (51, 128)],
        },
        "FROM sys.extended_properties": {
            "schema": "major_id int, minor_id int, name string, value string",
            "rows": [(5, 2, "MS_Description", "the key"), (5, 0, "MS_Description", "lower")],
        },
        "SELECT min([id]) AS lower_bound, max([id]) AS upper_bound FROM dbo.tb_day": {
            "schema": "lower_bound int, upper_bound int",
            "rows": [(None, None)],
        },
        "table dbo.tb_day": {"schema": "made string, id int", "rows": []},
    }


def source(spark, folder, dialect, answers):
    register_reader(spark)
    path = f"{folder}/answers.json"
    with open(path, "w") as file:
        json.dump(answers, file)
    return JdbcSource(dialect, "db", 1, "u", "secret", "answers", {"answers": path})


@pytest.fixture()
def mysql(spark, folder):
    return source(spark, folder, "mysql", mysql_answers())


@pytest.fixture()
def store(folder):
    # Tables of other tests may have the same name in the session's catalog; each load replaces them.
    return BronzeStore(f"{folder}/wh", provider=PARQUET)


def test_options():
    mysql = JdbcSource("mysql", "h", 3306, "u", "p").options("store")
    assert mysql["url"].startswith("jdbc:mysql://h:3306/store?zeroDateTimeBehavior=convertToNull")
    server = JdbcSource("sqlserver", "h", 1433, "u", "p")
    assert server.options("store")["url"] == "jdbc:sqlserver://h:1433;databaseName=store;encrypt=false;"
    assert server.options()["url"] == "jdbc:sqlserver://h:1433;encrypt=false;"
    assert server.quoted("a]b") == "[a]]b]"
    assert "secret" not in repr(JdbcSource("mysql", "h", 1, "u", "secret"))
    with pytest.raises(ValueError):
        JdbcSource("oracle", "h", 1, "u", "p")


def test_broker_options():
    options = KafkaSource("b:9092").options(["a", "b"])
    assert options == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "a,b", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000000", "failOnDataLoss": "false",
    }


def test_scan_by_ranges_reads_every_row_once(spark, mysql):
    df = mysql.scan(spark, "store.TB_ITEMS", "id", 4, "store")
    assert df.rdd.getNumPartitions() == 4
    assert sorted(r.id for r in df.collect()) == list(range(1, 21))
    assert mysql.scan(spark, "store.TB_ITEMS", None, 4, "store").rdd.getNumPartitions() == 1


def test_empty_table_is_read_over_one_connection(spark, folder):
    answers = mysql_answers()
    answers[BOUNDS] = {"schema": "lower_bound int, upper_bound int", "rows": [(None, None)]}
    answers["table store.TB_ITEMS"] = {**TABLE, "rows": []}
    df = source(spark, folder, "mysql", answers).scan(spark, "store.TB_ITEMS", "id", 4, "store")
    assert (df.rdd.getNumPartitions(), df.count()) == (1, 0)


def test_mysql_table_to_bronze(spark, mysql, store):
    load_table(spark, mysql, store, "store.TB_ITEMS", partitions=3)
    bronze = spark.table("store_bronze.tb_items")
    assert bronze.columns == ["id", "char36", "extra", "last_applied_date", "id_iceberg", "key_bucket"]
    assert bronze.count() == 20
    assert bronze.filter(F.col("id_iceberg") == hash_key([F.col("id")])).filter("char36 = concat('c', id)").count() == 20
    # Three gigabytes according to the source.
    assert spark.sql("SHOW TBLPROPERTIES store_bronze.tb_items ('buckets')").first()["value"] == "3"


def test_mysql_table_to_bronze_by_way_of_parquet(spark, mysql, store, folder):
    path = stage_table(spark, mysql, f"{folder}/raw", "store.TB_ITEMS", 2)
    assert path == f"{folder}/raw/store/TB_ITEMS"
    assert spark.read.parquet(path).columns == ["id", "char36", "extra", "update_ts_dms"]
    load_staged(spark, f"{folder}/raw", store, "store.TB_ITEMS", ["id"])
    assert spark.table("store_bronze.tb_items").columns[:5] == ["id", "char36", "extra", "last_applied_date", "id_iceberg"]


def test_sqlserver_metadata_and_an_empty_table(spark, folder, store):
    server = source(spark, folder, "sqlserver", sqlserver_answers())
    metadata = SourceMetadata(spark, server, ["store.dbo.tb_day"])
    with pytest.raises(ValueError, match="same bronze table"):
        SourceMetadata(spark, server, ["store.dbo.tb_day", "store.sales.TB_DAY"])
    assert metadata.primary_key_of("store.dbo.tb_day") == ["id", "made"]
    assert metadata.partition_key_of("store.dbo.tb_day") == "id"
    assert tuple(metadata.sizes().first()) == ("store", "tb_day", 7, 2.0)
    assert metadata.size_of("store.dbo.tb_day") == 2 * 1024 * 1024
    comments = {r.column_name: r.column_comment for r in metadata.column_comments().collect()}
    assert comments == {"made": "", "id": "the key"}
    assert metadata.table_comments().first().table_comment == "lower"
    assert metadata.schema_of("store.dbo.tb_day") == {"made": "date", "id": "int"}
    assert {r.column_name: r.nullable for r in metadata.nullability().collect()} == {"made": True, "id": False}
    load_table(spark, server, store, "store.dbo.tb_day", 3)
    assert spark.table("store_bronze.tb_day").count() == 0


def test_validation_reports_and_carries_comments_over(spark, mysql, store):
    load_table(spark, mysql, store, "store.TB_ITEMS")
    report = validate_tables(spark, mysql, store, ["store.TB_ITEMS"])
    got = sorted(((r.check, r.column_name, r.source_value, r.target_value) for r in report.collect()), key=str)
    assert got == [
        ("column_comment", "char36", "char", ""), ("column_comment", "id", "상품 번호", ""),
        ("nullable", "id", "false", "true"), ("table_comment", None, "상품 목록", ""),
        ("unreflected", "added", "varchar(9)", None),
    ]
    assert spark.table("store_bronze.tb_items").schema["id"].metadata["comment"] == "상품 번호"
    assert table_comment(spark, "store_bronze.tb_items") == "상품 목록"
    again = validate_tables(spark, mysql, store, ["store.TB_ITEMS"])
    assert sorted(r.check for r in again.collect()) == ["nullable", "unreflected"]


def test_many_loads_go_on_after_a_failure(spark, mysql, store):
    names = ["store.TB_ITEMS", "store.NO_SUCH"]
    outcomes = load_many(spark, names, lambda name: load_table(spark, mysql, store, name))
    assert [(o.name, o.status) for o in outcomes] == [("store.TB_ITEMS", "done"), ("store.NO_SUCH", "failed")]


def test_jobs_from_the_command_line(spark, folder, mysql):
    config = {
        "source": {"dialect": "mysql", "host": "db", "port": 1, "user": "u", "password": "p", "reader": "answers",
                   "extra": mysql.extra},
        "store": {"warehouse": f"{folder}/wh", "provider": "parquet", "buckets": 2},
        "parquet_warehouse": f"{folder}/raw",
    }
    path = f"{folder}/config.json"
    with open(path, "w") as file:
        json.dump(config, file)
    for job in ("load", "stage", "load-staged", "validate"):
        assert main([job, "--config", path, "--table", "store.TB_ITEMS"]) == 0
    assert spark.table("store_bronze.tb_items").count() == 20
    assert main(["maintain", "--config", path, "--schemas", "store_bronze", "--retention-days", "1"]) == 0
    assert main(["maintain-ledger", "--config", path, "--retention-days", "7"]) == 0
    assert main(["load", "--config", path, "--table", "store.NO_SUCH"]) == 1


def even_answers(borders, key):
    """What the database answers about ranges, and each range's rows."""
    quoted = f"`{key}`"
    names = ["id", "char36", "extra"]
    at = names.index(key)
    rows = [tuple(r) for r in TABLE["rows"]] + [(None, None, "no key")]
    literals = [f"'{b}'" if isinstance(b, str) else str(b) for b in borders]
    answers = {
        "SELECT range_no": {
            "schema": f"range_no int, lower_bound {'string' if isinstance(borders[0], str) else 'int'}",
            "rows": [(0, rows[0][at]), *((i + 1, b) for i, b in reversed(list(enumerate(borders))))],
        }
    }
    for i in range(len(borders) + 1):
        low, high = borders[i - 1] if i else None, borders[i] if i < len(borders) else None
        if i == 0:
            condition = f"WHERE {quoted} < {literals[0]} OR {quoted} IS NULL"
        elif high is None:
            condition = f"WHERE {quoted} >= {literals[-1]}"
        else:
            condition = f"WHERE {quoted} >= {literals[i - 1]} AND {quoted} < {literals[i]}"
        within = [
            r for r in rows
            if (r[at] is None and i == 0) or (r[at] is not None and (low is None or r[at] >= low) and (high is None or r[at] < high))
        ]
        answers[condition] = {"schema": TABLE["schema"], "rows": within}
    return answers


@pytest.mark.parametrize("key, borders", [("id", [4, 9]), ("char36", ["c15   ", "c3   "])])
def test_even_ranges_read_every_row_once(spark, folder, key, borders):
    register_reader(spark)
    with open(f"{folder}/answers.json", "w") as file:
        json.dump(even_answers(borders, key), file)
    source = JdbcSource("mysql", "db", 3306, "u", "p", reader="answers", extra={"answers": f"{folder}/answers.json"})
    df = source.table_by_even_ranges(spark, "store.TB_ITEMS", key, 3)
    assert df.rdd.getNumPartitions() == 3
    assert sorted(r["id"] or 0 for r in df.collect()) == list(range(21))


def test_conditions_of_ranges():
    mysql, sqlserver = JdbcSource("mysql", "h", 1, "u", "p"), JdbcSource("sqlserver", "h", 1, "u", "p")
    assert range_predicates("k", []) == ["1 = 1"]
    assert range_predicates("k", ["5"]) == ["k < 5 OR k IS NULL", "k >= 5"]
    assert range_predicates("k", ["'a'", "'b'"])[1] == "k >= 'a' AND k < 'b'"
    assert mysql.literal("it's \\ here") == "'it''s \\\\ here'" and sqlserver.literal("it's \\ here") == "'it''s \\ here'"
    assert [literal(v) for v in (b"\x01\xff", dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3), True, decimal.Decimal("1.50"))] == [
        "0x01ff", "'2024-01-02'", "'2024-01-02 03:00:00'", "1", "1.50"
    ]


@pytest.mark.parametrize("kind", ["numbers", "texts"])
def test_ranges_hold_about_as_many_rows(spark, kind):
    """Keys that crowd at one end, a key with a tenth of the rows, and NULL keys."""
    keys = [k**3 for k in range(900)] + [7] * 100 + [None] * 50
    if kind == "texts":
        keys = [None if k is None else f"id-{k:012d}" for k in keys]
    df = spark.createDataFrame([(k,) for k in keys], f"k {'string' if kind == 'texts' else 'long'}").repartition(5)
    rows = equi_depth_ranges(df, "k", 8).orderBy("range_no").collect()
    assert sum(r["rows"] for r in rows) == 1000 and max(r["rows"] for r in rows) < 2 * 1000 / 8
    assert [r["lower_bound"] for r in rows] == sorted(r["lower_bound"] for r in rows)
    by_database = spark.sql(ranges_sql("{t}", "k", 8), t=df).orderBy("range_no").collect()
    assert [(r["lower_bound"], r["upper_bound"], int(r["row_count"])) for r in by_database] == [
        (r["lower_bound"], r["upper_bound"], r["rows"]) for r in rows
    ]
    nothing = spark.createDataFrame([], "k long")
    assert equi_depth_ranges(nothing, "k", 8).collect() == []
