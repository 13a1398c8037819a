"""Full loads: names, keys, trimming, bounds, staged files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.keys import row_key
from tidewell.functions.names import KEY_COLUMN, STAGED_TIME_COLUMN, bronze_parts_of_topic
from tidewell.functions.projections import project_to_schema, trim_strings
from tidewell.functions.times import retention_cutoff
from tidewell.plans.snapshot import bronze_rows, bronze_rows_from_staged, load_many, outcome_rows, staged_rows
from tidewell.queries.registry import RUN_TIME, RUN_TIME_SQL, derive, query, table
from tidewell.session import new_workspace
from tidewell.sinks.files import overwrite_parquet
from tidewell.operators.ranges import equi_depth_ranges, literal, range_predicates
from tidewell.sources.files import read_parquet
from tidewell.sources.jdbc import bounds_of

TOPICS = """
    SELECT event_id, CASE WHEN event_id % 11 = 0 THEN event_type || '.TB_' || user_id
                          ELSE 'srv.' || upper(event_type) || '.TB_' || user_id END AS topic
    FROM {events}
"""


@query(
    "bronze_names",
    f"""
    SELECT event_id, topic,
           CASE WHEN event_id % 11 <> 0 THEN lower(split_part(topic, '.', 2)) || '_bronze' END AS bronze_schema,
           CASE WHEN event_id % 11 <> 0 THEN lower(split_part(topic, '.', 3)) END AS bronze_table
    FROM ({TOPICS})
    """,
)
def bronze_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = derive(spark, sf_dir, TOPICS)
    schema, name = bronze_parts_of_topic(F.col("topic"))
    return topics.select("event_id", "topic", schema.alias("bronze_schema"), name.alias("bronze_table"))


@query(
    "row_key",
    """
    SELECT l_orderkey, l_linenumber, l_returnflag,
           md5(concat_ws('|', l_orderkey, l_linenumber, trim(l_returnflag), CAST(l_shipdate AS DATE))) AS id_iceberg
    FROM lineitem
    """,
)
def composite_row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (
        table(spark, sf_dir, "lineitem")
        .withColumn("padded", F.rpad("l_returnflag", 8, " "))
        .withColumn("day", F.to_date("l_shipdate"))
    )
    key = row_key(lines, ["l_orderkey", "l_linenumber", "padded", "day"])
    return lines.select("l_orderkey", "l_linenumber", "l_returnflag", key.alias(KEY_COLUMN))


PADDED_CUSTOMER = """
    SELECT c_custkey, '  ' || c_name || '   ' AS c_name, c_nationkey, c_acctbal,
           rpad(c_mktsegment, 24, ' ') AS c_mktsegment
    FROM {customer}
"""


@query("trim_strings", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def trim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trim_strings(derive(spark, sf_dir, PADDED_CUSTOMER))


@query(
    "trim_texts",
    """
    SELECT doc_id, trim(text, ' ') AS text, trim(lang, ' ') AS lang, trim(source, ' ') AS source, n_chars
    FROM documents
    """,
)
def trim_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trim_strings(table(spark, sf_dir, "documents"))


SNAPSHOT_SQL = f"""
    SELECT *, {RUN_TIME_SQL} AS last_applied_date, md5(CAST(o_orderkey AS VARCHAR)) AS id_iceberg FROM orders
"""


@query("snapshot_load", SNAPSHOT_SQL)
def snapshot_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_rows(table(spark, sf_dir, "orders"), ["o_orderkey"], RUN_TIME)


@query(
    "snapshot_load_without_key",
    f"SELECT *, {RUN_TIME_SQL} AS last_applied_date FROM lineitem",
)
def snapshot_load_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_rows(table(spark, sf_dir, "lineitem"), [], RUN_TIME)


@query(
    "staged_load",
    f"""
    SELECT event_id, ts, user_id, event_type, value, props, {RUN_TIME_SQL} AS last_applied_date, md5(CAST(event_id AS VARCHAR)) AS id_iceberg
    FROM events
    """,
)
def staged_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged Parquet and its load: the time the rows were staged becomes the load time."""
    folder = new_workspace(spark, "staged")
    overwrite_parquet(staged_rows(table(spark, sf_dir, "events"), RUN_TIME), folder)
    staged = read_parquet(spark, folder)
    assert STAGED_TIME_COLUMN in staged.columns
    return bronze_rows_from_staged(staged, ["event_id"])


@query("parquet_roundtrip", "SELECT * FROM part")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_workspace(spark, "part")
    overwrite_parquet(table(spark, sf_dir, "part"), folder)
    return read_parquet(spark, folder)


@query(
    "scan_bounds",
    """
    SELECT min(l_orderkey) AS lower_bound, max(l_orderkey) AS upper_bound,
           min(l_shipdate) AS lower_date, max(l_shipdate) AS upper_date FROM lineitem
    """,
)
def scan_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the source is asked for before a scan by ranges, for a number and for a date: one pass for both."""
    return derive(spark, sf_dir, f"SELECT {bounds_of('l_orderkey')}, {bounds_of('l_shipdate', 'date')} FROM {{lineitem}}")


UNEVEN_KEYS = """
    SELECT 'number' AS kind, l_orderkey, l_linenumber,
           CASE WHEN l_orderkey % 50 <> 0 THEN CAST(l_orderkey AS DOUBLE) * l_orderkey * l_orderkey END AS number_key,
           CAST(NULL AS VARCHAR(20)) AS text_key
    FROM {lineitem}
    UNION ALL
    SELECT 'text', l_orderkey, l_linenumber, NULL,
           CASE WHEN l_orderkey % 50 <> 0 THEN concat('k', CAST(l_partkey % 100 AS VARCHAR(20)), l_returnflag, CAST(l_orderkey AS VARCHAR(20))) END
    FROM {lineitem}
"""
RANGES = 16


def _ranged_sql(kind: str, key: str) -> str:
    return f"""
    SELECT '{kind}' AS kind, CAST(range_no AS BIGINT) AS range_no, CAST(sum(n) AS BIGINT) AS rows FROM (
        SELECT CASE WHEN k IS NULL THEN 0 ELSE ((sum(n) FILTER (k IS NOT NULL) OVER (ORDER BY k NULLS FIRST) - n) * {RANGES})
                    // sum(n) FILTER (k IS NOT NULL) OVER () END AS range_no, n
        FROM (SELECT {key} AS k, count(*) AS n FROM ({UNEVEN_KEYS}) WHERE kind = '{kind}' GROUP BY 1)
    ) GROUP BY range_no
    """


@query("scan_ranges", f"{_ranged_sql('number', 'number_key')} UNION ALL {_ranged_sql('text', 'text_key')}")
def scan_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each condition of a scan by even ranges reads, for an uneven number and for a text, NULL keys among them.

    Every condition that a row meets counts it, so a row in none or in two ranges shows.
    """
    keys = derive(spark, sf_dir, UNEVEN_KEYS)
    found = []
    for kind, column in (("number", "number_key"), ("text", "text_key")):
        own = keys.where(F.col("kind") == kind)
        borders = equi_depth_ranges(own, column, RANGES).orderBy("range_no").collect()
        conditions = range_predicates(column, [literal(row.lower_bound) for row in borders[1:]])
        met = F.array_compact(F.array(*(F.when(F.expr(c), F.lit(i).cast("long")) for i, c in enumerate(conditions))))
        counted = own.select(F.explode(met).alias("range_no")).groupBy("range_no").agg(F.count("*").alias("rows"))
        found.append(counted.select(F.lit(kind).alias("kind"), "range_no", "rows"))
    return found[0].unionByName(found[1])


@query(
    "target_projection",
    """
    SELECT CAST(event_type AS VARCHAR) AS event_type, CAST(event_id AS VARCHAR) AS event_id,
           CAST(user_id AS INTEGER) AS user_id, CAST(round(value, 2) AS DECIMAL(18, 2)) AS value,
           TRY_CAST(event_type AS INTEGER) AS props
    FROM events
    """,
)
def target_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order, types and names of the target; source columns it lacks are dropped, bad values NULL."""
    events = table(spark, sf_dir, "events").withColumn("props", F.col("event_type"))
    target = "event_type STRING, event_id STRING, user_id INT, value DECIMAL(18,2), props INT"
    schema = spark.createDataFrame([], target).schema
    return project_to_schema(events, schema, lenient=True)


@query(
    "retention_split",
    f"""
    SELECT o_orderkey, o_orderdate,
           date_trunc('second', TIMESTAMP '1998-01-01 00:00:00.75') - INTERVAL 365 DAY AS cutoff,
           o_orderdate < date_trunc('second', TIMESTAMP '1998-01-01 00:00:00.75') - INTERVAL 365 DAY AS expired
    FROM orders
    """,
)
def retention_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    cutoff = retention_cutoff(365, RUN_TIME.replace(year=1998, month=1, microsecond=750_000))
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_orderdate", cutoff.alias("cutoff"))
        .withColumn("expired", F.col("o_orderdate").cast("timestamp") < F.col("cutoff"))
    )


LOADED = ("region", "nation", "customer", "supplier", "part", "orders")


@query(
    "load_many",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, 'done' AS status, count(*) AS rows FROM {name}" for name in LOADED
    ),
)
def load_many_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load per table, some at a time; then what each load wrote."""
    folder = new_workspace(spark, "many")

    def load(name: str) -> None:
        overwrite_parquet(staged_rows(table(spark, sf_dir, name), RUN_TIME), f"{folder}/{name}")

    outcomes = outcome_rows(spark, load_many(spark, LOADED, load)).select("table_name", "status")
    written = None
    for name in LOADED:
        loaded = read_parquet(spark, f"{folder}/{name}")
        counted = loaded.groupBy(F.lit(name).alias("table_name")).agg(F.count("*").alias("rows"))
        written = counted if written is None else written.unionByName(counted)
    return outcomes.join(written, "table_name").select("table_name", "status", "rows")
