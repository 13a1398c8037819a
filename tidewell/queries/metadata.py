"""Source metadata of tables, and their differences from bronze tables.

The metadata rows are derived from ``lineitem``: each supplier and return flag is a source table
with up to 16 columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.names import MYSQL
from tidewell.operators import drift, introspect
from tidewell.queries.registry import derive, query
from tidewell.session import staged

COLUMN_BASE = """
    SELECT DISTINCT 'S' || l_returnflag AS table_schema, 'Tb_' || l_suppkey AS table_name,
           'Col_' || (l_partkey % 16) AS column_name, CAST(l_partkey % 16 + 1 AS INT) AS ordinal_position,
           l_suppkey AS sid,
           l_suppkey * 10 + CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS object_id
    FROM {lineitem}
"""

COLUMNS = f"""
    SELECT table_schema, table_name, column_name, ordinal_position, sid, object_id,
           CASE (sid + ordinal_position) % 6 WHEN 0 THEN 'int' WHEN 1 THEN 'varchar' WHEN 2 THEN 'decimal'
                WHEN 3 THEN 'datetime' WHEN 4 THEN 'bigint' ELSE 'tinyint' END AS data_type,
           CASE (sid + ordinal_position) % 6 WHEN 0 THEN 'int(11)' WHEN 1 THEN 'varchar(40)'
                WHEN 2 THEN 'decimal(12,' || (ordinal_position % 4) || ')'
                WHEN 3 THEN 'datetime(6)' WHEN 4 THEN 'bigint(20) unsigned' ELSE 'tinyint(1)' END AS column_type,
           CASE WHEN sid % 3 = 0 AND ordinal_position = 1 + sid % 16 THEN 'auto_increment' ELSE '' END AS extra,
           CASE WHEN sid % 3 = 0 AND ordinal_position = 1 + sid % 16 THEN 1 ELSE 0 END AS is_identity,
           CASE WHEN ordinal_position % 2 = 0 THEN 'YES' ELSE 'NO' END AS is_nullable,
           CASE WHEN ordinal_position % 4 = 0 THEN NULL WHEN ordinal_position % 4 = 1 THEN ''
                ELSE 'comment of ' || column_name END AS column_comment
    FROM ({COLUMN_BASE}) AS base
"""

KEY_USAGE_MYSQL = f"""
    SELECT table_schema, table_name, column_name, ordinal_position,
           CASE WHEN ordinal_position <= 1 + sid % 3 THEN 'PRIMARY' ELSE 'uk_' || table_name END AS constraint_name
    FROM ({COLUMN_BASE}) AS base
"""

KEY_USAGE_SQLSERVER = f"""
    SELECT table_schema, table_name, column_name, ordinal_position,
           CASE WHEN ordinal_position <= 1 + sid % 3 THEN 'PK_' ELSE 'UQ_' END || table_name AS constraint_name
    FROM ({COLUMN_BASE}) AS base
"""

CONSTRAINTS = f"""
    SELECT DISTINCT table_schema, table_name, constraint_name,
           CASE WHEN constraint_name LIKE 'PK%' THEN 'PRIMARY KEY' ELSE 'UNIQUE' END AS constraint_type
    FROM ({KEY_USAGE_SQLSERVER}) AS usage_rows
"""


@query(
    "primary_keys_mysql",
    f"""
    SELECT table_schema, table_name, ordinal_position AS position, column_name FROM ({KEY_USAGE_MYSQL}) AS k
    WHERE constraint_name = 'PRIMARY'
    """,
)
def primary_keys_mysql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.primary_keys_mysql(derive(spark, sf_dir, KEY_USAGE_MYSQL))


@query(
    "primary_keys_sqlserver",
    f"""
    SELECT k.table_schema, k.table_name, k.ordinal_position AS position, k.column_name
    FROM ({KEY_USAGE_SQLSERVER}) AS k
    JOIN ({CONSTRAINTS}) AS c USING (table_schema, table_name, constraint_name)
    WHERE c.constraint_type = 'PRIMARY KEY'
    """,
)
def primary_keys_sqlserver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.primary_keys_sqlserver(
        derive(spark, sf_dir, CONSTRAINTS), derive(spark, sf_dir, KEY_USAGE_SQLSERVER)
    )


@query(
    "partition_keys_mysql",
    f"""
    SELECT table_schema, table_name, column_name FROM ({COLUMNS}) AS c
    WHERE data_type IN ('int', 'bigint', 'date', 'datetime', 'timestamp') OR extra = 'auto_increment'
    QUALIFY row_number() OVER (PARTITION BY table_schema, table_name
        ORDER BY CASE WHEN extra = 'auto_increment' THEN 0 ELSE 1 END, ordinal_position) = 1
    """,
)
def partition_keys_mysql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.partition_keys_mysql(derive(spark, sf_dir, COLUMNS))


@query(
    "partition_keys_sqlserver",
    f"""
    SELECT table_schema, table_name, column_name FROM ({COLUMNS}) AS c
    WHERE data_type IN ('date', 'datetime', 'datetime2') OR is_identity = 1
    QUALIFY row_number() OVER (PARTITION BY table_schema, table_name
        ORDER BY is_identity DESC, ordinal_position) = 1
    """,
)
def partition_keys_sqlserver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.partition_keys_sqlserver(derive(spark, sf_dir, COLUMNS))


@query(
    "source_columns",
    f"SELECT table_schema, table_name, ordinal_position AS position, column_name, column_type FROM ({COLUMNS}) AS c",
)
def source_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.column_list(derive(spark, sf_dir, COLUMNS))


TABLES_MYSQL = """
    SELECT c_mktsegment AS table_schema, c_name AS table_name, c_custkey AS table_rows,
           c_custkey * 104729 AS data_length, c_custkey * 7919 AS index_length,
           CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'table of ' || c_name END AS table_comment
    FROM {customer}
"""


@query(
    "table_sizes_mysql",
    f"""
    SELECT table_schema, table_name, table_rows,
           round((data_length + index_length) / 1048576.0, 0) AS table_size FROM ({TABLES_MYSQL}) AS t
    """,
)
def table_sizes_mysql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.sizes_mysql(derive(spark, sf_dir, TABLES_MYSQL))


TABLES_SQLSERVER = "SELECT c_mktsegment AS table_schema, c_name AS table_name, c_custkey AS object_id FROM {customer}"
INDEXES = """
    SELECT DISTINCT o_custkey AS object_id, CASE WHEN o_orderkey % 4 = 3 THEN 9 ELSE o_orderkey % 4 END AS index_id
    FROM {orders}
"""
PARTITIONS = """
    SELECT o_orderkey AS partition_id, o_custkey AS object_id, o_orderkey % 4 AS index_id, o_orderkey * 3 AS rows
    FROM {orders}
"""
UNITS = "SELECT l_orderkey AS container_id, l_linenumber AS total_pages FROM {lineitem}"


@query(
    "table_sizes_sqlserver",
    f"""
    SELECT t.table_schema, t.table_name, max(p.rows) AS table_rows, sum(u.total_pages) * 8.0 / 1024 AS table_size
    FROM ({TABLES_SQLSERVER}) AS t
    JOIN ({INDEXES}) AS i ON t.object_id = i.object_id
    JOIN ({PARTITIONS}) AS p ON i.object_id = p.object_id AND i.index_id = p.index_id
    JOIN ({UNITS}) AS u ON p.partition_id = u.container_id
    GROUP BY t.table_schema, t.table_name
    """,
)
def table_sizes_sqlserver(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = [derive(spark, sf_dir, sql) for sql in (TABLES_SQLSERVER, INDEXES, PARTITIONS, UNITS)]
    return introspect.sizes_sqlserver(*views)


PROPERTIES = f"""
    SELECT object_id AS major_id, ordinal_position AS minor_id,
           CASE WHEN ordinal_position % 3 = 0 THEN 'MS_Description' ELSE 'Other' END AS name,
           'about ' || column_name AS value
    FROM ({COLUMN_BASE}) AS c
    UNION ALL
    SELECT DISTINCT object_id, 0, CASE WHEN sid % 2 = 0 THEN 'MS_Description' ELSE 'Other' END,
           CASE WHEN sid % 4 = 0 THEN '' ELSE 'table ' || table_name END
    FROM ({COLUMN_BASE}) AS d
"""


@query(
    "column_comments_mysql",
    f"""
    SELECT table_schema, table_name, column_name, coalesce(column_comment, '') AS column_comment FROM ({COLUMNS}) AS c
    """,
)
def column_comments_mysql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.column_comments_mysql(derive(spark, sf_dir, COLUMNS))


@query(
    "column_comments_sqlserver",
    f"""
    SELECT table_schema, table_name, column_name,
           CASE WHEN ordinal_position % 3 = 0 THEN 'about ' || column_name ELSE '' END AS column_comment
    FROM ({COLUMNS}) AS c
    """,
)
def column_comments_sqlserver(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = derive(spark, sf_dir, COLUMNS).withColumn("column_id", F.col("ordinal_position"))
    return introspect.column_comments_sqlserver(columns, derive(spark, sf_dir, PROPERTIES))


@query(
    "table_comments_mysql",
    "SELECT c_mktsegment AS table_schema, c_name AS table_name, "
    "CASE WHEN c_custkey % 3 <> 0 THEN 'table of ' || c_name END AS table_comment FROM customer",
)
def table_comments_mysql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.table_comments_mysql(derive(spark, sf_dir, TABLES_MYSQL))


SOURCE_TABLES = f"SELECT DISTINCT table_schema, table_name, object_id FROM ({COLUMN_BASE}) AS c"


@query(
    "table_comments_sqlserver",
    f"""
    SELECT DISTINCT table_schema, table_name, CASE WHEN sid % 4 <> 0 THEN 'table ' || table_name END AS table_comment
    FROM ({COLUMN_BASE}) AS c WHERE sid % 2 = 0
    """,
)
def table_comments_sqlserver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.table_comments_sqlserver(derive(spark, sf_dir, SOURCE_TABLES), derive(spark, sf_dir, PROPERTIES))


@query(
    "nullable_info",
    f"SELECT table_schema, table_name, column_name, ordinal_position % 2 = 0 AS nullable FROM ({COLUMNS}) AS c",
)
def nullable_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return introspect.nullability(derive(spark, sf_dir, COLUMNS))


# Bronze side: some columns are missing, moved, of another type or nullability, or differently
# described, and each table has the columns that loading adds (the key hash not everywhere).
TARGET = f"""
    SELECT lower(table_schema) || '_bronze' AS bronze_schema, lower(table_name) AS bronze_table,
           CASE WHEN sid % 5 = 0 AND ordinal_position IN (2, 3) THEN 5 - ordinal_position
                ELSE ordinal_position END AS position,
           lower(column_name) AS column_name,
           CASE WHEN sid % 7 = 0 AND ordinal_position = 4 THEN 'string'
                ELSE CASE (sid + ordinal_position) % 6 WHEN 0 THEN 'int' WHEN 1 THEN 'string'
                     WHEN 2 THEN 'decimal(12,2)' WHEN 3 THEN 'timestamp' WHEN 4 THEN 'bigint' ELSE 'boolean' END
           END AS data_type,
           ordinal_position % 2 = 0 OR ordinal_position = 9 AS nullable,
           CASE WHEN ordinal_position % 8 = 2 THEN 'old' WHEN ordinal_position % 8 = 6 THEN NULL
                ELSE 'comment of ' || column_name END AS column_comment
    FROM ({COLUMN_BASE}) AS c
    WHERE NOT (sid % 3 = 1 AND ordinal_position = 7)
    UNION ALL
    SELECT DISTINCT lower(table_schema) || '_bronze', lower(table_name), 100, 'last_applied_date', 'timestamp', TRUE,
           NULL
    FROM ({COLUMN_BASE}) AS c
    UNION ALL
    SELECT DISTINCT lower(table_schema) || '_bronze', lower(table_name), 101, 'id_iceberg', 'string', TRUE, NULL
    FROM ({COLUMN_BASE}) AS c WHERE sid % 4 <> 0
"""

SOURCE = f"""
    SELECT table_schema, table_name, ordinal_position AS position, column_name, column_type,
           ordinal_position % 2 = 0 AS nullable, column_comment
    FROM ({COLUMNS}) AS columns_of_source
"""

# Keys of some schemas belong to tables that bronze does not have, so that their own tables have none.
KEYS = f"""
    SELECT table_schema, CASE WHEN substr(table_schema, 2, 1) = 'A' THEN table_name || '_old' ELSE table_name END AS table_name,
           column_name
    FROM ({KEY_USAGE_MYSQL}) AS k WHERE constraint_name = 'PRIMARY'
"""

SOURCE_COMMENTS = f"""
    SELECT table_schema, table_name,
           CASE WHEN object_id % 4 = 0 THEN '' ELSE 'about ' || table_name END AS table_comment
    FROM ({SOURCE_TABLES}) AS t
"""
TARGET_COMMENTS = f"""
    SELECT lower(table_schema) || '_bronze' AS bronze_schema, lower(table_name) AS bronze_table,
           CASE WHEN object_id % 3 = 0 THEN 'about ' || table_name WHEN object_id % 3 = 1 THEN NULL
                ELSE 'other' END AS table_comment
    FROM ({SOURCE_TABLES}) AS t
"""

S_SQL = f"""
    SELECT lower(table_schema) || '_bronze' AS bronze_schema, lower(table_name) AS bronze_table,
           lower(column_name) AS name,
           position, column_name, column_type, nullable, column_comment FROM ({SOURCE}) AS s
"""
T_SQL = f"""
    SELECT *, lower(column_name) AS name FROM ({TARGET}) AS t
    WHERE column_name NOT IN ('last_applied_date', 'id_iceberg')
"""
BOTH_SQL = f"""
    SELECT s.bronze_schema, s.bronze_table, s.column_name, s.position AS s_position, t.position AS t_position,
           s.nullable AS s_nullable, t.nullable AS t_nullable, t.data_type,
           s.column_comment, t.column_comment AS t_comment,
           CASE WHEN column_type LIKE 'int%' THEN 'int' WHEN column_type LIKE 'varchar%' THEN 'string'
                WHEN column_type LIKE 'decimal%' THEN column_type WHEN column_type LIKE 'datetime%' THEN 'timestamp'
                WHEN column_type LIKE 'bigint%' THEN 'bigint' ELSE 'boolean' END AS expected
    FROM ({S_SQL}) AS s JOIN ({T_SQL}) AS t USING (bronze_schema, bronze_table, name)
"""

COUNT_SQL = f"""
    SELECT bronze_schema, bronze_table, 'column_count' AS "check", CAST(NULL AS VARCHAR) AS column_name,
           CAST(s.n AS VARCHAR) AS source_value, CAST(t.n AS VARCHAR) AS target_value
    FROM (SELECT bronze_schema, bronze_table, count(*) AS n FROM ({S_SQL}) AS x GROUP BY ALL) AS s
    JOIN (SELECT bronze_schema, bronze_table, count(*) AS n FROM ({T_SQL}) AS y GROUP BY ALL) AS t
        USING (bronze_schema, bronze_table)
    WHERE s.n <> t.n
"""
UNREFLECTED_SQL = f"""
    SELECT bronze_schema, bronze_table, 'unreflected' AS "check", column_name, column_type AS source_value,
           CAST(NULL AS VARCHAR) AS target_value
    FROM ({S_SQL}) AS s ANTI JOIN ({TARGET}) AS t
        ON s.bronze_schema = t.bronze_schema AND s.bronze_table = t.bronze_table AND s.name = t.column_name
"""
ORDER_SQL = f"""
    SELECT bronze_schema, bronze_table, 'column_order' AS "check", CAST(NULL AS VARCHAR) AS column_name,
           CAST(NULL AS VARCHAR) AS source_value, CAST(NULL AS VARCHAR) AS target_value
    FROM (SELECT bronze_schema, bronze_table, list(column_name ORDER BY s_position) AS a,
                 list(column_name ORDER BY t_position) AS b FROM ({BOTH_SQL}) AS m GROUP BY ALL)
    WHERE a <> b
"""
# Longest increasing runs: their lengths column by column, then one of them from its end.
MOVES_SQL = f"""
    WITH RECURSIVE forward AS (
        SELECT bronze_schema, bronze_table, list(column_name ORDER BY s_position) AS names,
               list(t_position ORDER BY s_position) AS ts, 0 AS i, CAST([] AS BIGINT[]) AS lengths
        FROM ({BOTH_SQL}) AS m GROUP BY ALL
        UNION ALL
        SELECT bronze_schema, bronze_table, names, ts, i + 1, list_append(lengths, 1 + coalesce(list_max(
                   [lengths[j] FOR j IN range(1, i + 1) IF ts[j] < ts[i + 1]]), 0))
        FROM forward WHERE i < len(ts)
    ), backward AS (
        SELECT bronze_schema, bronze_table, names, ts, lengths, i, list_max(lengths) + 1 AS k, CAST(2147483647 AS BIGINT) AS t,
               CAST([] AS BIGINT[]) AS kept
        FROM forward WHERE i = len(ts)
        UNION ALL
        SELECT bronze_schema, bronze_table, names, ts, lengths, i - 1, CASE WHEN hit THEN k - 1 ELSE k END,
               CASE WHEN hit THEN ts[i] ELSE t END, CASE WHEN hit THEN list_append(kept, i) ELSE kept END
        FROM (SELECT *, lengths[i] = k - 1 AND ts[i] < t AS hit FROM backward WHERE i > 0)
    ), moved AS (
        SELECT *, unnest([j FOR j IN range(1, len(ts) + 1) IF NOT list_contains(kept, j)]) AS j FROM backward WHERE i = 0
    )
    SELECT bronze_schema, bronze_table, 'column_move' AS "check", names[j] AS column_name, CAST(j AS VARCHAR) AS source_value,
           CAST(1 + len([x FOR x IN ts IF x < ts[j]]) AS VARCHAR) AS target_value
    FROM moved
"""
TYPE_SQL = f"""
    SELECT bronze_schema, bronze_table,
           CASE WHEN split_part(expected, '(', 1) = split_part(data_type, '(', 1) THEN 'type_parameters'
                ELSE 'type_class' END AS "check",
           column_name, expected AS source_value, data_type AS target_value
    FROM ({BOTH_SQL}) AS m WHERE expected <> data_type
"""
NULLABLE_SQL = f"""
    SELECT bronze_schema, bronze_table, 'nullable' AS "check", column_name,
           CAST(s_nullable AS VARCHAR) AS source_value, CAST(t_nullable AS VARCHAR) AS target_value
    FROM ({BOTH_SQL}) AS m WHERE s_nullable <> t_nullable
"""
COMMENT_SQL = f"""
    SELECT bronze_schema, bronze_table, 'column_comment' AS "check", column_name, column_comment AS source_value,
           coalesce(t_comment, '') AS target_value
    FROM ({BOTH_SQL}) AS m WHERE column_comment <> '' AND column_comment <> coalesce(t_comment, '')
"""
PK_CHECK_SQL = f"""
    SELECT h.bronze_schema, h.bronze_table, k.bronze_table IS NOT NULL AS has_source_key, h.has_key_hash,
           (k.bronze_table IS NOT NULL) = h.has_key_hash AS passed
    FROM (SELECT bronze_schema, bronze_table, bool_or(column_name = 'id_iceberg') AS has_key_hash
          FROM ({TARGET}) AS t GROUP BY ALL) AS h
    LEFT JOIN (SELECT DISTINCT lower(table_schema) || '_bronze' AS bronze_schema, lower(table_name) AS bronze_table
               FROM ({KEYS}) AS u) AS k USING (bronze_schema, bronze_table)
"""
PK_SQL = f"""
    SELECT bronze_schema, bronze_table, 'primary_key' AS "check", CAST(NULL AS VARCHAR) AS column_name,
           CAST(has_source_key AS VARCHAR) AS source_value, CAST(has_key_hash AS VARCHAR) AS target_value
    FROM ({PK_CHECK_SQL}) AS p WHERE NOT passed
"""
TABLE_COMMENT_SQL = f"""
    SELECT t.bronze_schema, t.bronze_table, 'table_comment' AS "check", CAST(NULL AS VARCHAR) AS column_name,
           s.table_comment AS source_value, coalesce(t.table_comment, '') AS target_value
    FROM ({SOURCE_COMMENTS}) AS s JOIN ({TARGET_COMMENTS}) AS t
        ON lower(s.table_schema) || '_bronze' = t.bronze_schema AND lower(s.table_name) = t.bronze_table
    WHERE s.table_comment <> '' AND s.table_comment <> coalesce(t.table_comment, '')
"""


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables and columns that all inputs of a drift check are made from, so read once."""
    return staged(derive(spark, sf_dir, COLUMN_BASE), "columns")


def _from(base: DataFrame, sql: str) -> DataFrame:
    return base.sparkSession.sql(sql.replace(f"({COLUMN_BASE})", "{base}"), base=base)


def _matched(base: DataFrame) -> DataFrame:
    return drift.matched_columns(drift.keyed_by_bronze(_from(base, SOURCE)), _from(base, TARGET))


@query("column_count_drift", COUNT_SQL)
def column_count_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.column_counts(_matched(_base(spark, sf_dir)))


@query("column_drift", UNREFLECTED_SQL)
def column_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.unreflected_columns(_matched(_base(spark, sf_dir)))


@query("order_drift", ORDER_SQL)
def order_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.column_order(_matched(_base(spark, sf_dir)))


@query("order_moves", MOVES_SQL)
def order_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.column_moves(_matched(_base(spark, sf_dir)))


@query("type_drift", TYPE_SQL)
def type_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.type_differences(_matched(_base(spark, sf_dir)), MYSQL)


@query("nullable_drift", NULLABLE_SQL)
def nullable_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.nullable_differences(_matched(_base(spark, sf_dir)))


@query("comment_diff", COMMENT_SQL)
def comment_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.column_comment_differences(_matched(_base(spark, sf_dir)))


@query("pk_check", PK_CHECK_SQL)
def pk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(spark, sf_dir)
    return drift.primary_key_check(drift.keyed_by_bronze(_from(base, KEYS)), _matched(base))


@query("table_comment_diff", TABLE_COMMENT_SQL)
def table_comment_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(spark, sf_dir)
    source = drift.keyed_by_bronze(_from(base, SOURCE_COMMENTS))
    return drift.table_comment_differences(source, _from(base, TARGET_COMMENTS))


@query(
    "schema_report",
    " UNION ALL ".join(
        (COUNT_SQL, UNREFLECTED_SQL, ORDER_SQL, TYPE_SQL, NULLABLE_SQL, COMMENT_SQL, PK_SQL, TABLE_COMMENT_SQL)
    ),
)
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(spark, sf_dir)
    return drift.schema_report(
        drift.keyed_by_bronze(_from(base, SOURCE)),
        _from(base, TARGET),
        drift.keyed_by_bronze(_from(base, KEYS)),
        drift.keyed_by_bronze(_from(base, SOURCE_COMMENTS)),
        _from(base, TARGET_COMMENTS),
        MYSQL,
    )
