"""Schema registry texts and the decoding of change events with them."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.keys import hash_key, hash_key_texts
from tidewell.functions.logical_types import (
    DATE,
    DEFAULT_SOURCE_TZ,
    MICRO_TIME,
    MICRO_TIMESTAMP,
    TIMESTAMP,
    ZONED_TIMESTAMP,
    cast_logical,
)
from tidewell.functions.names import KEY_COLUMN, LOAD_TIME_COLUMN
from tidewell.operators.changes import OFFSET, OP, PARTITION

AVRO = "avro"
JSON = "json"

# Gives the registered schemas, with columns schema_id and schema_str, as they are at the time of the call.
Registry = Callable[[SparkSession], DataFrame]

_ROW_RECORDS = """
flatten(transform(
    filter(try_variant_get(doc, '$.fields', 'array<variant>'),
           f -> try_variant_get(f, '$.name', 'string') IN ('before', 'after')),
    f -> filter(coalesce(try_variant_get(f, '$.type', 'array<variant>'), array()),
                t -> try_variant_get(t, '$.fields', 'array<variant>') IS NOT NULL)))
"""

# First member of a union that is not "null"; a type that is no union stands for itself.
_EFFECTIVE_TYPE = """
if(try_variant_get(f, '$.type', 'array<variant>') IS NULL,
   try_variant_get(f, '$.type', 'variant'),
   get(filter(try_variant_get(f, '$.type', 'array<variant>'),
              m -> coalesce(try_variant_get(m, '$', 'string'), '') <> 'null'), 0))
"""

_COLUMNS = f"""
filter(
    transform(
        transform(try_variant_get(get({_ROW_RECORDS}, 0), '$.fields', 'array<variant>'),
                  f -> struct(try_variant_get(f, '$.name', 'string') AS name, {_EFFECTIVE_TYPE} AS type)),
        c -> struct(c.name AS column_name,
                    coalesce(try_variant_get(c.type, '$["connect.name"]', 'string'),
                             try_variant_get(c.type, '$.type', 'string'),
                             try_variant_get(c.type, '$', 'string')) AS logical_type)),
    c -> c.column_name IS NOT NULL AND c.logical_type IS NOT NULL)
"""

_KEY_NAMES = """
transform(try_variant_get(doc, '$.fields', 'array<variant>'), f -> try_variant_get(f, '$.name', 'string'))
"""


def column_types(registry: DataFrame, id_column: str = "schema_id", text_column: str = "schema_str") -> DataFrame:
    """(schema id, position, column_name, logical_type) of the row record in each value schema.

    The row record is the first record type among the union members of ``before``/``after``. A
    column has the logical name of its first non-null type, or its plain type. All steps work on
    one row, so the registry may be of any size.
    """
    return (
        registry.select(id_column, F.try_parse_json(text_column).alias("doc"))
        .select(id_column, F.posexplode(F.expr(_COLUMNS)).alias("position", "column"))
        .select(id_column, "position", "column.column_name", "column.logical_type")
    )


def key_columns(registry: DataFrame, id_column: str = "schema_id", text_column: str = "schema_str") -> DataFrame:
    """(schema id, position, column_name) of each key schema."""
    return registry.select(id_column, F.try_parse_json(text_column).alias("doc")).select(
        id_column, F.posexplode(F.expr(_KEY_NAMES)).alias("position", "column_name")
    )


@dataclass(frozen=True)
class SchemaPair:
    """The value and key schema that a set of records was written with."""

    value_id: int
    value_text: str
    key_id: int | None
    key_text: str
    types: Mapping[str, str]
    keys: Sequence[str]


def schema_pairs(batch: DataFrame, registry: Registry) -> list[SchemaPair]:
    """The pairs of schema ids in a batch with their texts; there are as many as schema versions."""
    pairs = batch.select("value_schema_id", "key_schema_id").distinct().collect()
    return resolve_pairs([tuple(pair) for pair in pairs], registry, batch.sparkSession, {})


def resolve_pairs(
    pairs: Iterable[tuple[int | None, int | None]], registry: Registry, spark: SparkSession, known: dict[int, Row]
) -> list[SchemaPair]:
    """Schemas of (value id, key id) pairs; tombstones, which have no value id, are left out.

    What is registered under an id never changes, so ``known`` keeps it from one batch to the next,
    and the registry is read only for ids that are new.
    """
    wanted = sorted((p for p in pairs if p[0] is not None), key=lambda p: (p[0], -1 if p[1] is None else p[1]))
    ids = {i for pair in wanted for i in pair if i is not None}
    if ids - known.keys():
        rows = (
            _registered(registry(spark), ids - known.keys())
            .withColumn("doc", F.try_parse_json("schema_str"))
            .select("schema_id", "schema_str", F.expr(_COLUMNS).alias("columns"), F.expr(_KEY_NAMES).alias("key_names"))
        )
        known.update({row.schema_id: row for row in rows.collect()})
    _require(known, ids)
    return [
        SchemaPair(
            value_id,
            known[value_id].schema_str,
            key_id,
            known[key_id].schema_str if key_id is not None else "",
            {c.column_name: c.logical_type for c in known[value_id].columns or ()},
            (known[key_id].key_names or []) if key_id is not None else [],
        )
        for value_id, key_id in wanted
    ]


def _registered(registry: DataFrame, ids: set[int]) -> DataFrame:
    return registry.filter(F.col("schema_id").isin(sorted(ids)))


def _require(known: Mapping[int, object], ids: set[int]) -> None:
    missing = sorted(i for i in ids if i not in known)
    if missing:
        raise LookupError(f"no schema is registered under id {missing}")


def schema_texts(ids: Iterable[int], registry: Registry, spark: SparkSession) -> dict[int, str]:
    """Texts registered under some ids."""
    wanted = set(ids)
    texts = {r.schema_id: r.schema_str for r in _registered(registry(spark), wanted).collect()}
    _require(texts, wanted)
    return dict(sorted(texts.items()))


def decode_payload(payload: Column, schema_text: str, payload_format: str = AVRO) -> Column:
    """Payload bytes as a struct; a payload that does not fit its schema fails the job."""
    if payload_format == AVRO:
        from pyspark.sql.avro.functions import from_avro

        return from_avro(payload, schema_text, {"mode": "FAILFAST"})
    return F.from_json(payload.cast("string"), reader_schema(schema_text), {"mode": "FAILFAST"})


def decode_all_changes(
    records: DataFrame,
    pairs: Sequence[SchemaPair],
    target: T.StructType,
    payload_format: str = AVRO,
    source_tz: str = DEFAULT_SOURCE_TZ,
) -> DataFrame:
    """Records of all schema versions as rows of the target with their operation, offset and partition, in one pass.

    The target says what is read: each of its fields is either made by the job or taken alone out of the row image,
    so columns that it lacks never come into being, and those that the job makes win over a source column of that name.
    A field that a version lacks is NULL there. The newest change of a key wins whichever version wrote it.
    """
    require_keys(pairs)
    decode = _decode_avro if payload_format == AVRO else _decode_json
    return decode(records, pairs, target, source_tz)


def require_keys(pairs: Iterable[SchemaPair]) -> None:
    for pair in pairs:
        if not pair.keys:
            raise ValueError(f"records with value schema {pair.value_id} have no key, so no row can be told from another")


def _change_columns(
    target: T.StructType, field: Callable[[T.StructField], Column], key: Column, ts_ms: Column, op: Column
) -> list[Column]:
    made = {KEY_COLUMN: key, LOAD_TIME_COLUMN: F.timestamp_millis(ts_ms)}
    columns = [(made[f.name] if f.name in made else field(f)).cast(f.dataType).alias(f.name) for f in target]
    return [*columns, op.alias(OP), OFFSET, PARTITION]


# Wire types whose JSON values are read as one Spark type; a value of any other type is read as its target's.
_WIRE_TYPES = {
    "boolean": "boolean",
    "int": "bigint",
    "long": "bigint",
    "float": "float",
    "double": "double",
    "string": "string",
    DATE: "bigint",
    MICRO_TIME: "bigint",
    TIMESTAMP: "bigint",
    MICRO_TIMESTAMP: "bigint",
    ZONED_TIMESTAMP: "string",
}


def schema_rows(spark: SparkSession, pairs: Sequence[SchemaPair]) -> DataFrame:
    """What decoding needs to know of each pair: its ids, the types of its columns and the names of its key."""
    return spark.createDataFrame(
        [(p.value_id, p.key_id, dict(p.types), list(p.keys)) for p in pairs],
        "__of_value INT, __of_key INT, __types MAP<STRING, STRING>, __key_names ARRAY<STRING>",
    )


def _decode_json(records: DataFrame, pairs: Sequence[SchemaPair], target: T.StructType, source_tz: str) -> DataFrame:
    """Payloads are parsed once, and a record finds the types of its fields in the row of its schemas.

    The plan has one scan and one join with a row for each version, whatever their number; of a field's types only
    those are told apart that occur. A payload that is no JSON, or a value that does not fit its type, fails the job.
    """
    rows = F.broadcast(schema_rows(records.sparkSession, pairs))
    written_with = (F.col("value_schema_id") == F.col("__of_value")) & F.col("key_schema_id").eqNullSafe(F.col("__of_key"))
    events = records.join(rows, written_with).select(
        F.parse_json(F.col("value").cast("string")).alias("__event"),
        F.parse_json(F.col("key").cast("string")).alias("__row_id"),
        "__types",
        "__key_names",
        F.col("offset").alias(OFFSET),
        F.col("partition").alias(PARTITION),
    )
    images = "map<string,variant>"
    opened = events.select(
        "*", F.variant_get("__event", "$.after", images).alias("__after"), F.variant_get("__row_id", "$", images).alias("__id")
    )

    def read(value: Column, wire: str | None, data_type: str) -> Column:
        if wire in ("bytes", "fixed"):
            return F.unbase64(F.variant_get(value, "$", "string"))
        return cast_logical(F.variant_get(value, "$", _WIRE_TYPES.get(wire, data_type)), wire, source_tz)

    def by_type(wire_type: Column, wires: set[str | None], result: Callable[[str | None], Column]) -> Column:
        """The result for the type a record's schema gives; a type that is the only one needs no choice."""
        if len(wires) < 2:
            return result(next(iter(wires), None))
        first, *others = sorted(w for w in wires if w is not None)
        chosen = F.when(wire_type == first, result(first))
        for wire in others:
            chosen = chosen.when(wire_type == wire, result(wire))
        return chosen.otherwise(result(None)) if None in wires else chosen

    def field(f: T.StructField) -> Column:
        value = F.element_at("__after", F.lit(f.name))
        wires = {p.types.get(f.name) for p in pairs}

        def result(wire: str | None) -> Column:
            known = F.lit(None) if wire is None else read(value, wire, f.dataType.simpleString())
            return known.cast(f.dataType)

        return by_type(F.element_at("__types", F.lit(f.name)), wires, result)

    def key_text(name: Column) -> Column:
        value = F.element_at("__id", name)
        wires = {p.types.get(key) for p in pairs for key in p.keys}

        def text(wire: str | None) -> Column:
            return F.trim(read(value, wire, "string")) if wire == "string" else read(value, wire, "string").cast("string")

        return by_type(F.element_at("__types", name), wires, text)

    key = hash_key_texts(F.transform("__key_names", key_text))
    ts_ms, op = F.variant_get("__event", "$.ts_ms", "bigint"), F.variant_get("__event", "$.op", "string")
    return opened.select(*_change_columns(target, field, key, ts_ms, op))


def _decode_avro(records: DataFrame, pairs: Sequence[SchemaPair], target: T.StructType, source_tz: str) -> DataFrame:
    """An Avro reader is bound to one schema, so each version has its own, which sees that version's payloads only."""
    own = [_written_with(pair) for pair in pairs]
    known = records.filter(reduce(Column.__or__, own, F.lit(False)))
    readers = [
        reader
        for i, (pair, mine) in enumerate(zip(pairs, own))
        for reader in (
            decode_payload(F.when(mine, F.col("key")), pair.key_text).alias(f"__row_id_{i}"),
            decode_payload(F.when(mine, F.col("value")), pair.value_text).alias(f"__event_{i}"),
        )
    ]
    numbered = F.coalesce(*(F.when(mine, F.lit(i)) for i, mine in enumerate(own)), F.lit(-1))
    events = known.select(
        *readers, numbered.alias("__version"), F.col("offset").alias(OFFSET), F.col("partition").alias(PARTITION)
    )

    def by_version(part: Callable[[int, SchemaPair], Column | None]) -> Column:
        chosen = F.when(F.lit(False), F.lit(None))
        for i, pair in enumerate(pairs):
            value = part(i, pair)
            if value is not None:
                chosen = chosen.when(F.col("__version") == i, value)
        return chosen

    def typed(place: str, name: str, pair: SchemaPair) -> Column:
        return cast_logical(F.col(f"{place}.`{name}`"), pair.types.get(name), source_tz)

    def key_part(i: int, pair: SchemaPair, name: str) -> Column:
        column = f"__row_id_{i}"
        return F.trim(F.col(f"{column}.`{name}`")) if pair.types.get(name) == "string" else typed(column, name, pair)

    def field(f: T.StructField) -> Column:
        return by_version(
            lambda i, pair: typed(f"__event_{i}.after", f.name, pair).cast(f.dataType) if f.name in pair.types else None
        )

    key = by_version(lambda i, pair: hash_key([key_part(i, pair, name) for name in pair.keys]))
    ts_ms = by_version(lambda i, _: F.col(f"__event_{i}.ts_ms"))
    op = by_version(lambda i, _: F.col(f"__event_{i}.op"))
    return events.select(*_change_columns(target, field, key, ts_ms, op))


def _written_with(pair: SchemaPair) -> Column:
    return (F.col("value_schema_id") == pair.value_id) & F.col("key_schema_id").eqNullSafe(F.lit(pair.key_id))


# Primitive names of schema texts -> Spark types.
_PRIMITIVES = {
    "null": T.NullType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}


def reader_schema(schema_text: str) -> T.StructType:
    """Spark schema of a registered record, for payloads that are JSON texts of it."""
    named: dict[str, T.DataType] = {}

    def convert(node) -> T.DataType:
        if isinstance(node, list):
            return convert(next((member for member in node if member != "null"), "null"))
        if isinstance(node, str):
            return named[node] if node in named else _PRIMITIVES[node]
        match node["type"]:
            case "array":
                return T.ArrayType(convert(node["items"]))
            case "map":
                return T.MapType(T.StringType(), convert(node["values"]))
            case "enum":
                made = T.StringType()
            case "fixed":
                made = T.BinaryType()
            case "record":
                made = T.StructType([T.StructField(f["name"], convert(f["type"])) for f in node["fields"]])
            case plain:
                return convert(plain)
        named[node["name"]] = made
        return made

    return convert(json.loads(schema_text))
