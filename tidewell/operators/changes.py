"""Change application: newest change per key, then upserts and deletes on a target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.names import KEY_COLUMN
from tidewell.session import staged

OP = "__op"
OFFSET = "__offset"
PARTITION = "__partition"
DELETE = "d"


def newest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order.

    Comparing a row number with 1 lets Spark cut every key to one row per map task before the
    shuffle (``WindowGroupLimit``), so a key that holds a large share of the rows costs no more
    than any other.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__row", F.row_number().over(first)).filter("__row = 1").drop("__row")


def with_operation(changes: DataFrame, op: str = OP) -> DataFrame:
    """Changes that say what they do. The others go before anything is deduplicated, so that the result does not
    depend on which changes happened to share a batch with them."""
    return changes.filter(F.col(op).isNotNull())


def newest_changes(changes: DataFrame, key: str = KEY_COLUMN, offset: str = OFFSET) -> DataFrame:
    """Newest change per key; all schema versions must already be in ``changes``.

    A key keeps to one partition of its topic, where offsets tell the order; should one be in several, equal offsets
    are settled by the partition, so that a repeated batch gives the same rows.
    """
    ties = [F.desc(PARTITION)] if PARTITION in changes.columns else []
    return newest_per_key(changes, [key], [F.desc(offset), *ties])


def upserts(changes: DataFrame, op: str = OP) -> DataFrame:
    """Changes that write a row. A NULL operation is neither an upsert nor a delete."""
    return changes.filter(F.col(op) != DELETE)


def deletes(changes: DataFrame, op: str = OP) -> DataFrame:
    return changes.filter(F.col(op) == DELETE)


def apply_newest(target: DataFrame, newest: DataFrame, key: str = KEY_COLUMN, op: str = OP) -> DataFrame:
    """Target rows that no change touches, and the rows that changes write.

    ``newest`` holds one row per key. An anti join and a union stand in for MERGE and DELETE. Only
    the keys of the changes are joined, so Spark broadcasts them by its own threshold on their bytes
    and leaves the target, the large side, where it is; a full outer join would shuffle it each time.
    """
    touched = newest.filter(F.col(op).isNotNull()).select(key)
    return target.join(touched, key, "left_anti").select(target.columns).unionByName(
        upserts(newest, op).select(target.columns)
    )


def apply_changes(
    target: DataFrame, changes: DataFrame, key: str = KEY_COLUMN, op: str = OP, offset: str = OFFSET
) -> DataFrame:
    """The target after a set of changes; those without an operation do nothing.

    The newest changes are staged, because both sides of the union need them and the change log
    should be read and shuffled once.
    """
    return apply_newest(target, staged(newest_changes(with_operation(changes, op), key, offset), "changes"), key, op)


def upsert_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE by several key columns: matched rows take the update, the others are added.

    ``updates`` holds one row per key.
    """
    kept = target.join(updates.select(*keys), list(keys), "left_anti").select(target.columns)
    return kept.unionByName(updates.select(target.columns))


def union_versions(versions: Sequence[DataFrame]) -> DataFrame:
    """Rows decoded with different schema versions as one set, before any deduplication."""
    merged = versions[0]
    for version in versions[1:]:
        merged = merged.unionByName(version, allowMissingColumns=True)
    return merged
