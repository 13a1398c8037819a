"""Hash key of a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_SEPARATOR = "|"


def hash_key(parts: Sequence[Column]) -> Column:
    """MD5 of the parts joined by ``|``; NULL parts are left out."""
    return hash_key_texts(F.array(*[part.cast("string") for part in parts]))


def hash_key_texts(parts: Column) -> Column:
    """The same for an array of texts, where rows differ in the number of their parts."""
    return F.md5(F.concat_ws(KEY_SEPARATOR, parts))


def row_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """Key of a row by its primary key columns.

    Strings are trimmed here and not only by the snapshot load, so a padded CHAR key
    hashes to the same value whether the row comes from a snapshot or from a change event.
    """
    return hash_key([_normalised(F.col(f"`{name}`"), df.schema[name].dataType) for name in columns])


def _normalised(column: Column, data_type: T.DataType) -> Column:
    return F.trim(column) if isinstance(data_type, T.StringType) else column
