"""Catalog tables."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def table_or_none(spark: SparkSession, name: str) -> DataFrame | None:
    """A catalog table, or None with a warning where there is none."""
    if not spark.catalog.tableExists(name):
        log.warning("there is no table %s", name)
        return None
    return spark.table(name)


def list_tables(spark: SparkSession, schemas: Sequence[str], catalog: str | None = None) -> list[str]:
    """Full names of the tables of some schemas. A schema that cannot be listed is skipped with a warning."""
    names = []
    for schema in schemas:
        full = f"{catalog}.{schema}" if catalog else schema
        try:
            # Temporary views are listed along with every schema.
            names += [f"{full}.{t.name}" for t in spark.catalog.listTables(full) if not t.isTemporary]
        except PySparkException as error:
            log.warning("schema %s cannot be listed: %s", full, error)
    return names
