"""Stop file: a job ends early while the file exists."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


def stop_path(base: str, dag_id: str) -> str:
    return f"{base.rstrip('/')}/spark/signal/{dag_id}"


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def stop_requested(spark: SparkSession, path: str) -> bool:
    """Whether the file exists. A storage error is no reason to stop."""
    try:
        system, target = _file(spark, path)
        return bool(system.exists(target))
    except Py4JError as error:
        log.warning("Cannot look for the stop file %s: %s", path, error)
        return False


def clear_stop(spark: SparkSession, path: str) -> None:
    try:
        system, target = _file(spark, path)
        if system.exists(target):
            system.delete(target, False)
            log.info("Stop file removed: %s", path)
    except Py4JError as error:
        log.warning("Cannot remove the stop file %s: %s", path, error)


def stop_all_if_requested(spark: SparkSession | None, path: str | None) -> bool:
    """End every active query of a session whose stop file is there; whether it was."""
    asked = spark is not None and path is not None and stop_requested(spark, path)
    for query in spark.streams.active if asked else ():
        log.warning("%s ends: %s exists", query.name, path)
        query.stop()
    return asked
