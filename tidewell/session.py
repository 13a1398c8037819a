"""Session options and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BATCH_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.bucketing.maxBuckets": "1000000",
}

STREAM_OPTIONS = {
    **BATCH_OPTIONS,
    "spark.sql.caseSensitive": "true",
    "spark.scheduler.mode": "FAIR",
    "spark.rdd.compress": "true",
    "spark.shuffle.service.removeShuffle": "true",
}


def iceberg_catalog_options(
    catalog: str, warehouse: str, catalog_impl: str, io_impl: str | None = None, extra: dict[str, str] | None = None
) -> dict[str, str]:
    """Session options that register an Iceberg catalog and make it the default one."""
    prefix = f"spark.sql.catalog.{catalog}"
    options = {
        "spark.sql.defaultCatalog": catalog,
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.catalog-impl": catalog_impl,
        f"{prefix}.warehouse": warehouse,
    }
    if io_impl:
        options[f"{prefix}.io-impl"] = io_impl
    options.update({f"{prefix}.{name}": value for name, value in (extra or {}).items()})
    return options


def build_session(app_name: str, streaming: bool = False, options: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**(STREAM_OPTIONS if streaming else BATCH_OPTIONS), **(options or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Every job runs in UTC; sessions built elsewhere are switched over."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: the checkpoint folder of the session.

    Only a local session without one gets a folder of its own; on a cluster a machine-local folder
    would lose data with the machine, so that is refused.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidewell-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_workspace(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written to the shared folder once and read from there.

    For rows that are expensive and used several times: what they come from is read once, a lost
    executor cannot change them, and Spark knows their exact size when it plans the joins.
    """
    return _written(df, new_workspace(df.sparkSession, label))


@contextmanager
def staged_while(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """As :func:`staged`, for work that ends with the block; the folder goes with it."""
    spark = df.sparkSession
    folder = new_workspace(spark, label)
    try:
        yield _written(df, folder)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _written(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
