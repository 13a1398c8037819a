"""The jobs from the command line: ``python -m tidewell JOB --config FILE ...`` or by spark-submit.

The configuration is a JSON file with the sections ``source`` (database), ``store`` (bronze tables),
``kafka``, ``registry`` (a table or Parquet folder with schema_id and schema_str), ``stop_base``, ``progress`` (a folder
for the figures of all batches, left out if they are only to be logged),
``catalog`` (``catalog_impl``, ``io_impl`` and ``extra`` of the store's Iceberg catalog, which is registered
under the store's catalog name) and ``session`` (Spark options, which win over those); each job reads those it needs.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidewell.operators.decoding import Registry
from tidewell.operators.maintenance import MIN_FILE_BYTES, RETAIN_LAST, TARGET_FILE_BYTES
from tidewell.plans.snapshot import load_many, load_staged, load_table, stage_table
from tidewell.plans.upkeep import maintain_ledger, maintain_tables
from tidewell.plans.validate import validate_tables
from tidewell.session import build_session, iceberg_catalog_options
from tidewell.sinks.ledger import ensure_ledger
from tidewell.sinks.tables import BronzeStore
from tidewell.sources.jdbc import JdbcSource
from tidewell.sources.kafka import KafkaSource
from tidewell.sources.metadata import SourceMetadata
from tidewell.streaming.archive import archive_checkpoint, start_archive
from tidewell.streaming.cdc import CdcJob, run_topic, topic_checkpoint
from tidewell.streaming.listener import ProgressListener, ProgressSink
from tidewell.streaming.runner import raise_failures, run_topics
from tidewell.streaming.stop import clear_stop, stop_path, stop_requested

STREAM_JOBS = ("cdc", "archive")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidewell")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        one = jobs.add_parser(name, help=text)
        one.add_argument("--config", required=True)
        return one

    cdc = job("cdc", "change topics into bronze tables")
    cdc.add_argument("--dag-id", required=True)
    cdc.add_argument("--topics", required=True, type=_names)
    cdc.add_argument("--concurrency", type=int, default=3)
    archive = job("archive", "topics into a Parquet archive")
    archive.add_argument("--dag-id", required=True)
    archive.add_argument("--topics", required=True, type=_names)
    archive.add_argument("--output-path", required=True)
    for name, text in (("load", "database tables into bronze tables"), ("stage", "database tables into Parquet")):
        load = job(name, text)
        load.add_argument("--table", required=True, type=_names)
        load.add_argument("--num-partition", type=int, default=1)
        load.add_argument("--concurrency", type=int, default=3)
    staged = job("load-staged", "Parquet into bronze tables")
    staged.add_argument("--table", required=True, type=_names)
    staged.add_argument("--concurrency", type=int, default=3)
    validate = job("validate", "compare schemas and carry comments over")
    validate.add_argument("--table", required=True, type=_names)
    maintain = job("maintain", "compact, expire and clean tables")
    maintain.add_argument("--schemas", required=True, type=_names)
    maintain.add_argument("--retention-days", required=True, type=int)
    maintain.add_argument("--retain-last", type=int, default=RETAIN_LAST)
    maintain.add_argument("--target-file-size", type=int, default=TARGET_FILE_BYTES)
    maintain.add_argument("--min-file-size", type=int, default=MIN_FILE_BYTES)
    ledger = job("maintain-ledger", "retention of the processing ledger")
    ledger.add_argument("--retention-days", required=True, type=int)
    return top


def run(spark: SparkSession, args: argparse.Namespace, config: dict) -> None:
    store = BronzeStore(**config["store"])
    if args.job == "cdc":
        _run_cdc(spark, args, config, store)
    elif args.job == "archive":
        _run_archive(spark, args, config, store)
    elif args.job == "maintain":
        maintain_tables(
            spark, store, args.schemas, args.retention_days, args.retain_last, args.target_file_size, args.min_file_size
        ).show(truncate=False)
    elif args.job == "maintain-ledger":
        maintain_ledger(spark, store, args.retention_days)
    else:
        _run_load(spark, args, config, store, JdbcSource(**config["source"]))


def _run_load(
    spark: SparkSession, args: argparse.Namespace, config: dict, store: BronzeStore, source: JdbcSource
) -> None:
    if args.job == "validate":
        validate_tables(spark, source, store, args.table).show(truncate=False)
        return

    def load(table: str) -> None:
        if args.job == "load":
            load_table(spark, source, store, table, args.num_partition)
        elif args.job == "stage":
            stage_table(spark, source, config["parquet_warehouse"], table, args.num_partition)
        else:
            keys = SourceMetadata(spark, source, [table]).primary_key_of(table)
            load_staged(spark, config["parquet_warehouse"], store, table, keys)

    raise_failures(load_many(spark, args.table, load, args.concurrency))


def _listener(spark: SparkSession, config: dict, stop: str) -> ProgressListener:
    sink = ProgressSink(spark, config["progress"]) if "progress" in config else None
    return ProgressListener(spark, stop, sink)


def _run_cdc(spark: SparkSession, args: argparse.Namespace, config: dict, store: BronzeStore) -> None:
    kafka = KafkaSource(**config["kafka"])
    stop = stop_path(config["stop_base"], args.dag_id)
    spark.streams.addListener(_listener(spark, config, stop))
    ensure_ledger(spark, store)
    schemas = _registry(config["registry"])

    def work(topic: str) -> None:
        job = CdcJob(topic, args.dag_id, store, schemas)
        run_topic(spark, job, kafka.stream(spark, [topic]), topic_checkpoint(store.warehouse, topic))

    run_topics(spark, args.topics, work, args.concurrency, stop)


def _run_archive(spark: SparkSession, args: argparse.Namespace, config: dict, store: BronzeStore) -> None:
    stop = stop_path(config["stop_base"], args.dag_id)
    spark.streams.addListener(_listener(spark, config, stop))
    if stop_requested(spark, stop):
        return
    start_archive(
        spark,
        KafkaSource(**config["kafka"]).stream(spark, args.topics),
        args.output_path,
        archive_checkpoint(store.warehouse),
        _registry(config["registry"]),
        args.dag_id,
    ).awaitTermination()
    clear_stop(spark, stop)


def _registry(place: str) -> Registry:
    def read(spark: SparkSession) -> DataFrame:
        if "/" in place:
            return spark.read.parquet(place)
        spark.catalog.refreshTable(place)
        return spark.table(place)

    return read


def session_options(config: dict) -> dict[str, str]:
    """Spark options of the configuration, with the store's catalog where its section is there."""
    options = {}
    if "catalog" in config:
        store = config["store"]
        if not store.get("catalog"):
            raise ValueError("the section catalog needs a name for it: store.catalog")
        options = iceberg_catalog_options(store["catalog"], store["warehouse"], **config["catalog"])
    return {**options, **config.get("session", {})}


def _names(text: str) -> list[str]:
    return [name.strip() for name in text.split(",") if name.strip()]


def main(argv: Sequence[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    args = parser().parse_args(argv)
    with open(args.config) as file:
        config = json.load(file)
    spark = build_session(f"tidewell-{args.job}", args.job in STREAM_JOBS, session_options(config))
    try:
        run(spark, args, config)
    except Exception:
        logging.getLogger(__name__).exception("%s failed", args.job)
        return 1
    return 0


if __name__ == "__main__":
    code = main()
    if session := SparkSession.getActiveSession():
        session.stop()
    sys.exit(code)
