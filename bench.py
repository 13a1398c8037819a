"""Times of the headline queries, as one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the local cores, BENCH_QUERIES (comma separated)
other queries than the headline ones, BENCH_RUNS how often each is run. A query's time is the median
of its runs and covers all its work: what it stages, streams
or writes on the way, and the production of every result row.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from tidewell.queries.all import QUERIES

HEADLINE = (
    "snapshot_load",
    "staged_load",
    "row_key",
    "trim_texts",
    "cdc_dedup",
    "cdc_apply",
    "cdc_apply_multiversion",
    "composite_key_dedup",
    "frame_split",
    "decode_envelope",
    "logical_casts",
    "ledger_latest",
    "ledger_retention",
    "partition_keys_mysql",
    "table_sizes_sqlserver",
    "schema_report",
    "snapshots_to_expire",
    "files_of_expired",
    "orphan_files",
    "compact_roundtrip",
    "alert_transitions",
    "freshness",
    "stream_cdc",
    "stream_archive",
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = session()
    # The first job of a session starts threads and loads classes; it belongs to no query.
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    seconds = {name: round(statistics.median(timed(spark, sf_dir, name) for _ in range(runs)), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
