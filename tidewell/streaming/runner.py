"""Independent jobs side by side in one session."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from tidewell.streaming.stop import clear_stop, stop_requested

log = logging.getLogger(__name__)

DONE = "done"
FAILED = "failed"
SKIPPED = "skipped"


@dataclass(frozen=True)
class Outcome:
    name: str
    status: str
    error: str | None = None


def run_side_by_side(
    spark: SparkSession,
    names: Iterable[str],
    work: Callable[[str], object],
    concurrency: int = 3,
    stop_file: str | None = None,
) -> list[Outcome]:
    """Run ``work`` for each name, some at a time, each in its own FAIR pool and job group.

    A failure does not hold up the others. Once the stop file is there, no further one starts.
    """

    def run(name: str) -> Outcome:
        if stop_file and stop_requested(spark, stop_file):
            log.warning("Stop file found. Skipping %s.", name)
            return Outcome(name, SKIPPED)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        spark.sparkContext.setJobGroup(name, f"Processing {name}")
        try:
            work(name)
            return Outcome(name, DONE)
        except Exception as error:  # noqa: BLE001 - collected, and raised by the caller at the end
            log.exception("Failed to process %s", name)
            return Outcome(name, FAILED, f"{type(error).__name__}: {error}")

    with ThreadPoolExecutor(max_workers=concurrency) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(run), name) for name in names]
        return [one.result() for one in started]


def run_topics(
    spark: SparkSession,
    topics: Iterable[str],
    work: Callable[[str], object],
    concurrency: int = 3,
    stop_file: str | None = None,
) -> list[Outcome]:
    """All topics of a job; an error is raised at the end if any failed, else the stop file is removed."""
    if stop_file and stop_requested(spark, stop_file):
        log.warning("Stop file %s found. Nothing is started.", stop_file)
        return [Outcome(topic, SKIPPED) for topic in topics]
    outcomes = run_side_by_side(spark, topics, work, concurrency, stop_file)
    raise_failures(outcomes)
    if stop_file:
        clear_stop(spark, stop_file)
    return outcomes


def raise_failures(outcomes: Iterable[Outcome]) -> None:
    failed = [o for o in outcomes if o.status == FAILED]
    if failed:
        details = "; ".join(f"{o.name}: {o.error}" for o in failed)
        raise RuntimeError(f"{len(failed)} failed: {details}")
