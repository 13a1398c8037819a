"""Change streams into bronze tables."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType

from tidewell.functions.frames import split_frames
from tidewell.functions.logical_types import DEFAULT_SOURCE_TZ
from tidewell.functions.names import parse_topic
from tidewell.operators.changes import newest_changes, with_operation
from tidewell.operators.decoding import AVRO, Registry, SchemaPair, decode_all_changes, require_keys, resolve_pairs
from tidewell.operators.ledger import BatchFigures, Watched, ledger_row
from tidewell.session import staged_while
from tidewell.sinks.ledger import append_ledger
from tidewell.sinks.tables import BronzeStore, data_schema, merge_changes
from tidewell.sources.catalog import table_or_none

log = logging.getLogger(__name__)

APPLIED = "applied"
EMPTY = "empty"


@dataclass(frozen=True)
class CdcJob:
    """What stays the same over all batches of one topic.

    ``registry`` is called when a batch has schema ids that earlier ones did not have.
    """

    topic: str
    dag_id: str
    store: BronzeStore
    registry: Registry
    payload_format: str = AVRO
    source_tz: str = DEFAULT_SOURCE_TZ
    known_schemas: dict[int, Row] = field(default_factory=dict, compare=False, repr=False)
    known_pairs: dict[tuple[int, int | None], SchemaPair] = field(default_factory=dict, compare=False, repr=False)


class MissingTargetError(RuntimeError):
    """The bronze table of a batch is not there. The batch fails and is not noted in the ledger, so the
    checkpoint keeps it for the next run."""


@dataclass(frozen=True)
class BatchResult:
    status: str
    events: int
    tombstones: int


def apply_batch(batch: DataFrame, batch_id: int, job: CdcJob) -> BatchResult:
    """Decode one batch of split frames, apply it to the bronze table and note it in the ledger.

    The batch is read once: its figures come along with the pass that decodes it and stages the newest changes. Schemas
    of earlier batches are tried first; a batch with one they did not have is read again.
    """
    spark = batch.sparkSession
    started = time.monotonic()
    name = parse_topic(job.topic)
    schema, table = name.bronze_schema, name.bronze_table
    owner = (job.dag_id, schema, table)
    target = table_or_none(spark, job.store.name(schema, table))
    columns = None if target is None else data_schema(target.schema)
    first = columns is None or not job.known_pairs
    if first:  # the first batch of a run is kept, as it is read twice
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        figures = _applied(batch, BatchFigures.counted(batch) if first else None, columns, job)
    finally:
        if first:
            batch.unpersist()
    if not figures.events:
        append_ledger(spark, job.store, ledger_row(spark, owner, BatchFigures(), batch_id))
        return BatchResult(EMPTY, 0, 0)
    append_ledger(spark, job.store, ledger_row(spark, owner, figures, batch_id, time.monotonic() - started))
    return BatchResult(APPLIED, figures.events, figures.tombstones)


def _applied(batch: DataFrame, figures: BatchFigures | None, columns: StructType | None, job: CdcJob) -> BatchFigures:
    """Apply a batch whose figures may be known already; gives them."""
    spark = batch.sparkSession
    name = parse_topic(job.topic)
    schema, table = name.bronze_schema, name.bronze_table
    while figures is None or figures.events:
        if figures is not None:
            if columns is None:
                raise MissingTargetError(f"there is no table {job.store.name(schema, table)}; the batch is kept")
            resolved = resolve_pairs(figures.versions, job.registry, spark, job.known_schemas)
            require_keys(resolved)
            job.known_pairs.update({(pair.value_id, pair.key_id): pair for pair in resolved})
        pairs = list(job.known_pairs.values())
        if not pairs:  # tombstones only
            break
        watched = Watched(batch)
        changes = decode_all_changes(watched.records, pairs, columns, job.payload_format, job.source_tz)
        with staged_while(newest_changes(with_operation(changes)), "newest") as newest:
            figures = watched.figures()
            if any(value_id is not None and (value_id, key_id) not in job.known_pairs for value_id, key_id in figures.versions):
                continue
            if figures.events:
                merge_changes(spark, job.store, schema, table, newest, staged=True)
            break
    return figures


def run_topic(
    spark: SparkSession,
    job: CdcJob,
    records: DataFrame,
    checkpoint: str,
    on_batch: Callable[[int, BatchResult], None] | None = None,
) -> None:
    """Work off all records there are and stop; the next run goes on after them."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        result = apply_batch(batch, batch_id, job)
        log.info("%s batch=%s %s", job.topic, batch_id, result)
        if on_batch:
            on_batch(batch_id, result)

    query = (
        split_frames(records)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .queryName(job.topic)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def topic_checkpoint(warehouse: str, topic: str) -> str:
    return f"{warehouse.rstrip('/')}/checkpoints/cdc/{topic}"
