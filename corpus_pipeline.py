"""A corpus pipeline of five stages over ``documents``; part of the corpus operators (``tidewell.llm``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import decontaminate, packing, secrets, simhash, toxicity
from tidewell.llm.queries import ORACLES, QUERIES, remainder, table
from tidewell.session import staged, use_utc


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    model = toxicity.model_of(docs, table(spark, sf_dir, "labels"), remainder(3) != 1)
    return toxicity.without_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-copies."""
    return simhash.representatives(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of secrets."""
    return secrets.redacted(docs, secrets.detector_of(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their bins."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: Toxicity and secrets are learned models, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read by the next."""
    use_utc(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


CORPUS_QUERIES = {**QUERIES, "pipeline": run}
CORPUS_ORACLES = dict(ORACLES) | ({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})
