"""Which files and snapshots table maintenance has to work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.operators.ordered import with_total_before

# Defaults of the maintenance job.
TARGET_FILE_BYTES = 134_217_728
MIN_FILE_BYTES = 100_663_296
RETAIN_LAST = 5


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """path, length and modificationTime of all files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def directory_of(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def compaction_plan(
    files: DataFrame,
    group: str = "directory",
    target_bytes: int = TARGET_FILE_BYTES,
    min_bytes: int = MIN_FILE_BYTES,
    min_input_files: int = 2,
) -> DataFrame:
    """Groups worth rewriting: their small files, the bytes in them and the files to write instead."""
    small = files.filter(F.col("length") < min_bytes)
    return (
        small.groupBy(group)
        .agg(F.count("*").alias("input_files"), F.sum("length").alias("input_bytes"))
        .filter(F.col("input_files") >= min_input_files)
        .withColumn("output_files", F.ceil(F.col("input_bytes") / F.lit(target_bytes)).cast("bigint"))
        .filter("output_files < input_files")
    )


def snapshots_to_expire(snapshots: DataFrame, cutoff: Column, retain_last: int = RETAIN_LAST) -> DataFrame:
    """Snapshots older than the cutoff, but never the newest few of a table.

    The ones to keep are at most ``retain_last`` per table, found with a bounded row number; the
    old ones are matched against them by table and snapshot, so one busy table is no hot spot.
    """
    recent = _newest(snapshots, retain_last).select("table_name", "snapshot_id")
    return snapshots.filter(F.col("committed_at") < cutoff).join(recent, ["table_name", "snapshot_id"], "left_anti")


def _newest(snapshots: DataFrame, count: int) -> DataFrame:
    newest_first = Window.partitionBy("table_name").orderBy(F.desc("committed_at"), F.desc("snapshot_id"))
    ranked = snapshots.withColumn("__row", F.row_number().over(newest_first))
    return ranked.filter(F.col("__row") <= count).drop("__row")


def files_of_expired(referenced: DataFrame, expired: DataFrame) -> DataFrame:
    """Files that only expired snapshots refer to.

    One join marks the references of expired snapshots (a snapshot with very many files is a skewed
    partition that adaptive execution splits), one aggregate with map-side combine looks at each file.
    """
    marks = expired.select("table_name", "snapshot_id", F.lit(True).alias("expired"))
    return (
        referenced.join(marks, ["table_name", "snapshot_id"], "left")
        .groupBy("table_name", "path", "length")
        .agg(F.bool_and(F.col("expired").isNotNull()).alias("unused"))
        .filter("unused")
        .drop("unused")
    )


def orphan_files(
    listed: DataFrame, referenced: DataFrame, cutoff: Column, time: str = "modificationTime"
) -> DataFrame:
    """Listed files older than the cutoff that nothing refers to.

    Paths are made distinct first: a file that every snapshot refers to would be a hot key.
    """
    old = listed.filter(F.col(time) < cutoff)
    return old.join(referenced.select("path").distinct(), "path", "left_anti").select(listed.columns)


def compaction_groups(files: DataFrame, target_bytes: int = TARGET_FILE_BYTES, min_bytes: int = MIN_FILE_BYTES) -> DataFrame:
    """The small files (``directory``, ``path``, ``length``) with ``group_no``: which of them to write as one file.

    Files of at least ``min_bytes`` are in no group. The others of a directory are taken in the order of their paths, and a
    group ends where their running total passes a multiple of the target, so groups hold about as much each. A group of one
    file has nothing to merge with and is left out. Totals run on between chunks of the listing, so a directory may have
    any number of files.
    """
    small = files.filter(F.col("length") < min_bytes).select("directory", "path", "length")
    placed = with_total_before(small, ("directory", "path"), "length", "before")
    begins = placed.groupBy(F.col("directory").alias("of_directory")).agg(F.min("before").alias("begins"))
    numbered = placed.join(begins, F.col("directory") == F.col("of_directory")).select(
        "directory", "path", "length", F.expr(f"(before - begins) div {target_bytes}").alias("group_no")
    )
    several = numbered.groupBy(F.col("directory").alias("in_directory"), F.col("group_no").alias("in_group")).agg(
        F.count("*").alias("files")
    )
    mergeable = several.filter("files > 1")
    same = (F.col("directory") == F.col("in_directory")) & (F.col("group_no") == F.col("in_group"))
    return numbered.join(mergeable, same, "left_semi")
