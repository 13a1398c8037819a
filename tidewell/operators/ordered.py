"""Previous values and running totals in an order, without collecting what is ordered in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import staged

CHUNK = "__chunk"


CHUNKS_PER_PARTITION = 4


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    output: str,
    chunks: int | None = None,
) -> DataFrame:
    """``lag(value) over (partition by keys order by order)`` for groups of any size.

    ``order`` has to be a total order within a group. Rows are range partitioned by (keys, order), which cuts a large group into consecutive chunks.

    The lag runs within each chunk, and the first row of a group in a chunk takes over the value
    from the last row of the chunk before, if that belongs to the same group. There is one last row
    per chunk, so what is handed over is small and safe to broadcast, whatever the data.

    Chunk numbers come from sampled range borders, so the rows are staged with them: otherwise a
    lost executor could change the borders half way.
    """
    chunks = chunks or CHUNKS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(
        df.repartitionByRange(chunks, *keys, *order).withColumn(CHUNK, F.spark_partition_id()), "ordered"
    )
    last_row = F.max_by(F.struct(*keys, value), F.struct(*keys, *order))
    # A window over all of these rows is a window over at most ``chunks`` rows.
    handed_over = (
        ranged.groupBy(CHUNK)
        .agg(last_row.alias("last"))
        .select(F.col(CHUNK).alias("__to"), F.lag("last").over(Window.orderBy(CHUNK)).alias("__handed"))
        .filter("__handed IS NOT NULL")
    )
    same_group = F.col(CHUNK) == F.col("__to")
    for key in keys:
        same_group = same_group & F.col(key).eqNullSafe(F.col(f"__handed.{key}"))
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    return (
        ranged.withColumn("__inside", F.lag(F.struct(value)).over(inside))
        .join(F.broadcast(handed_over), same_group, "left")
        .withColumn("__taken", F.when(F.col("__handed").isNotNull(), F.struct(f"__handed.{value}")))
        .withColumn("__before", F.coalesce("__inside", "__taken"))
        .select(*df.columns, F.col(f"__before.{value}").alias(output))
        .select(*df.columns, output)
    )


def with_total_before(df: DataFrame, order: Sequence[str], size: str, output: str, chunks: int | None = None) -> DataFrame:
    """The sum of ``size`` over all rows that come before in ``order``, which has to be a total one; 0 for the first.

    Rows are range partitioned by the order. Each chunk adds up its own rows, and takes over the sum of the chunks before
    it; there is one sum per chunk, so what is handed over is small and safe to broadcast, whatever the data.
    """
    chunks = chunks or CHUNKS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(df.repartitionByRange(chunks, *order).withColumn(CHUNK, F.spark_partition_id()), "ordered")
    # A window over all of these rows is a window over at most ``chunks`` rows.
    earlier = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    handed_over = (
        ranged.groupBy(CHUNK)
        .agg(F.sum(size).alias("own"))
        .select(F.col(CHUNK).alias("__to"), F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("__handed"))
    )
    inside = Window.partitionBy(CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("__handed") + F.coalesce(F.sum(size).over(inside), F.lit(0))
    return ranged.join(F.broadcast(handed_over), F.col(CHUNK) == F.col("__to")).select(*df.columns, total.alias(output))
