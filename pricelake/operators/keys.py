"""Global running totals and dense surrogate keys without a single-task window.

``row_number()`` or a running ``sum`` over an unpartitioned window pulls every
row into one task.  Instead: range-partition on the ordering (a hot key is
split across partitions because the ordering is unique per row), total
inside each partition, turn the (few) per-partition totals into offsets, and
add them back.  The numbered frame is checkpointed first so both uses see the
same partitions even after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def running_total(df: DataFrame, order: list[str], out: str, weight: Column | None = None,
                  num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``weight`` (default 1) over every row up to and
    including this one under ``order`` (which must be unique per row)."""
    from pyspark import StorageLevel
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    w = F.lit(1) if weight is None else weight
    # the input feeds both the range-bound sampling and the shuffle: hold it
    # for the duration so it is computed once
    src = df.withColumn("_w", w.cast("long")).persist(StorageLevel.MEMORY_AND_DISK)
    ranged = (src.repartitionByRange(n, *order)
              .withColumn("_pid", F.spark_partition_id()))
    ranged = ranged.withColumn("_cs", F.sum("_w").over(
        Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    try:
        ranged = cut_lineage(ranged, spark)
    finally:
        src.unpersist()
    totals = ranged.groupBy("_pid").agg(F.sum("_w").alias("_tot"))
    # one row per partition: a single-task window over at most n rows
    offsets = totals.select(
        "_pid", (F.sum("_tot").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1))).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.coalesce(F.col("_off"), F.lit(0)) + F.col("_cs"))
            .drop("_pid", "_cs", "_off", "_w"))


def assign_keys(df: DataFrame, order: list[str], key: str, start: Column | int = 1,
                num_partitions: int | None = None) -> DataFrame:
    """Add ``key`` = start + 0-based rank of each row under ``order``.
    ``order`` must be unique per row."""
    base = start if isinstance(start, Column) else F.lit(start)
    return (running_total(df, order, "_rank", num_partitions=num_partitions)
            .withColumn(key, (base + F.col("_rank") - 1).cast("int")).drop("_rank"))
