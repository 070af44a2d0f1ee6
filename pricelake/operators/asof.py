"""As-of joins over versions that are valid from one date up to another.

A join on ``from <= date < to`` pairs every row with every version of its key
before it can drop one, and puts a hot key into one task.  Here rows and
versions are sorted together instead: both go into one table, dealt by ranges
of (key, date), so a key that makes up a third of the rows spreads over as many
partitions as its rows need.  Within a partition each row takes the last
version before it; where a key goes on from one partition to the next, the
last version of the earlier ones is carried over the edge.  Only the first key
of a partition can need that, so at most a row per partition is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def _ranged(rows: DataFrame, versions: DataFrame, key: str, at: str, start: str, until: str, take: list[str],
            num_partitions: int | None) -> DataFrame:
    """Rows and versions in one table, in order, with their partition."""
    spark = rows.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in rows.columns])
    version = F.struct(F.col(start).alias("_start"), F.col(until).alias("_until"), *[F.col(c) for c in take])
    r = rows.select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.xxhash64(row).alias("_tie"), row.alias("_row"))
    v = (versions.where(F.col(key).isNotNull() & F.col(start).isNotNull())
         .select(F.col(key).alias("_key"), F.col(start).alias("_at"), F.lit(0).alias("_kind"), F.xxhash64(version).alias("_tie"),
                 version.alias("_version")))
    both = r.unionByName(v, allowMissingColumns=True)
    return (both.repartitionByRange(n, "_key", "_at", "_kind", "_tie").withColumn("_pid", F.spark_partition_id()))


def edges(ranged: DataFrame) -> DataFrame:
    """(_pid, _key, _carried): the last version before a partition of each key
    that goes on into it from an earlier one: at most one row a partition."""
    spans = ranged.where("_key IS NOT NULL").groupBy("_pid", "_key").agg(
        F.max(F.when(F.col("_version").isNotNull(), F.struct("_at", "_tie", "_version"))).alias("_last"))
    # a key in one partition only needs nothing; what is left are the edges
    several = spans.groupBy("_key").agg(F.min("_pid").alias("_lo"), F.max("_pid").alias("_hi")).where("_lo < _hi").select("_key")
    before = Window.partitionBy("_key").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return (spans.join(several, "_key").withColumn("_carried", F.last("_last", ignorenulls=True).over(before))
            .where("_carried IS NOT NULL").select("_pid", "_key", F.col("_carried._version").alias("_carried")))


def as_of(rows: DataFrame, versions: DataFrame, key: str, at: str, start: str, until: str, take: list[str],
          status: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """``rows`` with the columns ``take`` of the version of their ``key`` that
    is valid on ``at``: the last one with ``start <= at``, if ``at < until`` or
    ``until`` is NULL; else NULL.  With ``status``, a column of that name says
    "valid", "expired" (the last version ended before) or "none" (no version
    had begun, or the row has no key or date).

    Versions of a key must not overlap; of two that begin on one date either
    may win, but the same one on every run.  Rows keep their duplicates."""
    ranged = cut_lineage(_ranged(rows, versions, key, at, start, until, take, num_partitions))
    upto = Window.partitionBy("_pid", "_key").orderBy("_at", "_kind", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    found = (ranged.withColumn("_own", F.last("_version", ignorenulls=True).over(upto)).where("_kind = 1")
             .join(F.broadcast(edges(ranged)), ["_pid", "_key"], "left")
             .withColumn("_v", F.coalesce("_own", "_carried")))
    known = F.col("_key").isNotNull() & F.col("_at").isNotNull() & F.col("_v").isNotNull()
    valid = known & (F.col("_v._until").isNull() | (F.col("_at") < F.col("_v._until")))
    out: list[Column] = [F.when(valid, F.col(f"_v.{c}")).alias(c) for c in take]
    if status:
        out.append(F.when(valid, "valid").when(known, "expired").otherwise("none").alias(status))
    return found.select("_row.*", *out)
