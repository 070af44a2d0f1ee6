"""What a re-pull changed, by fingerprints of buckets.

A vendor's full history comes again every day and is almost always the same.
A bucket's fingerprint does not depend on the order of its rows: their number
and the sums of two 64-bit hashes of each row, 128 bits together.  Kept as a
small table, it tells without a join of rows which (ticker, period) buckets
moved, and only those are built and upserted again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nan_to_null
from ..sources import bronze, fs

KEYS = ["ticker", "period"]
#: Starts the second hash of a row.
SECOND = 0x5DEECE66D


def with_period(df: DataFrame, period: str = "month") -> DataFrame:
    """The bucket column: first day of the bar's ``period`` (week, month, year)."""
    return df.withColumn("period", F.trunc("date", period).cast("date"))


def _hashed(df: DataFrame, columns: list[str]) -> list[Column]:
    """What a row is hashed by: NaN as NULL and -0.0 as 0.0, as silver reads
    them; which values are NULL counts too, since a hash skips them."""
    out = []
    for c in columns:
        v = F.col(c)
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            v = nan_to_null(v) + F.lit(0.0)
        out += [v, v.isNull()]
    return out


def fingerprints(df: DataFrame, keys: list[str] = KEYS, columns: list[str] | None = None) -> DataFrame:
    """(keys, rows, fp1, fp2) of each bucket over ``columns`` (default: all
    others, in order of name, so that a landing's column order is no change)."""
    columns = sorted(columns or set(df.columns) - set(keys))
    v = _hashed(df, columns)

    def total(h):
        return F.sum(h.cast("decimal(38,0)"))  # 10^18 rows of 64 bits fit

    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), total(F.xxhash64(*v)).alias("fp1"),
                                 total(F.xxhash64(F.lit(SECOND), *v)).alias("fp2"))


def changes(old: DataFrame, new: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Every bucket of two fingerprint tables with its status: same, changed,
    new or gone; ``old_rows`` and ``new_rows`` (0 where it is not there)."""
    def side(df, x):
        return df.select(*keys, F.struct("rows", "fp1", "fp2").alias(x))

    j = side(old, "o").join(side(new, "n"), keys, "full")
    status = (F.when(F.col("o").isNull(), "new").when(F.col("n").isNull(), "gone")
              .when(F.col("o") == F.col("n"), "same").otherwise("changed"))
    return j.select(*keys, status.alias("status"), F.coalesce("o.rows", F.lit(0).cast("long")).alias("old_rows"),
                    F.coalesce("n.rows", F.lit(0).cast("long")).alias("new_rows"))


def moved_rows(df: DataFrame, changed: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Rows of the buckets that are new or changed."""
    return df.join(changed.where(F.col("status").isin("new", "changed")).select(*keys), keys, "left_semi")


# ---- kept between runs ----------------------------------------------------------

def _kept(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/silver/_fingerprints/{dataset}"


def read_kept(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    schema = "ticker string, period date, rows long, fp1 decimal(38,0), fp2 decimal(38,0)"
    path = _kept(root, dataset)
    return spark.read.schema(schema).parquet(path) if fs.exists(spark, path) else spark.createDataFrame([], schema)


def keep(fps: DataFrame, root: str, dataset: str) -> None:
    """Replace the kept fingerprints; a crash leaves the former ones, and a
    run that starts from those builds a bucket again, which changes nothing."""
    fs.replace(fps.select(*KEYS, "rows", "fp1", "fp2"), root, _kept(root, dataset))


def landed_changes(spark: SparkSession, root: str, dataset: str, schema: T.StructType, ingest_date: dt.date,
                   period: str = "month") -> tuple[DataFrame, DataFrame]:
    """(status of every bucket of the date's landing against the kept state,
    the fingerprints to keep once its buckets are built)."""
    rows = bronze.scan(spark, root, dataset, schema, ingest_date, arrival=False).drop("ingest_date", "batch")
    now = fingerprints(with_period(rows, period))
    return changes(read_kept(spark, root, dataset), now), now
