"""Idempotent upsert of a batch into a keyed table (INSERT … ON CONFLICT
DO UPDATE semantics) as DataFrame algebra: anti-join + union."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assert_unique(df: DataFrame, keys: list[str], what: str = "upsert batch") -> DataFrame:
    """Fail the job if a key occurs twice in the batch (a database rejects a
    statement that touches one row twice).  The check is a grouped count
    (partially aggregated map-side, so many copies of one key never meet in
    one task) reduced to a scalar and folded into a key column, where the
    optimiser cannot prune it."""
    worst = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
             .select(F.coalesce(F.max("_n"), F.lit(0)).alias("_w")).scalar())
    k0 = keys[0]
    return df.withColumn(k0, F.when(worst > 1, F.raise_error(
        F.lit(f"duplicate key in {what}: {keys}"))).otherwise(F.col(k0)))


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str],
           update_cols: list[str] | None = None) -> DataFrame:
    """Rows of ``existing`` whose key is absent from ``incoming``, plus the
    incoming rows.  With ``update_cols``, a conflicting row keeps its other
    columns from ``existing`` and only takes ``update_cols`` from the batch."""
    incoming = assert_unique(incoming, keys)
    cols = existing.columns
    untouched = existing.join(incoming.select(*keys), keys, "left_anti")
    if update_cols is None:
        return untouched.unionByName(incoming.select(*cols))
    keep = [c for c in cols if c not in keys and c not in update_cols]
    old = existing.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in keep],
                          F.lit(True).alias("_hit"))
    merged = incoming.join(old, keys, "left").select(
        *keys, *[F.when(F.col("_hit"), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) for c in keep],
        *update_cols)
    return untouched.unionByName(merged.select(*cols))
