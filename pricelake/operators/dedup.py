"""Keep-first / keep-last de-duplication (window, one shuffle on the key)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: list[str], order: list[Column], last: bool = True) -> DataFrame:
    """One row per ``keys``; ``order`` is the arrival order (earliest first).

    ``last=True`` keeps the latest arrival, ``last=False`` the earliest.
    Groups are duplicate sets of one key, so they stay small even when a key
    is hot in the data as a whole.
    """
    ords = [o.desc_nulls_last() if last else o.asc_nulls_last() for o in order]
    w = Window.partitionBy(*keys).orderBy(*ords)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")

