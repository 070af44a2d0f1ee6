"""Bronze → silver: typed, de-duplicated, adjusted OHLCV (one vendor)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import nan_to_null
from ..schemas import NATIVE_ADJUSTED, PRICE_REQUIRED, SILVER_COLUMNS
from .dedup import keep_one

_KEYS = ("date", "ticker")
_ARRIVAL = ("_arrival_batch", "_arrival_file", "_arrival_row")


def require_columns(df: DataFrame, required: set[str], what: str) -> None:
    missing = set(required) - set(df.columns)
    if missing:
        raise ValueError(f"{what} lacks columns {sorted(missing)}")


def type_columns(df: DataFrame) -> DataFrame:
    """Date truncated to a calendar day; every other non-key column a number
    (strict ANSI cast — bad text fails the job); NaN becomes NULL."""
    out = []
    for c in df.columns:
        if c == "date":
            out.append(F.to_date(F.col(c)).alias(c))
        elif c == "ticker":
            out.append(F.col(c).cast("string").alias(c))
        elif c in _ARRIVAL or c == "_native":
            out.append(F.col(c))
        elif c in ("volume", "adj_volume"):
            out.append(F.col(c).cast("long").alias(c))
        else:
            out.append(nan_to_null(F.col(c).cast("double")).alias(c))
    return df.select(*out)


def derive_adjusted(df: DataFrame, strict: bool = True) -> DataFrame:
    """adj_{open,high,low} = raw × (adj_close / close); adj_volume = volume
    (volume is deliberately not split-adjusted).  A close that is not
    positive fails the job; unless ``strict``, the row stays, and a close of
    zero leaves its adjusted prices NULL.  Rows that a scan marked ``_native``
    came with the vendor's own adjusted prices and keep them."""
    native = F.col("_native") if "_native" in df.columns else F.lit(False)
    if strict:
        # a row filter, so that no choice of columns prunes the guard away
        df = df.where(F.when(~native & (F.col("close") <= 0), F.raise_error(F.lit(
            "a close that is not positive gives no adjustment factor")).cast("boolean")).otherwise(F.lit(True)))
    df = df.withColumn("_factor", F.when(~native, F.try_divide("adj_close", "close")))

    def own(c, derived):
        return F.when(native, F.col(c)).otherwise(derived) if c in df.columns else derived

    return (df.withColumn("adj_open", own("adj_open", F.col("open") * F.col("_factor")))
            .withColumn("adj_high", own("adj_high", F.col("high") * F.col("_factor")))
            .withColumn("adj_low", own("adj_low", F.col("low") * F.col("_factor")))
            .withColumn("adj_volume", own("adj_volume", F.col("volume")))
            .drop("_factor"))


def dedup_keep_last(df: DataFrame) -> DataFrame:
    """Last arrival wins per (ticker, date).  Arrival order is the landing's
    batch number, file and row index when the scan exposed them; without
    them the values themselves decide, so that reruns agree."""
    if set(_ARRIVAL) <= set(df.columns):
        # dealt out first: keep-last sorts each task's rows, and a task that
        # reads files, whose rows unpack many times over, is not to sort them all
        df = df.repartition(*_KEYS)
        order = [F.col(c) for c in _ARRIVAL]
    else:
        order = [F.col(c) for c in df.columns if c not in _KEYS]
    return keep_one(df, ["ticker", "date"], order, last=True)


def uses_native_adjusted(df: DataFrame) -> bool:
    return NATIVE_ADJUSTED <= set(df.columns)


def to_silver(bronze: DataFrame, source: str = "vendor", strict: bool = True) -> DataFrame:
    """The silver transform of one vendor's bronze rows (lazy); ``strict`` as
    in ``derive_adjusted``."""
    require_columns(bronze, PRICE_REQUIRED, f"{source} bronze")
    df = dedup_keep_last(type_columns(bronze))
    if "_native" in df.columns or not uses_native_adjusted(df):
        df = derive_adjusted(df, strict)
    return df.select(*SILVER_COLUMNS)


def history_range(df: DataFrame, start, end=None) -> DataFrame:
    """Rows with ``start <= date <= end`` (end open when None)."""
    c = F.col("date") >= F.lit(start)
    if end is not None:
        c = c & (F.col("date") <= F.lit(end))
    return df.where(c)
