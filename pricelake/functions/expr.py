"""Column-expression helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import NAME_SUFFIX_WORDS, RECONCILIATION_TOLERANCE


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """pandas treats NaN as missing; Spark does not (NaN > x is true)."""
    return F.nanvl(_c(c), F.lit(None).cast("double"))


def strip(c) -> Column:
    """Without surrounding white space of any kind (Unicode's, and the four
    separator controls)."""
    return F.regexp_replace(_c(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def normalize_ticker(c) -> Column:
    """Vendor convention: share-class dot becomes a dash, surrounding blanks go."""
    return strip(F.translate(_c(c), ".", "-"))


# FIXED VALUES: what a normalised company name leaves out.
# (?U) makes \w, \s and \b Unicode-aware, as in Python's re.
_PUNCT = r"(?U)[^\w\s]"
_SUFFIX = r"(?U)\b(" + "|".join(NAME_SUFFIX_WORDS) + r"|CLASS [A-Z])\b\.?"
_SPACES = r"(?U)\s+"


def normalize_company_name(c) -> Column:
    """Upper-case, punctuation to blanks, legal suffixes and share-class
    labels removed, whitespace collapsed.  NULL or empty gives ''."""
    x = F.upper(F.coalesce(_c(c), F.lit("")))
    x = F.regexp_replace(x, _PUNCT, " ")
    x = F.regexp_replace(x, _SUFFIX, " ")
    x = F.regexp_replace(x, _SPACES, " ")
    return F.trim(x)


def date_key(d) -> Column:
    """YYYYMMDD integer key."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def monday0_weekday(d) -> Column:
    """0 = Monday … 6 = Sunday."""
    return F.weekday(_c(d)).cast("int")


def month_name(d) -> Column:
    return F.date_format(_c(d), "MMMM")


def day_name(d) -> Column:
    return F.date_format(_c(d), "EEEE")


def pct_diff(a, b) -> Column:
    """Symmetric relative difference |a-b| / mean(a, b).  Around a zero mean
    it is infinite for different values and NULL for equal ones (0/0)."""
    a, b = _c(a), _c(b)
    diff, mean = F.abs(a - b), (a + b) / 2
    return F.when((mean == 0) & (diff > 0), F.lit(float("inf"))).otherwise(F.try_divide(diff, mean))


def is_flagged(a, b, tolerance: float = RECONCILIATION_TOLERANCE) -> Column:
    """Strictly above tolerance.  A non-zero difference around a zero mean is
    an infinite relative difference and is flagged; 0/0 is not."""
    a, b = _c(a), _c(b)
    diff = F.abs(a - b)
    mean = (a + b) / 2
    return F.coalesce(
        F.when(mean == 0, diff > 0).otherwise(pct_diff(a, b) > F.lit(tolerance)),
        F.lit(False))


def to_decimal(c, precision: int = 18, scale: int = 6) -> Column:
    """Double to DECIMAL(precision, scale), half-up on the digits the value
    prints with, in one step: 7.625 * 1.00002 prints as 7.6251524999999996
    and gives 7.625152.  What a decimal can't hold (NaN, infinity) is NULL."""
    c = _c(c)
    finite = F.abs(c) < F.lit(float("inf"))
    return F.when(finite, c).cast(f"decimal({precision},{scale})")
