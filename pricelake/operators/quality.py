"""Tolerance-aware quality gate that reports every broken rule at once.

Rules are data.  All row-level rules of one dataset compile into ONE
aggregate (a ``count_if`` for unexpected rows and one for evaluated rows per
rule) grouped by the dataset's unique key, so the gate is a single scan and
one exchange; a second uniqueness rule adds one grouped count.  The result is a tidy report:
(source, check, success, unexpected_count, element_count).

Null policy (as in the expectation library the reference used):
  * single-column range rules skip NULLs (not evaluated);
  * not-null rules count NULLs as unexpected over all rows;
  * pair rules ignore rows where both sides are NULL, and a row with one
    NULL side counts as unexpected;
  * uniqueness counts every member of a duplicated group; rows whose key
    columns are all NULL are ignored.
success = evaluated == 0 or (evaluated - unexpected) / evaluated >= mostly.
Table-level rules (row-count band, non-empty) report unexpected_count 1 when
they fail and 0 when they pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import CONSTITUENTS_ROW_BAND, INDEX_LEVEL_SERIES, OHLC_TOLERANCE

REPORT_COLUMNS = ["source", "check_name", "success", "unexpected_count", "element_count"]


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str                 # not_null | between | pair_ge | length_eq | unique | row_count
    columns: tuple = ()
    low: float | None = None
    high: float | None = None
    strict_low: bool = False
    strict_high: bool = False
    mostly: float = 1.0


def not_null(c):
    return Rule(f"{c} not null", "not_null", (c,))


def greater_than(c, v, name=None):
    return Rule(name or f"{c} > {v:g}", "between", (c,), low=v, strict_low=True)


def at_least(c, v, name=None):
    return Rule(name or f"{c} >= {v:g}", "between", (c,), low=v)


def in_range(c, lo, hi, name=None):
    return Rule(name or f"{c} in [{lo:g}, {hi:g}]", "between", (c,), low=lo, high=hi)


def pair_ge(a, b, name, mostly=1.0):
    return Rule(name, "pair_ge", (a, b), mostly=mostly)


def unique(*cols, name=None):
    return Rule(name or (f"({', '.join(cols)}) unique" if len(cols) > 1 else f"{cols[0]} unique"),
                "unique", tuple(cols))


def length_eq(c, n, name=None):
    return Rule(name or f"{c} is {n} characters", "length_eq", (c,), low=n)


def row_count(lo, hi):
    return Rule(f"row count in [{lo}, {hi}]", "row_count", (), low=lo, high=hi)


# FIXED VALUES: the rule sets of the reference gate, in its order.
def price_rules(mostly: float = OHLC_TOLERANCE) -> list[Rule]:
    return [
        not_null("ticker"), not_null("date"), not_null("close"),
        greater_than("close", 0), greater_than("open", 0), greater_than("adj_close", 0),
        at_least("volume", 0),
        pair_ge("high", "low", "high >= low", mostly),
        pair_ge("high", "open", "high >= open", mostly),
        pair_ge("high", "close", "high >= close", mostly),
        pair_ge("open", "low", "low <= open", mostly),
        pair_ge("close", "low", "low <= close", mostly),
        unique("ticker", "date"),
    ]


def constituents_rules(band: tuple[int, int] = CONSTITUENTS_ROW_BAND) -> list[Rule]:
    return [not_null("ticker"), unique("ticker"), not_null("gics_sector"), row_count(*band)]


def identifier_rules() -> list[Rule]:
    return [not_null("figi"), unique("figi"), length_eq("figi", 12), unique("ticker")]


def _range_bad(c: Column, r: Rule) -> Column:
    conds = []
    if r.low is not None:
        conds.append(c <= r.low if r.strict_low else c < r.low)
    if r.high is not None:
        conds.append(c >= r.high if r.strict_high else c > r.high)
    bad = conds[0]
    for x in conds[1:]:
        bad = bad | x
    return bad


def _row_exprs(r: Rule) -> tuple[Column, Column] | None:
    """(unexpected, evaluated) predicates for a row-level rule."""
    if r.kind == "not_null":
        c = F.col(r.columns[0])
        return c.isNull(), F.lit(True)
    if r.kind == "between":
        c = F.col(r.columns[0])
        return c.isNotNull() & _range_bad(c, r), c.isNotNull()
    if r.kind == "length_eq":
        c = F.col(r.columns[0])
        return c.isNotNull() & (F.length(c) != int(r.low)), c.isNotNull()
    if r.kind == "pair_ge":
        a, b = F.col(r.columns[0]), F.col(r.columns[1])
        evaluated = a.isNotNull() | b.isNotNull()
        return evaluated & ~F.coalesce(a >= b, F.lit(False)), evaluated
    return None


def row_violation(rules: list[Rule]) -> Column:
    """Name of the first rule without tolerance that a row breaks by itself,
    or NULL."""
    broken = [F.when(e[0], F.lit(r.name)) for r in rules if r.mostly == 1.0 and (e := _row_exprs(r)) is not None]
    return F.coalesce(*broken)


def set_aside(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(rows that break no rule by themselves, the others with the ``reason``):
    what a gate hands on, and what it puts in quarantine."""
    reason = row_violation(rules)
    return df.where(reason.isNull()), df.where(reason.isNotNull()).withColumn("reason", reason)


def _success(unexpected: Column, evaluated: Column, mostly: float) -> Column:
    return (evaluated == 0) | ((evaluated - unexpected) / evaluated >= F.lit(mostly))


def _counters(rules: list[Rule]) -> dict[str, Column]:
    """Aggregates that the row rules need, by name."""
    out = {"_n": F.count(F.lit(1))}
    for i, r in enumerate(rules):
        e = _row_exprs(r)
        if e is not None:
            out |= {f"_u{i}": F.count_if(e[0]), f"_e{i}": F.count_if(e[1])}
    return out


class Observed:
    """Rule counts out of the pass that writes a frame.

    ``watch`` a frame, write it once, then ask for the ``report``: the counts
    were taken while the rows went by, so the gate reads nothing again.
    Uniqueness needs rows to meet and is left to ``evaluate``.  A frame that
    is read by two actions is counted at the first only."""

    def __init__(self, rules: list[Rule]):
        self.rules = [r for r in rules if r.kind != "unique"]
        self._observation = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self._observation, *[c.alias(n) for n, c in _counters(self.rules).items()])

    def report(self, spark: SparkSession, source: str) -> DataFrame:
        """As ``evaluate`` gives it; waits for the write."""
        counts = self._observation.get
        names = list(_counters(self.rules))
        one = spark.createDataFrame([tuple(int(counts[n]) for n in names)], ", ".join(f"{n} long" for n in names))
        return _report(one, self.rules, source)


def _stats(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row: _n, and _u{i}, _e{i} per rule, from one scan of ``df``.

    The first uniqueness rule's key groups the rows and carries the row
    rules' counters along, so that rule and all row rules share one exchange
    of partial sums; a further uniqueness rule adds one grouped count."""
    counters = _counters(rules)
    uniques = [(i, r) for i, r in enumerate(rules) if r.kind == "unique"]
    if not uniques:
        return df.agg(*[c.alias(n) for n, c in counters.items()])

    def some(keys):
        return F.coalesce(*[F.when(F.col(k).isNotNull(), F.lit(True)) for k in keys], F.lit(False))

    def members(i, keys):
        c = F.when(some(keys), F.col("_n"))
        return [F.coalesce(F.sum(F.when(c > 1, c)), F.lit(0)).cast("long").alias(f"_u{i}"),
                F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"_e{i}")]

    (i, r), *more = uniques
    stats = (df.groupBy(*r.columns).agg(*[c.alias(n) for n, c in counters.items()])
             .agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in counters if n != "_n"],
                  *members(i, r.columns), F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("_n")))
    for i, r in more:
        g = df.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("_n")).agg(*members(i, r.columns))
        stats = _one_row_join(stats, g)  # both sides are single-row aggregates
    return stats


def evaluate(df: DataFrame, rules: list[Rule], source: str | Column) -> DataFrame:
    """Run every rule over ``df``; one report row per rule (or a single
    failing 'non-empty dataframe' row when ``df`` has no rows)."""
    return _report(_stats(df, rules), rules, source)


def _report(stats: DataFrame, rules: list[Rule], source: str | Column) -> DataFrame:
    """The report out of one row of counts."""
    src = source if isinstance(source, Column) else F.lit(source)
    structs = []
    for i, r in enumerate(rules):
        if r.kind == "row_count":
            n = F.col("_n")
            ok = n.between(int(r.low), int(r.high))
            structs.append(F.struct(F.lit(r.name).alias("check_name"), ok.alias("success"),
                                    F.when(ok, 0).otherwise(1).cast("long").alias("unexpected_count"),
                                    n.alias("element_count")))
        else:
            u = F.col(f"_u{i}")
            e = F.col("_n") if r.kind == "not_null" else F.col(f"_e{i}")
            structs.append(F.struct(F.lit(r.name).alias("check_name"),
                                    _success(u, e, r.mostly).alias("success"),
                                    u.alias("unexpected_count"), e.alias("element_count")))
    empty = F.struct(F.lit("non-empty dataframe").alias("check_name"), F.lit(False).alias("success"),
                     F.lit(1).cast("long").alias("unexpected_count"),
                     F.lit(0).cast("long").alias("element_count"))
    checks = F.when(F.col("_n") == 0, F.array(empty)).otherwise(F.array(*structs))
    return stats.select(src.alias("source"), F.inline(checks)).select(*REPORT_COLUMNS)


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Join two single-row aggregates side by side (equi-join on a constant)."""
    return a.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one").drop("_one")


def evaluate_macro(df: DataFrame, index_series=INDEX_LEVEL_SERIES) -> DataFrame:
    """Macro series are checked one report per series: value not null, and
    value > 0 for index-level series or value in [0, 25] for rates.  One
    grouped aggregate covers every series."""
    v = F.col("value")
    is_index = F.col("series_id").isin(list(index_series))
    g = df.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(v.isNull()).alias("_null"),
        F.count_if(v.isNotNull()).alias("_eval"),
        F.count_if(v.isNotNull() & ((v < 0) | (v > 25))).alias("_rate_bad"),
        F.count_if(v.isNotNull() & (v <= 0)).alias("_index_bad"),
    )
    bad = F.when(is_index, F.col("_index_bad")).otherwise(F.col("_rate_bad"))
    name = F.when(is_index, F.lit("value > 0 (index level)")).otherwise(
        F.lit("value in plausible rate range [0, 25]"))
    checks = F.array(
        F.struct(F.lit("value not null").alias("check_name"), _success(F.col("_null"), F.col("_n"), 1.0).alias("success"),
                 F.col("_null").alias("unexpected_count"), F.col("_n").alias("element_count")),
        F.struct(name.alias("check_name"), _success(bad, F.col("_eval"), 1.0).alias("success"),
                 bad.alias("unexpected_count"), F.col("_eval").alias("element_count")),
    )
    return g.select(F.concat(F.lit("macro:"), F.col("series_id")).alias("source"),
                    F.inline(checks)).select(*REPORT_COLUMNS)


def rollup(reports: DataFrame) -> DataFrame:
    """Per-source verdict (all checks passed?) over a unioned report."""
    return reports.groupBy("source").agg(
        F.every("success").alias("passed"),
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("success")).alias("failed_checks"))


def overall(reports: DataFrame) -> DataFrame:
    """Gate verdict: n of m sources clean; no report at all is a failure."""
    per = rollup(reports)
    return per.agg(
        F.count_if("passed").alias("sources_clean"),
        F.count(F.lit(1)).alias("sources_checked"),
        (F.coalesce(F.every("passed"), F.lit(False)) & (F.count(F.lit(1)) > 0)).alias("passed"))


# FIXED VALUES: OHLC ordering rules of the violation diagnosis, in order.
OHLC_VIOLATIONS = [
    ("low > open", "low", ">", "open"),
    ("low > close", "low", ">", "close"),
    ("low > high", "low", ">", "high"),
    ("high < open", "high", "<", "open"),
    ("high < close", "high", "<", "close"),
]


def ohlc_violations(df: DataFrame) -> DataFrame:
    """Offending bars, one output row per broken rule (a bar may appear more
    than once).  One pass: an array of matched rule names, exploded.  A
    NULL comparison is not a violation."""
    names = []
    for name, a, op, b in OHLC_VIOLATIONS:
        cond = (F.col(a) > F.col(b)) if op == ">" else (F.col(a) < F.col(b))
        names.append(F.when(F.coalesce(cond, F.lit(False)), F.lit(name)))
    hits = F.filter(F.array(*names), lambda x: x.isNotNull())
    return (df.withColumn("violation", F.explode(hits)))
