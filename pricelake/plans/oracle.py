"""Independent DuckDB SQL for every registered query.

The views at the top re-state the binding rules of
``pricelake.sources.bindings`` in plain SQL over the supplied tables; each
query composes only the views it needs.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}
SQL: dict[str, str] = {}


def view(name: str, body: str) -> None:
    VIEWS[name] = body.strip()


def _deps(sql: str) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        for m in VIEWS:
            if m != n and m not in seen and re.search(rf"\b{m}\b", VIEWS[n]):
                visit(m)
        if n not in seen:
            seen.append(n)

    for n in VIEWS:
        if re.search(rf"\b{n}\b", sql):
            visit(n)
    return seen


def q(name: str, body: str) -> None:
    body = body.strip()
    deps = _deps(body)
    if deps:
        ctes = ",\n".join(f"{n} AS (\n{VIEWS[n]}\n)" for n in deps)
        own = body.removeprefix("WITH ")
        SQL[name] = f"WITH {ctes}" + (f",\n{own}" if own != body else f"\n{body}")
    else:
        SQL[name] = body


R = 9  # rounding digits, as in plans/present.py

# ---- bindings -----------------------------------------------------------
view("bars_all", """
SELECT uid, date, day(date) AS dy, 'U' || lpad(CAST(uid AS VARCHAR), CAST(greatest(6, length(CAST(uid AS VARCHAR))) AS INTEGER), '0') AS ticker,
       open, high,
       CASE WHEN uid % 97 = 7 AND day(date) = 5 THEN open + 0.5 ELSE low END AS low,
       close,
       close * CASE WHEN uid % 3 = 0 AND date < DATE '2024-01-16' THEN 0.5 ELSE 1.0 END AS adj_close,
       volume
FROM (SELECT user_id AS uid, CAST(ts AS DATE) AS date,
             arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
             arg_max(value, ts) AS close, count(*) AS volume
      FROM events GROUP BY 1, 2) g
""")
view("primary_bronze", """
SELECT date, open, high, low, close, adj_close, volume,
       CASE WHEN uid % 10 = 0 AND dy = 10 THEN 0.24 ELSE 0.0 END::DOUBLE AS dividends,
       CASE WHEN uid % 3 = 0 AND date = DATE '2024-01-16' THEN 2.0 ELSE 0.0 END::DOUBLE AS stock_splits,
       ticker
FROM bars_all WHERE (uid + dy) % 31 <> 0
""")
_UID, _DY = "CAST(substr(ticker, 2) AS BIGINT)", "day(date)"
view("primary_landed", f"""
SELECT date, open, high, low,
       CASE WHEN {_UID} % 61 = 5 AND {_DY} = 13 THEN 0.0 WHEN {_UID} % 67 = 8 AND {_DY} = 14 THEN -close
            WHEN {_UID} % 71 = 10 AND {_DY} = 15 THEN NULL ELSE close * f END AS close,
       CASE WHEN {_UID} % 61 = 5 AND {_DY} = 13 THEN 0.0 ELSE adj_close * f END AS adj_close,
       CASE WHEN {_UID} % 73 = 2 AND {_DY} = 16 THEN -volume ELSE volume END AS volume, dividends, stock_splits,
       CASE WHEN {_UID} % 53 = 9 AND {_DY} = 11 THEN NULL WHEN {_UID} % 17 = 4 AND {_DY} = 3 THEN 'X' || ticker
            ELSE ticker END AS ticker
FROM (SELECT *, 1.0::DOUBLE AS f FROM primary_bronze
      UNION ALL SELECT *, 1.002::DOUBLE FROM primary_bronze WHERE {_UID} % 41 = 3 AND {_DY} = 7) b
""")
_ROW_OK = ("ticker IS NOT NULL AND date IS NOT NULL AND close > 0 AND coalesce(open, 1) > 0 "
           "AND coalesce(adj_close, 1) > 0 AND coalesce(volume, 0) >= 0")
view("landed_silver", f"""
SELECT ticker, date, open, high, low, close, adj_close,
       open * (adj_close / close) AS adj_open, high * (adj_close / close) AS adj_high,
       low * (adj_close / close) AS adj_low, volume, volume AS adj_volume
FROM primary_landed
WHERE {_ROW_OK}
QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY close DESC) = 1
""")
view("secondary_scaled", """
SELECT uid, date, ticker, open, high, low, close, volume,
       adj_close * CASE WHEN uid % 46 = 6 AND dy = 9 THEN -1
                        WHEN uid % 20 = 0 AND date < DATE '2024-01-10' THEN 1.07
                        WHEN uid % 50 = 4 THEN 1.013 ELSE 1.00002 END AS adj_close
FROM bars_all WHERE uid % 2 = 0 AND (uid + dy) % 29 <> 0
""")
view("secondary_bronze", """
SELECT date, open, high, low, close, adj_close,
       open * (adj_close / close) AS adj_open, high * (adj_close / close) AS adj_high,
       low * (adj_close / close) AS adj_low, volume * 2 AS adj_volume, volume, ticker
FROM secondary_scaled
""")
view("primary_silver", f"""
SELECT ticker, date, open, high, low, close, adj_close,
       open * (adj_close / close) AS adj_open, high * (adj_close / close) AS adj_high,
       low * (adj_close / close) AS adj_low, volume, volume AS adj_volume
FROM primary_bronze WHERE {_ROW_OK}
""")
view("secondary_silver", """
SELECT ticker, date, open, high, low, close, adj_close, adj_open, adj_high, adj_low,
       volume, adj_volume
FROM secondary_bronze
""")
view("matched", """
SELECT coalesce(p.ticker, s.ticker) AS ticker, coalesce(p.date, s.date) AS date,
       p.adj_close AS primary_adj_close, s.adj_close AS secondary_adj_close,
       CASE WHEN p.ticker IS NOT NULL AND s.ticker IS NOT NULL THEN 'both'
            WHEN p.ticker IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS _merge
FROM primary_silver p FULL OUTER JOIN secondary_silver s
  ON p.ticker = s.ticker AND p.date = s.date
""")
view("landed_matched", """
SELECT coalesce(p.ticker, s.ticker) AS ticker, coalesce(p.date, s.date) AS date,
       p.adj_close AS primary_adj_close, s.adj_close AS secondary_adj_close,
       CASE WHEN p.ticker IS NOT NULL AND s.ticker IS NOT NULL THEN 'both'
            WHEN p.ticker IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS _merge
FROM landed_silver p FULL OUTER JOIN secondary_silver s
  ON p.ticker = s.ticker AND p.date = s.date
""")
view("pairs", """
SELECT ticker, date, primary_adj_close, secondary_adj_close,
       abs(primary_adj_close - secondary_adj_close) AS abs_diff,
       CASE WHEN primary_adj_close + secondary_adj_close = 0
            THEN CASE WHEN primary_adj_close <> secondary_adj_close THEN 'Infinity'::DOUBLE END
            ELSE abs(primary_adj_close - secondary_adj_close)
                 / ((primary_adj_close + secondary_adj_close) / 2) END AS pct_diff,
       coalesce(CASE WHEN (primary_adj_close + secondary_adj_close) / 2 = 0
                     THEN abs(primary_adj_close - secondary_adj_close) > 0
                     ELSE abs(primary_adj_close - secondary_adj_close)
                          / ((primary_adj_close + secondary_adj_close) / 2) > 0.005 END,
                false) AS flagged
FROM matched WHERE _merge = 'both'
""")
view("profile", """
SELECT ticker, count(*) AS rows_compared, count(*) FILTER (WHERE flagged) AS rows_flagged,
       max(pct_diff) AS max_pct_diff, median(pct_diff) AS median_pct_diff,
       min(CASE WHEN flagged THEN date END) AS first_flagged,
       max(CASE WHEN flagged THEN date END) AS last_flagged,
       min(date) AS first_compared, max(date) AS last_compared,
       count(*) FILTER (WHERE flagged) * 100.0 / count(*) AS flagged_pct
FROM pairs GROUP BY ticker
""")
view("totals", """
SELECT count(*) FILTER (WHERE _merge = 'both') AS total_compared,
       count(*) FILTER (WHERE _merge = 'both' AND coalesce(CASE
           WHEN (primary_adj_close + secondary_adj_close) / 2 = 0
           THEN abs(primary_adj_close - secondary_adj_close) > 0
           ELSE abs(primary_adj_close - secondary_adj_close)
                / ((primary_adj_close + secondary_adj_close) / 2) > 0.005 END, false)) AS flagged_count,
       count(*) FILTER (WHERE _merge = 'left_only') AS primary_only_count,
       count(*) FILTER (WHERE _merge = 'right_only') AS secondary_only_count
FROM matched
""")

_SILVER_COLS = f"""ticker, CAST(date AS VARCHAR) AS date, round(open, {R}) AS open, round(high, {R}) AS high,
       round(low, {R}) AS low, round(close, {R}) AS close, round(adj_close, {R}) AS adj_close,
       round(adj_open, {R}) AS adj_open, round(adj_high, {R}) AS adj_high,
       round(adj_low, {R}) AS adj_low, CAST(volume AS BIGINT) AS volume,
       CAST(adj_volume AS BIGINT) AS adj_volume"""

q("silver_adjusted_derived", f"SELECT {_SILVER_COLS} FROM primary_silver")
q("silver_adjusted_native", f"SELECT {_SILVER_COLS} FROM secondary_silver")

q("reconcile_pairs", f"""
SELECT ticker, CAST(date AS VARCHAR) AS date, round(primary_adj_close, {R}) AS primary_adj_close,
       round(secondary_adj_close, {R}) AS secondary_adj_close, round(abs_diff, {R}) AS abs_diff,
       CASE WHEN isfinite(pct_diff) THEN round(pct_diff, {R}) END AS pct_diff, flagged
FROM pairs
""")
SQL["reconcile_bucketed"] = SQL["reconcile_pairs"]
q("reconcile_coverage", f"""
SELECT total_compared, flagged_count,
       round(coalesce(flagged_count * 100.0 / nullif(total_compared, 0), 0.0), {R})::DOUBLE AS flagged_pct,
       primary_only_count, secondary_only_count
FROM totals
""")
_PROFILE_COLS = f"""ticker, rows_compared, rows_flagged, CASE WHEN isfinite(max_pct_diff) THEN round(max_pct_diff, {R}) END AS max_pct_diff,
       CASE WHEN isfinite(median_pct_diff) THEN round(median_pct_diff, {R}) END AS median_pct_diff,
       CAST(first_flagged AS VARCHAR) AS first_flagged, CAST(last_flagged AS VARCHAR) AS last_flagged,
       CAST(first_compared AS VARCHAR) AS first_compared, CAST(last_compared AS VARCHAR) AS last_compared,
       round(flagged_pct, {R})::DOUBLE AS flagged_pct"""
q("reconcile_by_ticker", f"SELECT {_PROFILE_COLS} FROM profile ORDER BY rows_flagged DESC, ticker")
q("discrepancy_shape", f"""
SELECT ticker, rows_flagged, CASE WHEN isfinite(max_pct_diff) THEN round(max_pct_diff, {R}) END AS max_pct_diff,
       CASE WHEN isfinite(median_pct_diff) THEN round(median_pct_diff, {R}) END AS median_pct_diff,
       CAST(first_flagged AS VARCHAR) AS first_flagged, CAST(last_flagged AS VARCHAR) AS last_flagged,
       CASE WHEN rows_flagged = 0 THEN 'none'
            WHEN max_pct_diff > 10.0 * median_pct_diff THEN 'event' ELSE 'constant' END AS shape,
       CASE WHEN rows_flagged > 0 THEN last_flagged = last_compared END AS window_reaches_end
FROM profile
""")
q("reconcile_top", f"""
SELECT ticker, CAST(date AS VARCHAR) AS date, round(primary_adj_close, {R}) AS primary_adj_close,
       round(secondary_adj_close, {R}) AS secondary_adj_close, round(abs_diff, {R}) AS abs_diff,
       CASE WHEN isfinite(pct_diff) THEN round(pct_diff, {R}) END AS pct_diff, flagged
FROM pairs p WHERE p.flagged ORDER BY p.pct_diff DESC NULLS LAST, p.ticker, p.date LIMIT 10
""")
q("reconcile_summary", f"""
SELECT t.total_compared, t.flagged_count,
       round(coalesce(t.flagged_count * 100.0 / nullif(t.total_compared, 0), 0.0), {R})::DOUBLE AS flagged_pct,
       t.primary_only_count, t.secondary_only_count,
       a.tickers_affected, a.tickers_compared
FROM totals t,
     (SELECT count(*) FILTER (WHERE rows_flagged > 0) AS tickers_affected,
             count(*) AS tickers_compared FROM profile) a
""")
q("consensus", f"""
SELECT ticker, CAST(date AS VARCHAR) AS date,
       round(CASE WHEN _merge = 'right_only' THEN secondary_adj_close ELSE primary_adj_close END, {R}) AS adj_close,
       CASE WHEN _merge = 'right_only' THEN 'secondary' ELSE 'primary' END AS primary_source,
       CASE WHEN _merge = 'both' THEN 'primary,secondary'
            WHEN _merge = 'left_only' THEN 'primary' ELSE 'secondary' END AS sources_available,
       CASE WHEN isfinite(CASE WHEN _merge = 'both' THEN CASE WHEN primary_adj_close + secondary_adj_close = 0
                       THEN CASE WHEN primary_adj_close <> secondary_adj_close THEN 'Infinity'::DOUBLE END
                       ELSE abs(primary_adj_close - secondary_adj_close)
                            / ((primary_adj_close + secondary_adj_close) / 2) END END) THEN round(CASE WHEN _merge = 'both' THEN CASE WHEN primary_adj_close + secondary_adj_close = 0
                       THEN CASE WHEN primary_adj_close <> secondary_adj_close THEN 'Infinity'::DOUBLE END
                       ELSE abs(primary_adj_close - secondary_adj_close)
                            / ((primary_adj_close + secondary_adj_close) / 2) END END, {R}) END AS pct_diff,
       CASE WHEN _merge <> 'both' THEN 'single_source'
            WHEN coalesce(CASE WHEN (primary_adj_close + secondary_adj_close) / 2 = 0
                               THEN abs(primary_adj_close - secondary_adj_close) > 0
                               ELSE abs(primary_adj_close - secondary_adj_close)
                                    / ((primary_adj_close + secondary_adj_close) / 2) > 0.005 END, false)
            THEN 'disagreed' ELSE 'agreed' END AS reconciliation_flag
FROM matched
""")

view("day_no", """
SELECT date, row_number() OVER (ORDER BY date) AS day_no
FROM (SELECT date FROM primary_silver UNION SELECT date FROM secondary_silver) d
""")
view("signed", """
SELECT ticker, date, flagged, pct_diff,
       CASE WHEN primary_adj_close + secondary_adj_close <> 0
            THEN (primary_adj_close - secondary_adj_close) / ((primary_adj_close + secondary_adj_close) / 2) END AS x
FROM pairs
""")
view("flagged_days", """
SELECT *, CASE WHEN coalesce(day_no - lag(day_no) OVER (PARTITION BY ticker ORDER BY day_no) > 1, true) THEN 1 ELSE 0 END AS begins
FROM (SELECT s.*, d.day_no, min(d.day_no) OVER t AS first_no, max(d.day_no) OVER t AS last_no,
             avg(CASE WHEN NOT s.flagged THEN s.x END) OVER t AS outside
      FROM signed s JOIN day_no d USING (date) WINDOW t AS (PARTITION BY s.ticker)) y
WHERE flagged
""")
q("discrepancy_events", f"""
SELECT ticker, CAST(event_no AS BIGINT) AS event_no, CAST(min(date) AS VARCHAR) AS start, CAST(max(date) AS VARCHAR) AS "end",
       count(*) AS days_flagged, CAST(max(day_no) - min(day_no) + 1 AS BIGINT) AS days_spanned,
       CASE WHEN isfinite(max(pct_diff)) THEN round(max(pct_diff), {R}) END AS max_pct_diff, round(avg(x), {R}) AS mean_diff,
       round(avg(x) - min(outside), {R}) AS mean_shift,
       CASE WHEN min(day_no) = min(first_no) AND max(day_no) = min(last_no) THEN 'constant' WHEN min(day_no) = min(first_no) THEN 'until'
            WHEN max(day_no) = min(last_no) THEN 'since' ELSE 'window' END AS kind
FROM (SELECT *, sum(begins) OVER (PARTITION BY ticker ORDER BY day_no ROWS UNBOUNDED PRECEDING) AS event_no FROM flagged_days) z
GROUP BY ticker, event_no
""")
_PAY = 4 * 0.005 * 0.005
q("discrepancy_segments", f"""
WITH series AS (
  SELECT ticker, list(x ORDER BY date) AS xs, list(date ORDER BY date) AS ds, count(*) AS n FROM signed WHERE x IS NOT NULL GROUP BY ticker),
sums AS (
  SELECT *, list_transform(range(0, n + 1), lambda k: coalesce(list_sum(xs[1:k]), 0.0)) AS s1,
         list_transform(range(0, n + 1), lambda k: coalesce(list_sum(list_transform(xs[1:k], lambda v: v * v)), 0.0)) AS s2 FROM series),
best_of AS (
  SELECT ticker, CAST(0 AS BIGINT) AS j, [CAST(0.0 AS DOUBLE)] AS best, [CAST(0 AS BIGINT)] AS back FROM sums
  UNION ALL
  SELECT ticker, j + 1, list_append(best, list_min(c)), list_append(back, CAST(list_position(c, list_min(c)) - 1 AS BIGINT))
  FROM (SELECT b.*, list_transform(range(0, b.j + 1), lambda i: b.best[i + 1] + (s.s2[b.j + 2] - s.s2[i + 1]
                 - (s.s1[b.j + 2] - s.s1[i + 1]) * (s.s1[b.j + 2] - s.s1[i + 1]) / (b.j + 1 - i)) + {_PAY}) AS c
        FROM best_of b JOIN sums s ON s.ticker = b.ticker WHERE b.j < s.n) t),
cuts AS (
  SELECT s.ticker, b.back, s.n AS hi, b.back[s.n + 1] AS lo FROM sums s JOIN best_of b ON b.ticker = s.ticker AND b.j = s.n
  UNION ALL SELECT ticker, back, lo, back[lo + 1] FROM cuts WHERE lo > 0),
levels AS (
  SELECT c.ticker, row_number() OVER (PARTITION BY c.ticker ORDER BY c.lo) AS segment_no, s.ds[c.lo + 1] AS start, s.ds[c.hi] AS "end",
         c.hi - c.lo AS days, list_avg(s.xs[c.lo + 1:c.hi]) AS mean_diff
  FROM cuts c JOIN sums s ON s.ticker = c.ticker)
SELECT ticker, segment_no, CAST(start AS VARCHAR) AS start, CAST("end" AS VARCHAR) AS "end", CAST(days AS BIGINT) AS days,
       round(mean_diff, {R}) AS mean_diff, round(mean_diff - lag(mean_diff) OVER (PARTITION BY ticker ORDER BY segment_no), {R}) AS shift,
       CASE WHEN abs(mean_diff) <= 0.005 THEN 'agreement' ELSE 'offset' END AS kind
FROM levels
""")
SQL["discrepancy_segments"] = SQL["discrepancy_segments"].replace("WITH", "WITH RECURSIVE", 1)

# ---- quality gate -------------------------------------------------------
view("constituents", """
SELECT 'U' || lpad(CAST(c.c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c.c_custkey AS VARCHAR))) AS INTEGER), '0') AS ticker,
       'Acme ' || CAST(c.c_custkey AS VARCHAR) ||
         CASE c.c_custkey % 4 WHEN 0 THEN ' Inc.' WHEN 1 THEN ', Corp' WHEN 2 THEN ' plc' ELSE ' Class A' END
         AS company_name,
       c.c_mktsegment AS gics_sector, n.n_name AS gics_sub_industry,
       DATE '1990-01-01' + CAST(c.c_custkey * 7 AS INTEGER) AS date_added,
       DATE '2024-01-31' AS snapshot_date, c.c_custkey
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
view("identifiers", """
SELECT ticker, 'BBG' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS figi,
       'BBC' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS composite_figi,
       CAST(NULL AS VARCHAR) AS share_class_figi, 'ACME ' || CAST(c_custkey AS VARCHAR) AS name,
       'Common Stock' AS security_type, 'Equity' AS market_sector, c_custkey
FROM constituents WHERE c_custkey % 13 <> 0
""")
view("macro", """
SELECT CAST(ts AS DATE) AS date,
       CASE event_type WHEN 'click' THEN 'DGS3MO' WHEN 'view' THEN 'DGS10'
            WHEN 'purchase' THEN 'FEDFUNDS' WHEN 'signup' THEN 'CPIAUCSL'
            ELSE upper(event_type) END AS series_id,
       avg(value) AS value
FROM events GROUP BY 1, 2
""")

# (name, unexpected, evaluated, mostly) per price rule
_PRICE_CHECKS = [
    ("ticker not null", "count(*) FILTER (WHERE ticker IS NULL)", "count(*)", "1.0"),
    ("date not null", "count(*) FILTER (WHERE date IS NULL)", "count(*)", "1.0"),
    ("close not null", "count(*) FILTER (WHERE close IS NULL)", "count(*)", "1.0"),
    ("close > 0", "count(*) FILTER (WHERE close <= 0)", "count(close)", "1.0"),
    ("open > 0", "count(*) FILTER (WHERE open <= 0)", "count(open)", "1.0"),
    ("adj_close > 0", "count(*) FILTER (WHERE adj_close <= 0)", "count(adj_close)", "1.0"),
    ("volume >= 0", "count(*) FILTER (WHERE volume < 0)", "count(volume)", "1.0"),
]
for _nm, _a, _b in [("high >= low", "high", "low"), ("high >= open", "high", "open"),
                    ("high >= close", "high", "close"), ("low <= open", "open", "low"),
                    ("low <= close", "close", "low")]:
    _PRICE_CHECKS.append((
        _nm,
        f"count(*) FILTER (WHERE ({_a} IS NOT NULL OR {_b} IS NOT NULL) AND NOT coalesce({_a} >= {_b}, false))",
        f"count(*) FILTER (WHERE {_a} IS NOT NULL OR {_b} IS NOT NULL)", "0.9999"))


def _check_rows(source: str, table: str, checks, uniques=(), band=None) -> str:
    parts = []
    for nm, u, e, mostly in checks:
        parts.append(f"""SELECT '{source}' AS source, '{nm}' AS check_name,
       (e = 0 OR (e - u) / e >= {mostly}) AS success, CAST(u AS BIGINT) AS unexpected_count,
       CAST(e AS BIGINT) AS element_count
FROM (SELECT {u} AS u, {e} AS e FROM {table}) x""")
    for nm, cols in uniques:
        some = " OR ".join(f"{c} IS NOT NULL" for c in cols)
        parts.append(f"""SELECT '{source}' AS source, '{nm}' AS check_name,
       (e = 0 OR (e - u) / e >= 1.0) AS success, CAST(u AS BIGINT) AS unexpected_count,
       CAST(e AS BIGINT) AS element_count
FROM (SELECT coalesce(sum(c) FILTER (WHERE c > 1), 0) AS u, coalesce(sum(c), 0) AS e
      FROM (SELECT count(*) AS c FROM {table} WHERE {some} GROUP BY {', '.join(cols)}) g) x""")
    if band:
        parts.append(f"""SELECT '{source}' AS source, 'row count in [{band[0]}, {band[1]}]' AS check_name,
       count(*) BETWEEN {band[0]} AND {band[1]} AS success,
       CAST(CASE WHEN count(*) BETWEEN {band[0]} AND {band[1]} THEN 0 ELSE 1 END AS BIGINT) AS unexpected_count,
       count(*) AS element_count FROM {table}""")
    return "\nUNION ALL\n".join(parts)


_PRICE_Q = (_check_rows("primary", "primary_landed", _PRICE_CHECKS, [("(ticker, date) unique", ["ticker", "date"])])
            + "\nUNION ALL\n"
            + _check_rows("secondary", "secondary_bronze", _PRICE_CHECKS, [("(ticker, date) unique", ["ticker", "date"])]))
_CONST_Q = _check_rows("constituents", "constituents",
                       [("ticker not null", "count(*) FILTER (WHERE ticker IS NULL)", "count(*)", "1.0"),
                        ("gics_sector not null", "count(*) FILTER (WHERE gics_sector IS NULL)", "count(*)", "1.0")],
                       [("ticker unique", ["ticker"])], band=(480, 520))
_IDENT_Q = _check_rows("identifiers", "identifiers",
                       [("figi not null", "count(*) FILTER (WHERE figi IS NULL)", "count(*)", "1.0"),
                        ("figi is 12 characters", "count(*) FILTER (WHERE length(figi) <> 12)", "count(figi)", "1.0")],
                       [("figi unique", ["figi"]), ("ticker unique", ["ticker"])])
_MACRO_Q = """
SELECT 'macro:' || series_id AS source, 'value not null' AS check_name, nulls = 0 AS success,
       CAST(nulls AS BIGINT) AS unexpected_count, CAST(n AS BIGINT) AS element_count
FROM (SELECT series_id, count(*) AS n, count(*) FILTER (WHERE value IS NULL) AS nulls FROM macro GROUP BY 1) a
UNION ALL
SELECT 'macro:' || series_id AS source,
       CASE WHEN series_id = 'CPIAUCSL' THEN 'value > 0 (index level)'
            ELSE 'value in plausible rate range [0, 25]' END AS check_name,
       bad = 0 AS success, CAST(bad AS BIGINT) AS unexpected_count, CAST(ev AS BIGINT) AS element_count
FROM (SELECT series_id, count(value) AS ev,
             CASE WHEN series_id = 'CPIAUCSL' THEN count(*) FILTER (WHERE value <= 0)
                  ELSE count(*) FILTER (WHERE value < 0 OR value > 25) END AS bad
      FROM macro GROUP BY 1) b
"""

q("quality_prices", _PRICE_Q)
q("quality_constituents", _CONST_Q)
q("quality_identifiers", _IDENT_Q)
q("quality_macro", _MACRO_Q)
q("quality_rollup", f"""
SELECT source, bool_and(success) AS passed, count(*) AS checks,
       count(*) FILTER (WHERE NOT success) AS failed_checks
FROM ({_CONST_Q}
UNION ALL
{_PRICE_Q}
UNION ALL
{_MACRO_Q}
UNION ALL
{_IDENT_Q}) r
GROUP BY source
""")
q("ohlc_violations", f"""
SELECT source, ticker, CAST(date AS VARCHAR) AS date, round(open, {R}) AS open, round(high, {R}) AS high,
       round(low, {R}) AS low, round(close, {R}) AS close, round(adj_close, {R}) AS adj_close,
       CAST(volume AS BIGINT) AS volume, violation
FROM (SELECT 'primary' AS source, ticker, date, open, high, low, close, adj_close, volume FROM primary_bronze
      UNION ALL
      SELECT 'secondary', ticker, date, open, high, low, close, adj_close, volume FROM secondary_bronze) b,
     (VALUES ('low > open'), ('low > close'), ('low > high'), ('high < open'), ('high < close')) r(violation)
WHERE (violation = 'low > open' AND low > open) OR (violation = 'low > close' AND low > close)
   OR (violation = 'low > high' AND low > high) OR (violation = 'high < open' AND high < open)
   OR (violation = 'high < close' AND high < close)
""")

# ---- gold dimensions ----------------------------------------------------
view("trading_days", "SELECT DISTINCT date FROM primary_silver")
_DIM_DATE_COLS = """CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS VARCHAR) AS date,
       CAST(year(d) AS BIGINT) AS year, CAST(quarter(d) AS BIGINT) AS quarter,
       CAST(month(d) AS BIGINT) AS month, monthname(d) AS month_name, CAST(day(d) AS BIGINT) AS day,
       CAST(isodow(d) - 1 AS BIGINT) AS day_of_week, dayname(d) AS day_name,
       isodow(d) - 1 < 5 AS is_weekday"""
view("dim_date", f"""
SELECT {_DIM_DATE_COLS}, t.date IS NOT NULL AS is_trading_day
FROM (SELECT CAST(range AS DATE) AS d FROM range((SELECT min(CAST(ts AS DATE)) + 1 FROM events), (SELECT max(CAST(ts AS DATE)) + 1 FROM events), INTERVAL 1 DAY)) c
LEFT JOIN trading_days t ON t.date = c.d
""")
q("trading_days", "SELECT CAST(date AS VARCHAR) AS date FROM trading_days")
q("dim_date", "SELECT * FROM dim_date")
q("dim_date_refresh", f"""
SELECT {_DIM_DATE_COLS},
       CASE WHEN d >= DATE '2024-01-10' THEN d IN (SELECT date FROM primary_silver)
            ELSE d IN (SELECT date FROM secondary_silver) END AS is_trading_day
FROM (SELECT CAST(range AS DATE) AS d FROM range((SELECT min(CAST(ts AS DATE)) + 1 FROM events), (SELECT max(CAST(ts AS DATE)) + 1 FROM events), INTERVAL 1 DAY)) c
""")
view("scd_snap", """
SELECT 'U' || lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(6, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0') AS ticker,
       make_date(CAST(yr AS BIGINT), 1, 1) AS snapshot_date,
       'Acme U' || lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(6, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0') AS company_name,
       attribute AS gics_sector
FROM (SELECT o_custkey, year(o_orderdate) AS yr,
             arg_max(o_orderpriority, o_orderdate::VARCHAR || '#' || lpad(CAST(o_orderkey AS VARCHAR), 20, '0')) AS attribute
      FROM orders GROUP BY 1, 2) x
""")
view("scd_idx", """
SELECT snapshot_date, row_number() OVER (ORDER BY snapshot_date) AS idx,
       lead(snapshot_date) OVER (ORDER BY snapshot_date) AS next_snapshot
FROM (SELECT DISTINCT snapshot_date FROM scd_snap) d
""")
view("scd_tr", """
SELECT s.*, i.idx, i.next_snapshot,
       lag(i.idx) OVER w AS prev_idx, lag(s.gics_sector) OVER w AS prev_sector,
       lag(s.company_name) OVER w AS prev_name, lead(i.idx) OVER w AS next_idx
FROM scd_snap s JOIN scd_idx i USING (snapshot_date)
WINDOW w AS (PARTITION BY s.ticker ORDER BY i.idx)
""")
view("scd_tr2", """
SELECT *, CASE WHEN prev_idx IS NULL THEN 'first_seen' WHEN prev_idx <> idx - 1 THEN 'returned'
               WHEN prev_sector IS DISTINCT FROM gics_sector OR prev_name IS DISTINCT FROM company_name
               THEN 'changed' ELSE 'unchanged' END AS transition
FROM scd_tr
""")
view("scd_hist", """
SELECT v.ticker, v.company_name, v.gics_sector, v.effective_from, i.next_snapshot AS effective_to
FROM (SELECT ticker, company_name, gics_sector, min(snapshot_date) AS effective_from, max(idx) AS last_idx
      FROM (SELECT *, sum(CASE WHEN transition <> 'unchanged' THEN 1 ELSE 0 END)
                        OVER (PARTITION BY ticker ORDER BY idx ROWS UNBOUNDED PRECEDING) AS ver
            FROM scd_tr2) x
      GROUP BY ticker, ver, company_name, gics_sector) v
JOIN scd_idx i ON i.idx = v.last_idx
""")
_SCD_COLS = """CAST(row_number() OVER (ORDER BY effective_from, ticker) AS BIGINT) AS security_key, ticker,
       company_name, gics_sector, CAST(NULL AS VARCHAR) AS gics_sub_industry, CAST(NULL AS VARCHAR) AS figi,
       CAST(effective_from AS VARCHAR) AS effective_from, CAST(effective_to AS VARCHAR) AS effective_to,
       effective_to IS NULL AS is_current"""
q("scd2_history", f"SELECT {_SCD_COLS} FROM scd_hist")
q("scd2_apply_snapshot", f"SELECT {_SCD_COLS} FROM scd_hist")
q("scd2_summary", """
SELECT CAST(p.snapshot_date AS VARCHAR) AS snapshot_date, p.new, p.changed,
       CAST(coalesce(c.closed, 0) AS BIGINT) AS closed, p.unchanged, p.returned
FROM (SELECT snapshot_date,
             count(*) FILTER (WHERE transition IN ('first_seen', 'returned')) AS new,
             count(*) FILTER (WHERE transition = 'changed') AS changed,
             count(*) FILTER (WHERE transition = 'unchanged') AS unchanged,
             count(*) FILTER (WHERE transition = 'returned') AS returned
      FROM scd_tr2 GROUP BY 1) p
LEFT JOIN (SELECT next_snapshot AS snapshot_date, count(*) AS closed FROM scd_tr2
           WHERE next_snapshot IS NOT NULL AND (next_idx IS NULL OR next_idx <> idx + 1)
           GROUP BY 1) c USING (snapshot_date)
""")
q("scd2_invariants", """
SELECT 'one current row per ticker' AS check_name,
       CAST((SELECT count(*) FROM (SELECT ticker FROM scd_hist WHERE effective_to IS NULL
                                   GROUP BY 1 HAVING count(*) > 1)) AS BIGINT) AS violations
UNION ALL
SELECT 'unique (ticker, effective_from)',
       CAST((SELECT count(*) FROM (SELECT 1 FROM scd_hist GROUP BY ticker, effective_from
                                   HAVING count(*) > 1)) AS BIGINT)
UNION ALL
SELECT 'no overlapping intervals',
       CAST((SELECT count(*) FROM (SELECT effective_to, lead(effective_from) OVER
                                     (PARTITION BY ticker ORDER BY effective_from) AS nf FROM scd_hist) x
             WHERE nf IS NOT NULL AND (effective_to IS NULL OR effective_to > nf)) AS BIGINT)
UNION ALL
SELECT 'effective_to after effective_from',
       CAST((SELECT count(*) FROM scd_hist WHERE effective_to <= effective_from) AS BIGINT)
""")

# ---- gold facts ---------------------------------------------------------
view("dim_security", """
SELECT CAST(row_number() OVER (ORDER BY c.ticker) AS BIGINT) AS security_key, c.ticker,
       c.company_name, c.gics_sector, c.gics_sub_industry, i.figi
FROM constituents c LEFT JOIN identifiers i ON i.ticker = c.ticker
""")
view("dd_keys", "SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS date FROM "
                "(SELECT CAST(range AS DATE) AS d FROM range((SELECT min(CAST(ts AS DATE)) + 1 FROM events), (SELECT max(CAST(ts AS DATE)) + 1 FROM events), INTERVAL 1 DAY))")
_P6 = "round(CAST(CAST(CAST({c} AS VARCHAR) AS DECIMAL(18,6)) AS DOUBLE), 9) AS {c}"
_PRICE_FACT = ", ".join(_P6.format(c=c) for c in
                        ["open", "high", "low", "close", "adj_open", "adj_high", "adj_low", "adj_close"])
view("f_price", f"""
SELECT k.security_key, d.date_key, src.source, {_PRICE_FACT},
       CAST(volume AS BIGINT) AS volume, CAST(adj_volume AS BIGINT) AS adj_volume
FROM (SELECT 'primary' AS source, * FROM primary_silver
      UNION ALL SELECT 'secondary' AS source, * FROM secondary_silver) src
JOIN dd_keys d ON d.date = src.date JOIN dim_security k ON k.ticker = src.ticker
""")
view("consensus_rows", """
SELECT ticker, date,
       CASE WHEN _merge = 'right_only' THEN secondary_adj_close ELSE primary_adj_close END AS adj_close,
       CASE WHEN _merge = 'right_only' THEN 'secondary' ELSE 'primary' END AS primary_source,
       CASE WHEN _merge = 'both' THEN 'primary,secondary'
            WHEN _merge = 'left_only' THEN 'primary' ELSE 'secondary' END AS sources_available,
       CASE WHEN _merge = 'both' THEN CASE WHEN primary_adj_close + secondary_adj_close = 0
                       THEN CASE WHEN primary_adj_close <> secondary_adj_close THEN 'Infinity'::DOUBLE END
                       ELSE abs(primary_adj_close - secondary_adj_close)
                            / ((primary_adj_close + secondary_adj_close) / 2) END END AS pct_diff,
       CASE WHEN _merge <> 'both' THEN 'single_source'
            WHEN coalesce(CASE WHEN (primary_adj_close + secondary_adj_close) / 2 = 0
                               THEN abs(primary_adj_close - secondary_adj_close) > 0
                               ELSE abs(primary_adj_close - secondary_adj_close)
                                    / ((primary_adj_close + secondary_adj_close) / 2) > 0.005 END, false)
            THEN 'disagreed' ELSE 'agreed' END AS reconciliation_flag
FROM matched
""")
view("landed_consensus", """
SELECT ticker, date,
       CASE WHEN _merge = 'right_only' THEN secondary_adj_close ELSE primary_adj_close END AS adj_close,
       CASE WHEN _merge = 'right_only' THEN 'secondary' ELSE 'primary' END AS primary_source,
       CASE WHEN _merge = 'both' THEN 'primary,secondary'
            WHEN _merge = 'left_only' THEN 'primary' ELSE 'secondary' END AS sources_available,
       CASE WHEN _merge = 'both' THEN CASE WHEN primary_adj_close + secondary_adj_close = 0
                       THEN CASE WHEN primary_adj_close <> secondary_adj_close THEN 'Infinity'::DOUBLE END
                       ELSE abs(primary_adj_close - secondary_adj_close)
                            / ((primary_adj_close + secondary_adj_close) / 2) END END AS pct_diff,
       CASE WHEN _merge <> 'both' THEN 'single_source'
            WHEN coalesce(CASE WHEN (primary_adj_close + secondary_adj_close) / 2 = 0
                               THEN abs(primary_adj_close - secondary_adj_close) > 0
                               ELSE abs(primary_adj_close - secondary_adj_close)
                                    / ((primary_adj_close + secondary_adj_close) / 2) > 0.005 END, false)
            THEN 'disagreed' ELSE 'agreed' END AS reconciliation_flag
FROM landed_matched
""")
view("f_consensus", """
SELECT k.security_key, d.date_key, round(CAST(CAST(CAST(c.adj_close AS VARCHAR) AS DECIMAL(18,6)) AS DOUBLE), 9) AS adj_close,
       c.primary_source, c.sources_available,
       round(CAST(CAST(CAST(CASE WHEN isfinite(c.pct_diff) THEN c.pct_diff END AS VARCHAR) AS DECIMAL(9,6)) AS DOUBLE), 9) AS pct_diff, c.reconciliation_flag
FROM consensus_rows c JOIN dd_keys d ON d.date = c.date JOIN dim_security k ON k.ticker = c.ticker
""")
view("g_price", f"""
SELECT k.security_key, d.date_key, src.source, {_PRICE_FACT},
       CAST(volume AS BIGINT) AS volume, CAST(adj_volume AS BIGINT) AS adj_volume
FROM (SELECT 'primary' AS source, * FROM landed_silver
      UNION ALL SELECT 'secondary' AS source, * FROM secondary_silver) src
JOIN dd_keys d ON d.date = src.date JOIN dim_security k ON k.ticker = src.ticker
""")
view("g_consensus", """
SELECT k.security_key, d.date_key, round(CAST(CAST(CAST(c.adj_close AS VARCHAR) AS DECIMAL(18,6)) AS DOUBLE), 9) AS adj_close,
       c.primary_source, c.sources_available,
       round(CAST(CAST(CAST(CASE WHEN isfinite(c.pct_diff) THEN c.pct_diff END AS VARCHAR) AS DECIMAL(9,6)) AS DOUBLE), 9) AS pct_diff, c.reconciliation_flag
FROM landed_consensus c JOIN dd_keys d ON d.date = c.date JOIN dim_security k ON k.ticker = c.ticker
""")
view("actions", """
SELECT ticker, date, action_type, value FROM (
  SELECT ticker, date, 'dividend' AS action_type, dividends AS value FROM primary_bronze
  UNION ALL SELECT ticker, date, 'split', stock_splits FROM primary_bronze) a
WHERE coalesce(value, 0) <> 0
""")
view("f_action", """
SELECT k.security_key, d.date_key, a.action_type,
       round(CAST(CAST(CAST(a.value AS VARCHAR) AS DECIMAL(18,6)) AS DOUBLE), 9) AS value, 'primary' AS source
FROM actions a JOIN dd_keys d ON d.date = a.date JOIN dim_security k ON k.ticker = a.ticker
""")
view("f_macro", """
SELECT d.date_key, m.series_id, round(CAST(CAST(CAST(m.value AS VARCHAR) AS DECIMAL(18,6)) AS DOUBLE), 9) AS value
FROM macro m JOIN dd_keys d ON d.date = m.date
""")
q("fact_price_daily", "SELECT * FROM f_price")
q("fact_consensus", "SELECT * FROM f_consensus")
q("fact_corporate_action", "SELECT * FROM f_action")
q("fact_macro_rate", "SELECT * FROM f_macro")

# ---- quantiles and totals of the reconciliation ----
view("finite_pairs", """
SELECT p.pct_diff, coalesce(k.gics_sector, 'none') AS sector FROM pairs p LEFT JOIN constituents k ON k.ticker = p.ticker
WHERE pct_diff IS NOT NULL AND NOT isnan(pct_diff)
""")
_Q = [0.01, 0.25, 0.5, 0.75, 0.9, 0.99]
q("pct_diff_quantiles", "\nUNION ALL\n".join(
    f"SELECT {g} AS grp, CAST({p} AS DOUBLE) AS p, CASE WHEN isfinite(quantile_cont(pct_diff, {p})) THEN round(quantile_cont(pct_diff, {p}), {R}) END AS quantile, count(pct_diff) AS n "
    f"FROM finite_pairs GROUP BY {g}" for g in ("'universe'", "sector") for p in _Q))
q("coverage_rollup", f"""
SELECT sector, ticker, CAST(month AS VARCHAR) AS month, outcome, CAST(GROUPING(sector, ticker, month, outcome) AS BIGINT) AS grouping_id,
       count(*) AS bars, round(avg(CASE WHEN isfinite(pct_diff) THEN pct_diff END), {R}) AS mean_pct_diff
FROM (SELECT c.ticker, CAST(date_trunc('month', c.date) AS DATE) AS month, c.reconciliation_flag AS outcome, c.pct_diff, k.gics_sector AS sector
      FROM consensus_rows c LEFT JOIN constituents k ON k.ticker = c.ticker) x
GROUP BY GROUPING SETS ((sector, ticker, month, outcome), (sector, ticker, outcome), (sector, month, outcome),
                        (sector, outcome), (month, outcome), (outcome), (sector), ())
""")

# point-in-time keys: the same history, over weekly snapshots
view("wk_snap", """
SELECT 'U' || lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(6, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0') AS ticker,
       DATE '2024-01-01' + CAST(7 * wk AS INTEGER) AS snapshot_date,
       'Acme U' || lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(6, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0') AS company_name,
       attribute AS gics_sector
FROM (SELECT o_custkey, o_orderkey % 5 AS wk,
             arg_max(o_orderpriority, o_orderdate::VARCHAR || '#' || lpad(CAST(o_orderkey AS VARCHAR), 20, '0')) AS attribute
      FROM orders GROUP BY 1, 2) x
""")
for _v in ("scd_idx", "scd_tr", "scd_tr2", "scd_hist"):
    view(_v.replace("scd_", "wk_"), VIEWS[_v].replace("scd_", "wk_"))
view("wk_security", """
SELECT CAST(row_number() OVER (ORDER BY effective_from, ticker) AS BIGINT) AS security_key, ticker, effective_from, effective_to
FROM wk_hist
""")
view("wk_bars", """
SELECT b.*, v.security_key AS last_key, v.effective_to
FROM (SELECT 'primary' AS source, * FROM primary_silver UNION ALL SELECT 'secondary' AS source, * FROM secondary_silver) b
ASOF LEFT JOIN wk_security v ON b.ticker = v.ticker AND b.date >= v.effective_from
""")
q("fact_price_daily_as_of", f"""
SELECT last_key AS security_key, d.date_key, source, {_PRICE_FACT},
       CAST(volume AS BIGINT) AS volume, CAST(adj_volume AS BIGINT) AS adj_volume
FROM wk_bars b JOIN dd_keys d ON d.date = b.date
WHERE last_key IS NOT NULL AND (effective_to IS NULL OR b.date < effective_to)
""")
q("as_of_load_summary", """
SELECT source, key_status, count(*) AS bars, count(*) FILTER (WHERE date_key IS NULL) AS skipped_no_date_key,
       count(*) FILTER (WHERE date_key IS NOT NULL AND key_status = 'valid') AS loaded
FROM (SELECT b.source, d.date_key,
             CASE WHEN last_key IS NULL THEN CASE WHEN ticker IN (SELECT ticker FROM wk_security) THEN 'not yet' ELSE 'unknown' END
                  WHEN effective_to IS NULL OR b.date < effective_to THEN 'valid' ELSE 'gone' END AS key_status
      FROM wk_bars b LEFT JOIN dd_keys d ON d.date = b.date) x
GROUP BY 1, 2
""")


def _load(table: str, src: str, with_sec: bool = True) -> str:
    sk = "k.security_key IS NULL" if with_sec else "false"
    join_sec = "LEFT JOIN dim_security k ON k.ticker = s.ticker" if with_sec else ""
    return f"""SELECT '{table}' AS "table",
       count(*) FILTER (WHERE d.date_key IS NOT NULL AND NOT ({sk})) AS loaded,
       count(*) FILTER (WHERE {sk}) AS skipped_no_security_key,
       count(*) FILTER (WHERE d.date_key IS NULL) AS skipped_no_date_key
FROM ({src}) s LEFT JOIN dd_keys d ON d.date = s.date {join_sec}"""


q("load_summary", "\nUNION ALL\n".join([
    _load("fact_price_daily:primary", "SELECT ticker, date FROM landed_silver"),
    _load("fact_price_daily:secondary", "SELECT ticker, date FROM secondary_silver"),
    _load("fact_price_daily_consensus", "SELECT ticker, date FROM landed_consensus"),
    _load("fact_corporate_action", "SELECT ticker, date FROM actions"),
    _load("fact_macro_rate", "SELECT date FROM macro", with_sec=False),
]))


def _orph(table: str, src: str, with_sec: bool = True) -> str:
    s = f"""SELECT '{table}' AS "table", 'date_key' AS fk,
       (SELECT count(*) FROM {src} f WHERE f.date_key NOT IN (SELECT date_key FROM dd_keys WHERE date_key % 10 <> 0)) AS orphans"""
    if with_sec:
        s += f"""
UNION ALL SELECT '{table}', 'security_key',
       (SELECT count(*) FROM {src} f WHERE f.security_key NOT IN (SELECT security_key FROM dim_security WHERE security_key % 7 <> 0))"""
    return s


q("fk_orphans", "\nUNION ALL\n".join([
    _orph("fact_price_daily", "g_price"), _orph("fact_price_daily_consensus", "g_consensus"),
    _orph("fact_corporate_action", "f_action"), _orph("fact_macro_rate", "f_macro", False)]))


def _pk(table: str, src: str, keys: str) -> str:
    again = "security_key % 10 = 0" if table == "dim_security" else "date_key % 100 >= 10"
    return f"""SELECT '{table}' AS "table",
       (SELECT count(*) FROM (SELECT 1 FROM (SELECT * FROM {src} UNION ALL SELECT * FROM {src} WHERE {again}) u
                              GROUP BY {keys} HAVING count(*) > 1)) AS duplicate_keys"""


q("pk_duplicates", "\nUNION ALL\n".join([
    _pk("dim_date", "dd_keys", "date_key"), _pk("dim_security", "dim_security", "security_key"),
    _pk("fact_price_daily", "g_price", "security_key, date_key, source"),
    _pk("fact_price_daily_consensus", "g_consensus", "security_key, date_key"),
    _pk("fact_corporate_action", "f_action", "security_key, date_key, action_type, source"),
    _pk("fact_macro_rate", "f_macro", "date_key, series_id")]))

view("fresh_s", "SELECT count(*) AS securities FROM dim_security")
view("fresh_c", "SELECT count(*) AS n, max(d.date) AS max_date FROM f_consensus f JOIN dd_keys d USING (date_key)")
q("freshness_gate", f"""
SELECT 'security count >= 400' AS check_name, s.securities >= 400 AS passed,
       CAST(s.securities AS DOUBLE) AS observed FROM fresh_s s
UNION ALL
SELECT 'consensus rows/security >= 200', coalesce(c.n / s.securities, 0.0) >= 200,
       round(coalesce(c.n / s.securities, 0.0), {R}) FROM fresh_s s, fresh_c c
UNION ALL
SELECT 'latest data within 5 days of ingest_date',
       coalesce(DATE '2024-01-31' - c.max_date BETWEEN 0 AND 5, false),
       CAST(DATE '2024-01-31' - c.max_date AS DOUBLE) FROM fresh_c c
""")
q("gold_build_counts", """
SELECT 'dim_date' AS "table", (SELECT count(*) FROM dd_keys) AS rows
UNION ALL SELECT 'dim_security', (SELECT count(*) FROM dim_security)
UNION ALL SELECT 'fact_price_daily', (SELECT count(*) FROM g_price)
UNION ALL SELECT 'fact_price_daily_consensus', (SELECT count(*) FROM g_consensus)
UNION ALL SELECT 'fact_corporate_action', (SELECT count(*) FROM f_action)
UNION ALL SELECT 'fact_macro_rate', (SELECT count(*) FROM f_macro)
""")

# ---- landed payloads ----------------------------------------------------
view("holdings", """
SELECT 'ACME ' || CAST(c_custkey AS VARCHAR) ||
         CASE c_custkey % 3 WHEN 0 THEN ' INCORPORATED' WHEN 1 THEN ' Holdings' ELSE ' LTD' END AS name,
       'acme ' || CAST(c_custkey AS VARCHAR) || ' class b' AS title,
       lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS cusip,
       CASE WHEN c_custkey % 7 = 3 THEN NULL ELSE 'US' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS isin,
       CASE WHEN c_custkey % 5 = 4 THEN 'STIV' ELSE 'EC' END AS asset_cat,
       c_acctbal / 1000.0 AS pct_val, c_acctbal AS val_usd, c_custkey AS holding_key
FROM customer
WHERE c_custkey % 19 <> 0
""")
q("price_payload_json", f"""
SELECT CAST(date AS VARCHAR) AS date, round(open, {R}) AS open, round(high, {R}) AS high, round(low, {R}) AS low,
       round(close, {R}) AS close, round(adj_close, {R}) AS adj_close, round(adj_open, {R}) AS adj_open,
       round(adj_high, {R}) AS adj_high, round(adj_low, {R}) AS adj_low,
       CAST(adj_volume AS BIGINT) AS adj_volume, CAST(volume AS BIGINT) AS volume, ticker
FROM secondary_bronze
""")
q("macro_payload_json", f"""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
       CASE event_type WHEN 'click' THEN 'DGS3MO' WHEN 'view' THEN 'DGS10'
            WHEN 'purchase' THEN 'FEDFUNDS' WHEN 'signup' THEN 'CPIAUCSL'
            ELSE upper(event_type) END AS series_id,
       round(value, {R}) AS value
FROM events WHERE event_id % 20 <> 0
""")
q("identifier_payload_zip", """
SELECT c.ticker, i.figi, i.composite_figi, i.share_class_figi, i.name, i.security_type, i.market_sector,
       CASE WHEN i.figi IS NULL THEN 'rejected' ELSE 'mapped' END AS status
FROM constituents c LEFT JOIN identifiers i ON i.ticker = c.ticker
""")
q("holdings_xml", f"""
SELECT name, title, cusip, isin, asset_cat, round(pct_val, {R}) AS pct_val, round(val_usd, {R}) AS val_usd,
       '2024-01-31' AS nport_filed_date
FROM holdings WHERE asset_cat = 'EC'
""")
q("holdings_xml_file", f"""
SELECT name, title, cusip, isin, asset_cat, round(pct_val, {R}) AS pct_val, round(val_usd, {R}) AS val_usd,
       '2024-01-31' AS nport_filed_date, 'parsed' AS status
FROM holdings WHERE asset_cat = 'EC' AND holding_key % 17 <> 4 AND holding_key % 19 <> 5
UNION ALL
SELECT NULL, NULL, cusip, NULL, NULL, NULL, NULL, NULL, 'malformed holding' FROM holdings WHERE holding_key % 17 = 4 OR holding_key % 19 = 5
""")
q("filing_index_pick", """
SELECT cik, replace(acc, '-', '') AS accession, CAST(d AS VARCHAR) AS filed_date
FROM (SELECT 'U' || lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(6, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0') AS cik, CAST(o_orderdate AS DATE) AS d,
             lpad(CAST(o_custkey AS VARCHAR), 10, '0') || '-' || strftime(CAST(o_orderdate AS DATE), '%y')
               || '-' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') AS acc,
             o_custkey
      FROM orders WHERE o_orderpriority = '1-URGENT') x
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC, acc DESC) = 1
""")
q("constituents_html", """
SELECT CASE WHEN c_custkey % 50 = 7 THEN ticker || '-B' ELSE ticker END AS ticker,
       company_name, gics_sector, gics_sub_industry,
       CASE WHEN c_custkey % 11 = 5 THEN NULL ELSE CAST(date_added AS VARCHAR) END AS date_added
FROM constituents
""")
q("wide_to_long_prices", f"""
SELECT ticker, CAST(date AS VARCHAR) AS date, round(open, {R}) AS open, round(high, {R}) AS high,
       round(low, {R}) AS low, round(close, {R}) AS close, round(adj_close, {R}) AS adj_close,
       CAST(volume AS BIGINT) AS volume, round(dividends, {R}) AS dividends,
       round(stock_splits, {R}) AS stock_splits
FROM primary_bronze WHERE CAST(substr(ticker, 2) AS BIGINT) % 37 <> 5
""")
q("missing_from_batch", """
SELECT 'primary' AS source, batch_id, ticker, 'no data returned' AS reason
FROM (SELECT ticker, CAST((row_number() OVER (ORDER BY ticker) - 1) // 50 AS BIGINT) AS batch_id,
             c_custkey FROM constituents) c
WHERE c_custkey % 37 = 5 OR ticker NOT IN (SELECT ticker FROM primary_bronze)
""")

# ---- planning, cross-check, bronze storage --------------------------------
view("batches", """
SELECT CAST((row_number() OVER (ORDER BY ticker) - 1) // 50 AS BIGINT) AS batch_id,
       CAST(row_number() OVER (ORDER BY ticker) - 1 AS BIGINT) AS position, ticker
FROM constituents
""")
view("sample45", """
SELECT ticker FROM (
  SELECT ticker, gics_sector, row_number() OVER (PARTITION BY gics_sector ORDER BY md5(ticker || ':42'), ticker) AS rn
  FROM constituents WHERE gics_sector IS NOT NULL) r
ORDER BY rn, gics_sector LIMIT 45
""")
q("batch_plan", "SELECT batch_id, position, ticker FROM batches")
q("stratified_sample", """
SELECT ticker FROM sample45 WHERE (SELECT count(*) FROM constituents) > 45
UNION ALL SELECT ticker FROM constituents WHERE (SELECT count(*) FROM constituents) <= 45
""")
q("resume_worklist", """
SELECT ticker, CASE WHEN ticker IN (SELECT ticker FROM secondary_bronze) THEN 'landed' ELSE 'to_fetch' END AS status
FROM (SELECT ticker FROM sample45 WHERE (SELECT count(*) FROM constituents) > 45
      UNION ALL SELECT ticker FROM constituents WHERE (SELECT count(*) FROM constituents) <= 45) s
""")
q("trailing_hour_budget", """
SELECT 'default' AS account, event_id AS request_id, CAST(ts AS VARCHAR) AS requested_at, trailing_count,
       trailing_count > 45 AS over_cap
FROM (SELECT event_id, ts, count(*) OVER (ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)
             AS trailing_count FROM events) x
""")
_NORM = ("trim(regexp_replace(regexp_replace(regexp_replace(upper(coalesce({c}, '')), '[^\\w\\s]', ' ', 'g'), "
         "'\\b(INC|INCORPORATED|CORP|CORPORATION|CO|COMPANY|PLC|LTD|LIMITED|LLC|GROUP|HOLDING|HOLDINGS|CLASS [A-Z])\\b\\.?', "
         "' ', 'g'), '\\s+', ' ', 'g'))")
view("ec_holdings", f"""
SELECT name, title, cusip, isin, asset_cat, pct_val, val_usd,
       {_NORM.format(c='name')} AS n_name, {_NORM.format(c='title')} AS n_title
FROM (SELECT name, title, cusip, isin, asset_cat, pct_val, val_usd FROM holdings WHERE asset_cat = 'EC'
      UNION ALL
      SELECT CASE WHEN s_suppkey % 3 = 1 THEN 'Acme ' || s_suppkey || ' plc' ELSE 'Outside ' || s_suppkey || ' Ltd' END,
             CASE WHEN s_suppkey % 3 = 0 THEN 'ACME ' || s_suppkey || ' class b' ELSE 'outside note ' || s_suppkey END,
             'X' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0'), NULL, 'EC', s_acctbal / 1000.0, s_acctbal FROM supplier) h
""")
view("members", f"SELECT *, {_NORM.format(c='company_name')} AS n_company FROM constituents")
view("ul", """
SELECT ticker, company_name, gics_sector, gics_sub_industry, date_added, snapshot_date FROM members
WHERE n_company NOT IN (SELECT n_name FROM ec_holdings UNION SELECT n_title FROM ec_holdings)
""")
view("uh", """
SELECT name, title, cusip, isin, asset_cat, pct_val, val_usd FROM ec_holdings
WHERE n_name NOT IN (SELECT n_company FROM members) AND n_title NOT IN (SELECT n_company FROM members)
""")
q("crosscheck_unmatched_list", """
SELECT ticker, company_name, gics_sector, gics_sub_industry, CAST(date_added AS VARCHAR) AS date_added,
       CAST(snapshot_date AS VARCHAR) AS snapshot_date FROM ul
""")
q("crosscheck_unmatched_holdings", f"""
SELECT name, title, cusip, isin, asset_cat, round(pct_val, {R}) AS pct_val, round(val_usd, {R}) AS val_usd FROM uh
""")
q("crosscheck_summary", """
SELECT (SELECT count(*) FROM members) AS list_count, (SELECT count(*) FROM ec_holdings) AS holdings_count,
       (SELECT count(*) FROM members) - (SELECT count(*) FROM ul) AS matched,
       (SELECT count(*) FROM ul) AS unmatched_list, (SELECT count(*) FROM uh) AS unmatched_holdings,
       (SELECT count(*) FROM members WHERE n_company = '') AS empty_names
""")
q("macro_labelled", f"""
SELECT m.series_id, CAST(m.date AS VARCHAR) AS date, round(m.value, {R}) AS value, l.label
FROM macro m LEFT JOIN (VALUES ('DGS3MO', '3-Month Treasury Constant Maturity Rate'),
                               ('DGS10', '10-Year Treasury Constant Maturity Rate'),
                               ('FEDFUNDS', 'Federal Funds Effective Rate'),
                               ('CPIAUCSL', 'CPI, All Urban Consumers, Seasonally Adjusted')) l(series_id, label)
  ON l.series_id = m.series_id
""")
_PB_COLS = f"""CAST(date AS VARCHAR) AS date, round(open, {R}) AS open, round(high, {R}) AS high,
       round(low, {R}) AS low, round(close, {R}) AS close, round(adj_close, {R}) AS adj_close,
       CAST(volume AS BIGINT) AS volume, round(dividends, {R}) AS dividends,
       round(stock_splits, {R}) AS stock_splits, ticker"""
q("bronze_partition_scan", f"SELECT {_PB_COLS}, '2024-01-31' AS ingest_date FROM primary_bronze")
q("latest_partition", """
SELECT '2024-01-30' AS latest_ingest_date, count(*) AS rows_in_partition
FROM primary_bronze WHERE date < DATE '2024-01-30'
""")
view("revised_primary", """
SELECT ticker, date, open, high, low,
       close * CASE WHEN (CAST(substr(ticker, 2) AS BIGINT) + day(date)) % 7 = 0 THEN 1.001 ELSE 1 END AS close,
       adj_close * CASE WHEN (CAST(substr(ticker, 2) AS BIGINT) + day(date)) % 7 = 0 THEN 1.001 ELSE 1 END AS adj_close,
       volume
FROM primary_bronze
""")
q("silver_dedup", f"""
SELECT ticker, CAST(date AS VARCHAR) AS date, round(open, {R}) AS open, round(high, {R}) AS high,
       round(low, {R}) AS low, round(close, {R}) AS close, round(adj_close, {R}) AS adj_close,
       round(open * (adj_close / close), {R}) AS adj_open, round(high * (adj_close / close), {R}) AS adj_high,
       round(low * (adj_close / close), {R}) AS adj_low, CAST(volume AS BIGINT) AS volume,
       CAST(volume AS BIGINT) AS adj_volume
FROM revised_primary WHERE {_ROW_OK}
""")

q("universe_plan", """
SELECT c.ticker, c.gics_sector,
       CAST((row_number() OVER (ORDER BY c.ticker) - 1) // 50 AS BIGINT) AS primary_batch,
       CAST((row_number() OVER (ORDER BY c.ticker) - 1) // 100 AS BIGINT) AS identifier_batch,
       c.ticker IN (SELECT ticker FROM sample45) AS in_secondary_sample
FROM constituents c
""")
view("split_tickers", "SELECT DISTINCT ticker FROM primary_bronze WHERE stock_splits <> 0")
q("trading_days_union", """
SELECT CAST(date AS VARCHAR) AS date FROM (
  SELECT date FROM primary_silver WHERE date < DATE '2024-01-16'
  UNION SELECT date FROM primary_silver WHERE ticker IN (SELECT ticker FROM split_tickers)) d
""")
view("known_consensus", "SELECT * FROM consensus_rows WHERE date IN (SELECT date FROM dd_keys)")
q("backfill_audit", """
SELECT (SELECT count(*) FROM known_consensus WHERE date < DATE '2024-01-16') AS before_total,
       (SELECT count(*) FROM known_consensus
        WHERE date < DATE '2024-01-16' OR ticker IN (SELECT ticker FROM split_tickers)) AS after_total,
       (SELECT count(*) FROM known_consensus
        WHERE date < DATE '2024-01-16' AND ticker IN (SELECT ticker FROM split_tickers)) AS before_subset,
       (SELECT count(*) FROM known_consensus WHERE ticker IN (SELECT ticker FROM split_tickers)) AS after_subset,
       true AS untouched_outside_subset
""")
q("fact_price_daily_upsert", f"""
SELECT security_key, date_key, source, open, high, low, close, adj_open, adj_high, adj_low,
       CASE WHEN source = 'primary' AND date_key % 100 >= 20
            THEN round(CAST(CAST(CAST(adj_close_raw * 1.001 AS VARCHAR) AS DECIMAL(18,6)) AS DOUBLE), 9)
            ELSE adj_close END AS adj_close,
       volume, adj_volume
FROM (SELECT f.*, src.adj_close AS adj_close_raw
      FROM f_price f
      JOIN dim_security k ON k.security_key = f.security_key
      JOIN dd_keys d ON d.date_key = f.date_key
      JOIN (SELECT 'primary' AS source, ticker, date, adj_close FROM primary_silver
            UNION ALL SELECT 'secondary', ticker, date, adj_close FROM secondary_silver) src
        ON src.source = f.source AND src.ticker = k.ticker AND src.date = d.date) x
""")

_REVISED = "(CAST(substr(ticker, 2) AS BIGINT) + day(date)) % 7 = 0"
q("silver_dedup_counts", f"""
SELECT CAST((SELECT count(*) FROM primary_bronze)
            + (SELECT count(*) FROM primary_bronze WHERE {_REVISED}) AS BIGINT) AS rows_landed,
       CAST((SELECT count(*) FROM primary_bronze WHERE {_REVISED}) AS BIGINT) AS rows_dropped,
       CAST((SELECT count(*) FROM primary_bronze) AS BIGINT) AS rows_kept
""")

# ---- lake round trips, history range, reports ----------------------------
q("silver_roundtrip", f"SELECT {_SILVER_COLS} FROM primary_silver")
q("silver_history_range", f"""
SELECT {_SILVER_COLS} FROM primary_silver WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-24'
""")
view("recon_summary", """
SELECT t.total_compared, t.flagged_count,
       coalesce(t.flagged_count * 100.0 / nullif(t.total_compared, 0), 0.0)::DOUBLE AS flagged_pct,
       t.primary_only_count, t.secondary_only_count, a.tickers_affected, a.tickers_compared
FROM totals t,
     (SELECT count(*) FILTER (WHERE rows_flagged > 0) AS tickers_affected,
             count(*) AS tickers_compared FROM profile) a
""")
_REPORT_KEYS = ["total_compared", "flagged_count", "flagged_pct", "primary_only_count",
                "secondary_only_count", "tickers_affected", "tickers_compared"]
_TICKER_KEYS = ["rows_flagged", "rows_compared", "flagged_pct", "max_pct_diff", "median_pct_diff"]
_TOP_KEYS = ["primary_adj_close", "secondary_adj_close", "abs_diff", "pct_diff"]
view("top10", "SELECT * FROM pairs p WHERE p.flagged ORDER BY p.pct_diff DESC NULLS LAST, p.ticker, p.date LIMIT 10")
q("reconcile_report_rows", "\nUNION ALL\n".join(
    [f"SELECT 'totals' AS section, 'all' AS key, '{k}' AS metric, round(CAST({k} AS DOUBLE), {R}) AS value, "
     f"CAST(NULL AS VARCHAR) AS text FROM recon_summary" for k in _REPORT_KEYS]
    + [f"SELECT 'ticker', ticker, '{k}', CASE WHEN isfinite(CAST({k} AS DOUBLE)) THEN round(CAST({k} AS DOUBLE), {R}) END, NULL FROM profile WHERE rows_flagged > 0" for k in _TICKER_KEYS]
    + ["SELECT 'ticker', ticker, 'window', NULL, CAST(first_flagged AS VARCHAR) || '..' || CAST(last_flagged AS VARCHAR) "
       "FROM profile WHERE rows_flagged > 0"]
    + [f"SELECT 'top', ticker || ' ' || CAST(date AS VARCHAR), '{k}', CASE WHEN isfinite(CAST({k} AS DOUBLE)) THEN round(CAST({k} AS DOUBLE), {R}) END, NULL FROM top10" for k in _TOP_KEYS]))
view("scd_last", "SELECT max(idx) AS m FROM scd_idx")
q("scd2_snapshot_actions", """
SELECT CAST(count(*) FILTER (WHERE idx = m AND transition IN ('first_seen', 'returned')) AS BIGINT) AS new,
       CAST(count(*) FILTER (WHERE idx = m AND transition = 'changed') AS BIGINT) AS changed,
       CAST(count(*) FILTER (WHERE idx = m - 1 AND (next_idx IS NULL OR next_idx <> idx + 1)) AS BIGINT)
         AS closed,
       CAST(count(*) FILTER (WHERE idx = m AND transition = 'unchanged') AS BIGINT) AS unchanged
FROM scd_tr2, scd_last
""")
q("gate_bronze_report", "\nUNION ALL\n".join([_CONST_Q, _PRICE_Q, _MACRO_Q, _IDENT_Q]))
q("gate_observed", "\nUNION ALL\n".join(
    _check_rows(s, t, _PRICE_CHECKS) for s, t in (("primary", "primary_landed"), ("secondary", "secondary_bronze"))))
q("repull_changed_buckets", f"""
WITH base AS (SELECT *, CAST(date_trunc('week', date) AS DATE) AS period, CAST(substr(ticker, 2) AS BIGINT) AS k FROM primary_bronze),
o AS (SELECT * FROM base WHERE NOT (k % 9 = 4 AND day(date) > 22)),
n AS (SELECT * REPLACE (CASE WHEN k % 7 = 0 AND day(date) BETWEEN 10 AND 12 THEN close * 1.001 ELSE close END AS close) FROM base
      WHERE NOT (k % 11 = 3 AND day(date) < 16)),
d AS (SELECT ticker, period FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM n) x
      UNION SELECT ticker, period FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM o) y),
a AS (SELECT ticker, period, count(*) AS r FROM o GROUP BY 1, 2), b AS (SELECT ticker, period, count(*) AS r FROM n GROUP BY 1, 2)
SELECT coalesce(a.ticker, b.ticker) AS ticker, CAST(coalesce(a.period, b.period) AS VARCHAR) AS period,
       CASE WHEN a.ticker IS NULL THEN 'new' WHEN b.ticker IS NULL THEN 'gone'
            WHEN (a.ticker, a.period) IN (SELECT (ticker, period) FROM d) THEN 'changed' ELSE 'same' END AS status,
       coalesce(a.r, 0) AS old_rows, coalesce(b.r, 0) AS new_rows
FROM a FULL JOIN b ON a.ticker = b.ticker AND a.period = b.period
""")
q("constituents_snapshot_reuse", """
SELECT CASE WHEN c_custkey % 50 = 7 THEN ticker || '-B' ELSE ticker END AS ticker,
       company_name, gics_sector, gics_sub_industry,
       CASE WHEN c_custkey % 11 = 5 THEN NULL ELSE CAST(date_added AS VARCHAR) END AS date_added,
       '2024-01-31' AS snapshot_date
FROM constituents
""")
q("fact_price_daily_stream", "SELECT * FROM f_price WHERE source = 'primary'")

q("stream_superseded", f"""
WITH again AS (SELECT ticker, (CAST(substr(ticker, 2) AS BIGINT) + day(date)) AS k FROM primary_bronze WHERE {_ROW_OK})
SELECT ticker, CAST(sum(1 + (k % 7 = 0)::INT + (k % 3 = 0)::INT) AS BIGINT) AS landed,
       CAST(sum((k % 7 = 0)::INT + (k % 3 = 0)::INT) AS BIGINT) AS superseded, count(*) AS kept
FROM again GROUP BY ticker
""")
q("reconcile_stream", f"""
SELECT m.ticker, CAST(m.date AS VARCHAR) AS date, round(m.primary_adj_close, {R}) AS primary_adj_close,
       round(m.secondary_adj_close, {R}) AS secondary_adj_close, m._merge AS outcome, round(p.abs_diff, {R}) AS abs_diff,
       CASE WHEN isfinite(p.pct_diff) THEN round(p.pct_diff, {R}) END AS pct_diff, p.flagged
FROM matched m LEFT JOIN pairs p ON p.ticker = m.ticker AND p.date = m.date
""")

# ---- bronze repair and gates --------------------------------------------------
_UID_OF = "CAST(substr(ticker, 2) AS BIGINT)"
q("forced_repull", f"""
SELECT {_SILVER_COLS.replace("round(close, 9) AS close",
       "round(close * CASE WHEN " + _UID_OF + " % 5 = 0 THEN 1.002 WHEN " + _UID_OF + " % 3 = 0 THEN 1.001 ELSE 1 END, 9) AS close")}
FROM secondary_bronze WHERE {_UID_OF} % 5 <> 0 OR day(date) >= 10
""")
view("eleven", f"""
SELECT * REPLACE (close * (1 + ({_UID_OF} + day(date)) % 11 * 0.001::DOUBLE) AS close) FROM primary_bronze
""")
q("ten_batches_keep_last", f"""
SELECT {_SILVER_COLS} FROM (
  SELECT ticker, date, open, high, low, close, adj_close, open * (adj_close / close) AS adj_open,
         high * (adj_close / close) AS adj_high, low * (adj_close / close) AS adj_low, volume, volume AS adj_volume
  FROM eleven WHERE {_ROW_OK}) x
""")
q("old_bronze_fallback", f"""
SELECT {_SILVER_COLS} FROM (
  SELECT * REPLACE (CASE WHEN {_UID_OF} % 4 = 0 THEN volume ELSE adj_volume END AS adj_volume) FROM secondary_bronze) x
""")
q("empty_reland", f"""
SELECT count(*) AS rows_before, count(DISTINCT ticker) FILTER (WHERE {_UID_OF} % 9 = 0) AS rejects_before,
       CAST(0 AS BIGINT) AS rows_after, CAST(0 AS BIGINT) AS rejects_after
FROM primary_bronze
""")
view("ok_primary", f"SELECT * REPLACE (least(open, high, low, close) AS low) FROM primary_bronze WHERE {_ROW_OK}")
view("ok_actions", """
SELECT ticker, date, action_type, value FROM (
  SELECT ticker, date, 'dividend' AS action_type, dividends AS value FROM ok_primary
  UNION ALL SELECT ticker, date, 'split', stock_splits FROM ok_primary) a
WHERE coalesce(value, 0) <> 0
""")
view("ok_secondary", f"""
SELECT * FROM (SELECT * REPLACE (least(open, high, low, close) AS low, abs(adj_close) AS adj_close) FROM secondary_bronze) b
WHERE {_ROW_OK}
""")
view("ok_matched", """
SELECT ticker, date FROM ok_primary UNION SELECT ticker, date FROM ok_secondary
""")
view("ok_macro", "SELECT * REPLACE (least(25.0, greatest(0.01, value)) AS value) FROM macro")
_OK_GATE = "\nUNION ALL\n".join([
    _check_rows("constituents", "constituents",
                [("ticker not null", "count(*) FILTER (WHERE ticker IS NULL)", "count(*)", "1.0"),
                 ("gics_sector not null", "count(*) FILTER (WHERE gics_sector IS NULL)", "count(*)", "1.0")],
                [("ticker unique", ["ticker"])], band=(1, 10 ** 9)),
    _check_rows("primary", "ok_primary", _PRICE_CHECKS, [("(ticker, date) unique", ["ticker", "date"])]),
    _check_rows("secondary", "ok_secondary", _PRICE_CHECKS, [("(ticker, date) unique", ["ticker", "date"])]),
    _MACRO_Q.replace("FROM macro", "FROM ok_macro"), _IDENT_Q])
_RUN_GATE = "\nUNION ALL\n".join([_CONST_Q.replace("480", "1").replace("520", "1000000000"), _PRICE_Q, _MACRO_Q, _IDENT_Q])
_KNOWN = "date >= (SELECT min(CAST(ts AS DATE)) + 1 FROM events)"
q("daily_run_summary", f"""
SELECT 'refused' AS stage, 'bronze checks failed' AS item, CAST(count(*) AS DOUBLE) AS value
FROM ({_RUN_GATE}) r WHERE NOT success
UNION ALL
SELECT 'bronze', source || ': ' || check_name, CAST(element_count - unexpected_count AS DOUBLE) FROM ({_OK_GATE}) g
UNION ALL SELECT 'load', 'fact_price_daily:primary', CAST(count(*) AS DOUBLE) FROM ok_primary WHERE {_KNOWN}
UNION ALL SELECT 'load', 'fact_price_daily:secondary', CAST(count(*) AS DOUBLE) FROM ok_secondary WHERE {_KNOWN}
UNION ALL SELECT 'load', 'fact_price_daily_consensus', CAST(count(*) AS DOUBLE) FROM ok_matched WHERE {_KNOWN}
UNION ALL SELECT 'load', 'fact_corporate_action', CAST(count(*) AS DOUBLE) FROM ok_actions WHERE {_KNOWN}
UNION ALL SELECT 'load', 'fact_macro_rate', CAST(count(*) AS DOUBLE) FROM macro WHERE {_KNOWN}
UNION ALL SELECT 'gold', 'security count >= 1', CAST(count(*) AS DOUBLE) FROM constituents
UNION ALL SELECT 'gold', 'consensus rows/security >= 1',
       round((SELECT count(*) FROM ok_matched WHERE {_KNOWN}) / (SELECT count(*) FROM constituents), {R})
UNION ALL SELECT 'gold', 'latest data within 5 days of ingest_date',
       CAST(DATE '2024-01-31' - (SELECT max(date) FROM ok_matched) AS DOUBLE)
""")
q("stream_rejects", f"""
WITH r AS (
  SELECT ticker, date,
         CASE WHEN ticker IS NULL THEN 'ticker not null' WHEN date IS NULL THEN 'date not null' WHEN close IS NULL THEN 'close not null'
              WHEN close <= 0 THEN 'close > 0' WHEN open <= 0 THEN 'open > 0' WHEN adj_close <= 0 THEN 'adj_close > 0'
              WHEN volume < 0 THEN 'volume >= 0' END AS reason
  FROM primary_landed),
k AS (
  SELECT CASE WHEN ticker NOT IN (SELECT ticker FROM constituents) THEN 'no security'
              WHEN NOT {_KNOWN} THEN 'no calendar date' ELSE 'loaded' END AS reason
  FROM (SELECT DISTINCT ticker, date FROM r WHERE reason IS NULL) g)
SELECT reason, count(*) AS rows FROM r WHERE reason IS NOT NULL GROUP BY 1
UNION ALL SELECT reason, count(*) FROM k GROUP BY 1
""")
