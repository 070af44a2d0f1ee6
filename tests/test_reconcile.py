import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricelake.operators import reconcile as rec

D1, D2, D3 = dt.date(2024, 1, 2), dt.date(2024, 1, 3), dt.date(2024, 1, 4)


def side(spark, rows):
    return spark.createDataFrame(rows, "ticker string, date date, adj_close double")


def test_two_percent_apart_is_flagged(spark):
    r = rec.Reconciliation(side(spark, [("A", D1, 100.0)]), side(spark, [("A", D1, 102.0)]))
    p = r.pairs().first()
    assert p.flagged and p.pct_diff == pytest.approx(2 / 101)


def test_ten_cents_is_within_tolerance(spark):
    r = rec.Reconciliation(side(spark, [("A", D1, 100.0)]), side(spark, [("A", D1, 100.10)]))
    assert not r.pairs().first().flagged


def test_coverage_gaps_are_not_discrepancies(spark):
    r = rec.Reconciliation(side(spark, [("A", D1, 100.0), ("A", D2, 100.0)]),
                           side(spark, [("A", D1, 100.0), ("B", D1, 5.0)]))
    t = r.totals().first()
    assert (t.total_compared, t.flagged_count, t.primary_only_count, t.secondary_only_count) == (1, 0, 1, 1)
    cons = {(x.ticker, x.date): x for x in r.consensus().collect()}
    assert len(cons) == 3
    assert cons[("A", D2)].reconciliation_flag == "single_source" and cons[("A", D2)].sources_available == ["primary"]
    assert cons[("B", D1)].primary_source == "secondary" and cons[("B", D1)].pct_diff is None
    assert cons[("A", D1)].sources_available == ["primary", "secondary"]


def test_symmetric_when_sources_swap(spark):
    a, b = side(spark, [("A", D1, 100.0)]), side(spark, [("A", D1, 103.0)])
    x = rec.Reconciliation(a, b).pairs().first()
    y = rec.Reconciliation(b, a).pairs().first()
    assert x.pct_diff == y.pct_diff and x.flagged == y.flagged


def test_primary_wins_when_they_disagree(spark):
    r = rec.Reconciliation(side(spark, [("A", D1, 100.0)]), side(spark, [("A", D1, 110.0)]))
    c = r.consensus().first()
    assert c.adj_close == 100.0 and c.reconciliation_flag == "disagreed"


def test_zero_mean_and_null_prices_never_error(spark):
    r = rec.Reconciliation(side(spark, [("A", D1, 0.0), ("A", D2, None), ("A", D3, 1.0)]),
                           side(spark, [("A", D1, 0.0), ("A", D2, 5.0), ("A", D3, -1.0)]))
    got = {x.date: x for x in r.pairs().collect()}
    assert got[D1].pct_diff is None and not got[D1].flagged      # 0 / 0: agreed
    assert got[D2].pct_diff is None and not got[D2].flagged      # missing side: not evaluated
    assert got[D3].flagged                                        # x / 0: infinite difference


def test_event_window_ends_on_the_event_date(spark):
    p = side(spark, [("A", D1, 100.0), ("A", D2, 100.0), ("A", D3, 100.0)])
    s = side(spark, [("A", D1, 107.0), ("A", D2, 107.0), ("A", D3, 100.0)])
    prof = rec.Reconciliation(p, s).by_ticker().first()
    assert (prof.rows_compared, prof.rows_flagged) == (3, 2)
    assert (prof.first_flagged, prof.last_flagged) == (D1, D2)
    shape = rec.discrepancy_shape(rec.Reconciliation(p, s).by_ticker()).first()
    assert shape.window_reaches_end is False


def test_profile_of_nothing_is_empty(spark):
    r = rec.Reconciliation(side(spark, [("A", D1, 1.0)]), side(spark, [("B", D1, 1.0)]))
    assert r.by_ticker().count() == 0
    assert r.summary().first().flagged_pct == 0.0


def test_top_discrepancies_ordered(spark):
    p = side(spark, [("A", D1, 100.0), ("B", D1, 100.0), ("C", D1, 100.0)])
    s = side(spark, [("A", D1, 101.0), ("B", D1, 110.0), ("C", D1, 105.0)])
    assert [x.ticker for x in rec.Reconciliation(p, s).top(2).collect()] == ["B", "C"]


def test_golden_pct_diff(spark):
    r = rec.Reconciliation(side(spark, [("AAPL", D1, 37.436916)]), side(spark, [("AAPL", D1, 37.437651)]))
    p = r.pairs().first()
    assert p.pct_diff == pytest.approx(1.9632834738287712e-05, rel=1e-6) and not p.flagged


def test_report_rows_are_tidy(spark):
    p = side(spark, [("A", D1, 100.0), ("B", D1, 100.0)])
    s = side(spark, [("A", D1, 110.0), ("B", D1, 100.0)])
    rows = rec.Reconciliation(p, s).report_rows().collect()
    keys = {(r.section, r.key, r.metric) for r in rows}
    assert ("totals", "all", "flagged_count") in keys and ("ticker", "A", "window") in keys
    assert not any(k[1] == "B" for k in keys) and ("top", f"A {D1}", "pct_diff") in keys


def test_infinite_discrepancy_ranks_first_and_is_an_event(spark):
    p = side(spark, [("A", D1, 1.0), ("B", D1, 100.0), ("C", D1, 0.0)])
    s = side(spark, [("A", D1, -1.0), ("B", D1, 200.0), ("C", D1, 0.0)])
    r = rec.Reconciliation(p, s)
    assert [x.ticker for x in r.top(2).collect()] == ["A", "B"] and r.top(1).first().pct_diff == float("inf")
    shapes = {x.ticker: (x.max_pct_diff, x.rows_flagged) for x in rec.discrepancy_shape(r.by_ticker()).collect()}
    assert shapes["A"] == (float("inf"), 1) and shapes["C"] == (None, 0)


def test_rollup_has_every_level_once(spark):
    import datetime as dt
    rows = [("A", dt.date(2024, 1, 5), "agreed", 0.1), ("A", dt.date(2024, 2, 5), "agreed", 0.3), ("B", dt.date(2024, 1, 9), "disagreed", 0.2),
            ("B", dt.date(2024, 1, 10), "disagreed", float("inf")), ("C", dt.date(2024, 1, 5), "single_source", None)]
    c = spark.createDataFrame(rows, "ticker string, date date, reconciliation_flag string, pct_diff double")
    s = spark.createDataFrame([("A", "x"), ("B", "x"), ("D", "y")], "ticker string, sector string")
    got = {(r.sector, r.ticker, str(r.month) if r.month else None, r.outcome, r.grouping_id): (r.bars, r.mean_pct_diff)
           for r in rec.coverage_rollup(c, s).collect()}
    assert got[None, None, None, None, 15] == (5, pytest.approx(0.2))
    assert got["x", None, None, None, 7] == (4, pytest.approx(0.2))
    assert got[None, None, None, None, 7] == (1, None)  # no sector, not the total
    assert got["x", None, "2024-01-01", "disagreed", 4] == (2, pytest.approx(0.2))
    assert got["x", "A", None, "agreed", 2] == (2, pytest.approx(0.2))
    assert got[None, None, "2024-02-01", "agreed", 12] == (1, pytest.approx(0.3))
    assert sum(n for k, (n, _) in got.items() if k[-1] == 0) == 5
