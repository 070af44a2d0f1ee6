"""Driver contract: entry() and the catalogue against the DuckDB oracle at
the smallest scale (the full sweep at sf0.01 is tools/oracle_check.py)."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 8 and {"ticker", "rows_flagged", "median_pct_diff"} <= set(df.columns)


def test_every_query_has_an_oracle():
    from pricelake.plans.catalogue import QUERIES
    assert set(QUERIES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ["reconcile_by_ticker", "reconcile_summary", "quality_prices", "scd2_summary",
                                  "fact_consensus", "holdings_xml", "trailing_hour_budget", "crosscheck_summary",
                                  "scd2_snapshot_actions", "reconcile_report_rows"])
def test_matches_oracle(spark, duck, name):
    import sys, os
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    from oracle_check import digest
    sp = entry_mod.queries()[name](spark, SF).toPandas()
    dk = duck.execute(entry_mod.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    assert len(sp) == len(dk) and digest(sp) == digest(dk)


def test_acceptance_counts_at_smallest_scale(spark):
    s = entry_mod.queries()["reconcile_summary"](spark, SF).first()
    assert (s.total_compared, s.flagged_count, s.primary_only_count, s.secondary_only_count,
            s.tickers_affected, s.tickers_compared) == (200, 33, 185, 6, 2, 8)


def test_scale_settings():
    from pricelake.session import scale_settings
    s = scale_settings(100 * 1024 ** 4)
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_settings(1)["spark.sql.shuffle.partitions"]) == 200
