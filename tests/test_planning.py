import datetime as dt
import random

from pyspark.sql import functions as F

from pricelake.functions import normalize_company_name
from pricelake.operators import crosscheck as xc
from pricelake.operators import planning


def universe(spark):
    rows = [(f"{s[:2].upper()}{i}", s) for s in ["Energy", "Health", "Tech", "Utilities"] for i in range(10)]
    return spark.createDataFrame(rows + [("NUL1", None)], "ticker string, gics_sector string")


def test_sample_covers_every_sector_and_is_deterministic(spark):
    u = universe(spark)
    a = sorted(r.ticker for r in planning.stratified_sample(u, 8).collect())
    b = sorted(r.ticker for r in planning.stratified_sample(u, 8).collect())
    assert a == b and len(a) == 8
    sectors = {t[:2] for t in a}
    assert sectors == {"EN", "HE", "TE", "UT"}
    assert all(sum(t.startswith(s) for t in a) == 2 for s in sectors)


def test_sample_n_at_least_universe_returns_everything(spark):
    u = universe(spark)
    assert planning.stratified_sample(u, 100).count() == 41


def test_batch_plan(spark):
    keys = spark.createDataFrame([(f"T{i:03d}",) for i in range(120)], "ticker string")
    got = {r.ticker: r.batch_id for r in planning.batch_plan(keys, 50).collect()}
    assert got["T000"] == 0 and got["T049"] == 0 and got["T050"] == 1 and got["T119"] == 2


def test_resume_worklist(spark):
    req = spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string")
    landed = spark.createDataFrame([("B",)], "ticker string")
    st = {r.ticker: r.status for r in planning.resume_worklist(req, landed).collect()}
    assert st == {"A": "to_fetch", "B": "landed", "C": "to_fetch"}
    forced = {r.status for r in planning.resume_worklist(req, landed, force=True).collect()}
    assert forced == {"to_fetch"}


def test_trailing_hour_budget_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    ts = sorted(base + dt.timedelta(seconds=rnd.randint(0, 5 * 3600)) for _ in range(300))
    ts += [ts[10], ts[10]]                                      # ties count as peers
    log = spark.createDataFrame([("acct", i, t) for i, t in enumerate(ts)],
                                "account string, request_id int, requested_at timestamp_ntz")
    got = {r.request_id: r.trailing_count for r in planning.trailing_hour_budget(log, cap=5).collect()}
    for i, t in enumerate(ts):
        want = sum(1 for u in ts if t - dt.timedelta(hours=1) <= u <= t)
        assert got[i] == want


def test_company_name_normaliser(spark):
    df = spark.createDataFrame([("Apple Inc.",), ("APPLE INC",), ("Alphabet Inc.",), ("ALPHABET INC CLASS A",),
                                ("Berkshire Hathaway Inc.",), ("Berkshire Hathaway",), (None,)], "n string")
    got = [r[0] for r in df.select(normalize_company_name("n")).collect()]
    assert got == ["APPLE", "APPLE", "ALPHABET", "ALPHABET", "BERKSHIRE HATHAWAY", "BERKSHIRE HATHAWAY", ""]


def test_crosscheck(spark):
    members = spark.createDataFrame([("AAPL", "Apple Inc."), ("NEW", "Brand New Co")],
                                    "ticker string, company_name string")
    holdings = spark.createDataFrame([("APPLE INC", "Apple Inc"), ("ZZZ LTD", "zzz class b")],
                                     "name string, title string")
    assert [r.ticker for r in xc.unmatched_list(members, holdings).collect()] == ["NEW"]
    assert [r.name for r in xc.unmatched_holdings(members, holdings).collect()] == ["ZZZ LTD"]
    s = xc.summary(members, holdings).first()
    assert (s.list_count, s.matched, s.unmatched_list, s.unmatched_holdings) == (2, 1, 1, 1)


def test_trailing_hour_budget_needs_no_unique_request_id(spark):
    t = dt.datetime(2024, 1, 1, 12)
    log = spark.createDataFrame([("a", 1, t), ("a", 1, t + dt.timedelta(minutes=30)), ("a", 1, t + dt.timedelta(hours=2))],
                                "account string, request_id int, requested_at timestamp_ntz")
    got = sorted(r.trailing_count for r in planning.trailing_hour_budget(log, cap=1).collect())
    assert got == [1, 1, 2]
