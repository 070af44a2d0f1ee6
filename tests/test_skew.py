"""A third of all rows on one key: results stay whole and exact, and the
plans reduce hot groups before they are shuffled."""

import datetime as dt

from pyspark.sql import functions as F

from pricelake.operators import quality as qc
from pricelake.operators import reconcile as rec
from pricelake.operators.silver import to_silver
from pricelake.operators.upsert import upsert

D0 = dt.date(2020, 1, 1)


def skewed_bronze(spark, copies=1000, others=2000):
    hot_copies = spark.range(copies).select(
        F.lit("HOT").alias("ticker"), F.lit(D0).alias("date"), F.col("id").alias("_arrival_row"),
        (100.0 + F.col("id")).alias("close"))
    rest = spark.range(others).select(
        F.concat(F.lit("T"), (F.col("id") % 40).cast("string")).alias("ticker"),
        F.date_add(F.lit(D0), (F.col("id") / 40).cast("int")).alias("date"),
        F.lit(0).cast("long").alias("_arrival_row"), F.lit(50.0).alias("close"))
    df = hot_copies.unionByName(rest).withColumn("_arrival_file", F.lit("f"))
    return (df.withColumn("open", F.col("close")).withColumn("high", F.col("close") + 1)
            .withColumn("low", F.col("close") - 1).withColumn("adj_close", F.col("close"))
            .withColumn("volume", F.lit(10).cast("long")))


def test_hot_copies_keep_last_exact_and_reduced_before_shuffle(spark):
    s = to_silver(skewed_bronze(spark))
    assert s.count() == 1 + 2000
    assert s.where("ticker = 'HOT'").first().close == 100.0 + 999
    s.write.format("noop").mode("overwrite").save()
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan     # map-side top-1 per key


def test_hot_copies_counted_by_gate(spark):
    b = skewed_bronze(spark).drop("_arrival_file", "_arrival_row")
    r = {x.check_name: x for x in qc.evaluate(b, qc.price_rules(), "p").collect()}
    assert r["(ticker, date) unique"].unexpected_count == 1000


def test_hot_ticker_history_profile(spark):
    n = 1500
    p = spark.range(n).select(F.lit("HOT").alias("ticker"), F.date_add(F.lit(D0), F.col("id").cast("int")).alias("date"),
                              F.lit(100.0).alias("adj_close"))
    others = spark.range(3000).select(F.concat(F.lit("T"), (F.col("id") % 100).cast("string")).alias("ticker"),
                                      F.date_add(F.lit(D0), (F.col("id") / 100).cast("int")).alias("date"),
                                      F.lit(10.0).alias("adj_close"))
    prim = p.unionByName(others)
    sec = prim.withColumn("adj_close", F.when((F.col("ticker") == "HOT") & (F.col("date") < F.lit(D0 + dt.timedelta(500))),
                                              F.col("adj_close") * 1.07).otherwise(F.col("adj_close")))
    prof = {r.ticker: r for r in rec.Reconciliation(prim, sec).by_ticker().collect()}
    hot = prof["HOT"]
    assert (hot.rows_compared, hot.rows_flagged) == (n, 500)
    assert hot.last_flagged == D0 + dt.timedelta(499)
    assert len(prof) == 101


def test_hot_key_upsert_is_whole(spark):
    old = spark.range(3000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v")).dropDuplicates(["k"])
    new = spark.range(1).select(F.lit(0).cast("long").alias("k"), F.lit(-1).cast("long").alias("v"))
    got = sorted(upsert(old, new, ["k"]).collect())
    assert len(got) == 3 and got[0] == (0, -1)


def test_hot_hour_request_budget_exact_and_split(spark):
    """A third of the log (and more) in one hour of one account: counts stay
    exact and no window is partitioned by account or hour."""
    import random
    from pricelake.operators.planning import trailing_hour_budget
    rnd = random.Random(3)
    t0 = dt.datetime(2024, 1, 1, 9)
    hot = [("hot", t0 + dt.timedelta(seconds=rnd.randint(0, 3599))) for _ in range(400)]
    cold = [("cold", t0 + dt.timedelta(seconds=rnd.randint(0, 4 * 3600))) for _ in range(200)]
    rows = [(a, i, t) for i, (a, t) in enumerate(hot + cold)]
    log = spark.createDataFrame(rows, "account string, request_id int, requested_at timestamp_ntz")
    out = trailing_hour_budget(log, cap=45)
    got = {r.request_id: (r.trailing_count, r.over_cap) for r in out.collect()}
    for a, i, t in rows:
        want = sum(1 for b, _, u in rows if b == a and t - dt.timedelta(hours=1) <= u <= t)
        assert got[i] == (want, want > 45)
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(account" not in plan


def test_hot_stratum_sample_exact(spark):
    """Most of the universe in one stratum: the two-step rank gives exactly
    the brute-force round-robin sample."""
    import hashlib
    from pricelake.operators.planning import stratified_sample
    rows = [(f"K{i:05d}", "HOT" if i % 10 < 8 else f"S{i % 3}") for i in range(3000)]
    u = spark.createDataFrame(rows, "ticker string, gics_sector string")
    n = 40
    got = sorted(r.ticker for r in stratified_sample(u, n, salt_buckets=8).collect())
    per = {}
    for t, s in rows:
        per.setdefault(s, []).append(t)
    for s in per:
        per[s].sort(key=lambda t: (hashlib.md5(f"{t}:42".encode()).hexdigest(), t))
    order = sorted(((i, s, t) for s, ts in per.items() for i, t in enumerate(ts)))
    assert got == sorted(t for _, _, t in order[:n])
    df = stratified_sample(u, n, salt_buckets=8)
    df.write.format("noop").mode("overwrite").save()
    assert df._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 4


def test_hot_empty_name_crosscheck_is_whole(spark):
    """A third of the members normalise to the empty name (one hot anti-join
    key): they all match a holding whose name is empty too, and every other
    member is judged on its own name."""
    from pricelake.operators import crosscheck as xc
    hot = [(f"H{i}", "Inc.") for i in range(1000)]
    rest = [(f"T{i}", f"Acme {i} Corp") for i in range(2000)]
    members = spark.createDataFrame(hot + rest, "ticker string, company_name string")
    holdings = spark.createDataFrame([("  ", "Class A")] + [(f"ACME {i} LTD", f"acme {i} class b")
                                                           for i in range(0, 2000, 2)],
                                     "name string, title string")
    unmatched = {r.ticker for r in xc.unmatched_list(members, holdings).collect()}
    assert unmatched == {f"T{i}" for i in range(1, 2000, 2)}
    s = xc.summary(members, holdings).first()
    assert (s.list_count, s.matched, s.unmatched_list, s.empty_names) == (3000, 2000, 1000, 1000)
