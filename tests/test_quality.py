import datetime as dt

from pyspark.sql import functions as F

from pricelake.operators import quality as qc

SCHEMA = ("ticker string, date date, open double, high double, low double, close double, "
          "adj_close double, volume long")


def clean(spark, n):
    base = dt.date(2024, 1, 1)
    return spark.range(n).select(
        F.concat(F.lit("T"), (F.col("id") % 50).cast("string")).alias("ticker"),
        F.date_add(F.lit(base), (F.col("id") / 50).cast("int")).alias("date"),
        (100 + F.col("id") % 7).cast("double").alias("open"),
        (102 + F.col("id") % 7).cast("double").alias("high"),
        (99 + F.col("id") % 7).cast("double").alias("low"),
        (101 + F.col("id") % 7).cast("double").alias("close"),
        (101 + F.col("id") % 7).cast("double").alias("adj_close"),
        (F.col("id") * 10).alias("volume"))


def report(df):
    return {r.check_name: r for r in qc.evaluate(df, qc.price_rules(), "p").collect()}


def test_clean_batch_passes_every_rule(spark):
    r = report(clean(spark, 100))
    assert len(r) == 13 and all(x.success for x in r.values())


def test_one_bad_bar_in_20000_is_tolerated_but_counted(spark):
    df = clean(spark, 20000).withColumn("low", F.when(F.col("ticker") == "T3", F.col("low"))
                                        .otherwise(F.col("low")))
    df = df.withColumn("low", F.when((F.col("ticker") == "T3") & (F.col("date") == F.lit(dt.date(2024, 1, 1))),
                                     F.col("open") + 0.5).otherwise(F.col("low")))
    r = report(df)
    assert r["low <= open"].success and r["low <= open"].unexpected_count == 1


def test_twenty_of_one_hundred_fails(spark):
    df = clean(spark, 100)
    df = df.withColumn("low", F.when(F.col("ticker").isin([f"T{i}" for i in range(10)]), F.col("open") + 10)
                       .otherwise(F.col("low")))
    r = report(df)
    assert not r["low <= open"].success and r["low <= open"].unexpected_count == 20


def test_negative_close_duplicate_and_inverted_range_all_reported(spark):
    df = clean(spark, 100)
    bad = df.limit(1).withColumn("close", F.lit(-5.0)).withColumn("high", F.col("low") - 10)
    r = report(df.unionByName(bad))
    assert not r["close > 0"].success and r["close > 0"].unexpected_count == 1
    assert r["(ticker, date) unique"].unexpected_count == 2
    assert r["high >= low"].unexpected_count == 1
    assert sum(not x.success for x in r.values()) >= 3


def test_null_policy(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 1), None, None, 1.0, None, 1.0, None),
                                ("A", dt.date(2024, 1, 2), 1.0, 2.0, 1.0, 1.5, 1.0, 5)], SCHEMA)
    r = report(df)
    assert r["close not null"].unexpected_count == 1
    assert r["open > 0"].element_count == 1                 # NULL not evaluated
    assert r["high >= low"].unexpected_count == 1           # one NULL side counts


def test_empty_frame_is_one_failing_check(spark):
    rows = qc.evaluate(clean(spark, 10).limit(0), qc.price_rules(), "p").collect()
    assert [(x.check_name, x.success) for x in rows] == [("non-empty dataframe", False)]


def test_constituents_band_and_uniqueness(spark):
    df = spark.createDataFrame([("A", "S"), ("A", "S"), ("B", None)], "ticker string, gics_sector string")
    r = {x.check_name: x for x in qc.evaluate(df, qc.constituents_rules((2, 5)), "c").collect()}
    assert not r["ticker unique"].success and r["ticker unique"].unexpected_count == 2
    assert not r["gics_sector not null"].success
    assert r["row count in [2, 5]"].success


def test_macro_rules_per_series(spark):
    df = spark.createDataFrame([("DGS10", 30.0), ("DGS10", 4.0), ("CPIAUCSL", 300.0), ("CPIAUCSL", -1.0)],
                               "series_id string, value double")
    r = {(x.source, x.check_name): x for x in qc.evaluate_macro(df).collect()}
    assert r[("macro:DGS10", "value in plausible rate range [0, 25]")].unexpected_count == 1
    assert r[("macro:CPIAUCSL", "value > 0 (index level)")].unexpected_count == 1


def test_identifier_rules(spark):
    df = spark.createDataFrame([("A", "BBG000000001"), ("B", "BBG1"), ("C", "BBG1")], "ticker string, figi string")
    r = {x.check_name: x for x in qc.evaluate(df, qc.identifier_rules(), "i").collect()}
    assert r["figi is 12 characters"].unexpected_count == 2 and r["figi unique"].unexpected_count == 2
    assert r["ticker unique"].success


def test_violation_diagnosis_one_row_per_rule(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 1), 10.0, 9.0, 11.0, 10.0, 10.0, 1)], SCHEMA)
    got = sorted(r.violation for r in qc.ohlc_violations(df).collect())
    assert got == ["high < close", "high < open", "low > close", "low > high", "low > open"]


def test_rollup_counts_clean_sources(spark):
    a = qc.evaluate(clean(spark, 10), qc.price_rules(), "a")
    b = qc.evaluate(clean(spark, 10).limit(0), qc.price_rules(), "b")
    v = qc.overall(a.unionByName(b)).first()
    assert (v.sources_clean, v.sources_checked, v.passed) == (1, 2, False)


def test_observed_counts_equal_the_gate_and_read_nothing_again(spark, lake):
    import datetime as dt

    from pricelake.plans import pipeline as pl
    from pricelake.sources import bindings as bind
    from pricelake.sources import bronze, fs
    from tests.conftest import SF
    b, rules, day = bind.primary_landed(spark, SF), qc.price_rules(), dt.date(2024, 2, 1)
    seen = qc.Observed(rules)
    bronze.land(seen.watch(b), lake, "primary_prices", day)
    landed = bronze.scan(spark, lake, "primary_prices", pl.PRICE_SCHEMAS["primary"], day, arrival=False)
    want = [tuple(r) for r in qc.evaluate(landed.drop("ingest_date", "batch"), rules, "primary").collect() if "unique" not in r.check_name]
    # what was landed is gone, so nothing can be scanned for the report
    fs.delete(spark, lake)
    assert [tuple(r) for r in seen.report(spark, "primary").collect()] == want and any(not r[2] for r in want)


def test_observed_report_of_nothing_landed(spark, lake):
    import datetime as dt

    from pricelake.plans import pipeline as pl
    from pricelake.sources import bindings as bind
    from tests.conftest import SF
    r = pl.land_gated(bind.primary_landed(spark, SF).where("false"), lake, "primary_prices", dt.date(2024, 2, 1),
                      qc.price_rules(), "primary").collect()
    assert [(x.check_name, x.success) for x in r] == [("non-empty dataframe", False)]
