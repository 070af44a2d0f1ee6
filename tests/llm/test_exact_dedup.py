import hashlib
import string
from collections import defaultdict

from pyspark.sql import functions as F

from pricelake.llm import exact_dedup as E

from .conftest import nasty_rows, rows_of

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for i, t, *_ in rows:
        n = (t or "").translate(LOWER)
        keep = max((x for x in groups[n] if x is not None), default=None)
        out.append({"doc_id": i, "keep_id": keep, "group_size": len(groups[n]), "kept": i == keep,
                    "text_sha256": hashlib.sha256(n.encode()).hexdigest()})
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text_sha256"]))


def test_nasty_rows_against_brute_force(nasty):
    assert ordered(rows_of(E.exact_dedup(nasty), "doc_id")) == ordered(brute(nasty_rows()))


def test_weak_digest_never_merges_texts(nasty):
    weak = E.exact_dedup(nasty, digest=lambda t: F.pmod(F.length(t), F.lit(3)).cast("string"))
    assert ordered(rows_of(weak, "doc_id")) == ordered(brute(nasty_rows()))


def test_one_copy_of_each_text_stays(nasty):
    stay = E.deduplicated(nasty)
    assert stay.columns == nasty.columns
    got = sorted((t or "").translate(LOWER) for (t,) in stay.select("text").collect())
    assert got == sorted({(t or "").translate(LOWER) for _, t, *_ in nasty_rows()})


def test_hot_text_and_empty_table(spark, empty):
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("Hot")).otherwise(
        F.concat(F.lit("t"), F.col("id"))).alias("text")).repartition(7)
    got = E.exact_dedup(hot).filter("group_size > 1").agg(F.count("*"), F.max("group_size"), F.sum(F.col("kept").cast("int")), F.max("keep_id")).first()
    assert tuple(got) == (1000, 1000, 1, 2997)
    assert E.exact_dedup(empty).count() == 0


def test_native_plan(nasty):
    plan = E.exact_dedup(nasty)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
