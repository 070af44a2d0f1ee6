import random

import pytest
from pyspark.sql import functions as F

from pricelake.llm import near_dedup as N
from pricelake.llm.components import components

from .conftest import nasty_rows, prose, rows_of


def brute(rows, k=4, percent=80):
    """(doc_id, n_shingles, component) of every row, all pairs compared."""
    sets = [N.shingles_of(N.words_of(t), k) for _, t, *_ in rows]
    par = list(range(len(rows)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and (a == b or rows[i][0] is not None and rows[j][0] is not None) and \
                    100 * len(a & b) >= percent * len(a | b):
                par[find(i)] = find(j)
    best = {}
    for i, (d, *_) in enumerate(rows):
        r = find(i)
        if d is not None:
            best[r] = min(best.get(r, d), d)
    return sorted(((d, len(s), d if not s else best.get(find(i))) for i, ((d, *_), s) in enumerate(zip(rows, sets))), key=str)


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows_of(df, "doc_id")), key=str)


def test_nasty_rows_against_brute_force(nasty):
    out = N.near_duplicates(nasty, words=4)
    assert result(out) == brute(nasty_rows())
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows_of(out, "doc_id"))


def family(r, base, n, first, edits):
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        rows.append((first + i, " ".join(w)))
    return rows


def test_large_groups_around_the_threshold(spark):
    r = random.Random(3)
    rows = []
    for g in range(6):
        rows += family(r, prose(g + 10, 120, 5000).split(), 60, 1000 * g, 7)
    rows += [(9000 + i, prose(500 + i, 80, 5000)) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(N.near_duplicates(df, words=4)) == brute(rows)


def test_pairs_left_after_the_leaders(spark, monkeypatch):
    # one leader a bucket and one pair confirmed first: most is left to the second round
    monkeypatch.setattr(N, "LEADERS", 1)
    monkeypatch.setattr(N, "FIRST", 1)
    r = random.Random(4)
    rows = family(r, prose(77, 90, 4000).split(), 60, 0, 9) + family(r, prose(78, 40, 4000).split(), 30, 500, 3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(N.near_duplicates(df, words=4)) == brute(rows)


def test_sharable_counts_what_only_one_node_has(spark):
    texts = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d x y"), (3, "a b c d e z")], "node long, text string")
    got = {r.node: r.own for r in N.sharable(texts.select("node"), texts, 4).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_one_of_each_group_stays(nasty):
    stay = N.near_deduplicated(nasty, words=4)
    assert stay.columns == nasty.columns
    want = sorted({(d, t) for d, t, *_ in nasty_rows()} & {
        (d, t) for (d, t, *_) in nasty_rows() for (x, n, c) in brute(nasty_rows())
        if x == d and c == d and n == len(N.shingles_of(N.words_of(t), 4))}, key=str)
    assert sorted(((x.doc_id, x.text) for x in stay.select("doc_id", "text").collect()), key=str) == want


def test_pruning_table():
    stops = [32, 64, 96, 128, 160]
    least = N.least_matches(stops, 0.8, 1e-6)
    assert all(a < b for a, b in zip(least, least[1:])) and all(m < 0.8 * n for m, n in zip(least, stops))
    assert N.least_matches([32], 0.8, 0.0) == [0] or N.least_matches([32], 0.8, 0.0)[0] <= 0


def test_components(spark):
    r = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(200, 100 + i) for i in range(50)] + [(7, 7)] + \
            [(300 + r.randrange(40), 300 + r.randrange(40)) for _ in range(25)]
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    par = {}
    find = lambda x: x if par.setdefault(x, x) == x else find(par[x])
    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            par[y] = x
    assert got == {x: find(x) for x in par}


@pytest.mark.parametrize("links, want", [
    ([(3, 1), (3, 2)], {1: 1, 2: 1, 3: 1}),
    ([(20, 10 + i) for i in range(8)], {x: 10 for x in [*range(10, 18), 20]})])
def test_components_of_a_largest_hub_alone(spark, links, want):
    got = [tuple(x) for x in components(spark.createDataFrame(links, "a long, b long")).collect()]
    assert sorted(got) == sorted(want.items())


def test_one_document_near_to_two_that_are_apart(spark):
    w = [f"w{i}" for i in range(60)]
    left, right = ["x", "y", "z", "v", *w[4:]], [*w[:-4], "x", "y", "z", "v"]
    rows = [(1, " ".join(left)), (2, " ".join(right)), (3, " ".join(w))]
    assert [c for *_, c in brute(rows)] == [1, 1, 1] and [c for *_, c in brute(rows[:2])] == [1, 2]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(N.near_duplicates(df, words=4)) == brute(rows)
    assert [x.doc_id for x in N.near_deduplicated(df, words=4).collect()] == [1]


def test_repeated_id_with_two_texts_that_have_near_copies(spark):
    a, b = prose(41, 60, 4000), prose(42, 60, 4000)
    rows = [(0, a + " x"), (5, a), (5, b), (6, b + " y"), (9, "z " + b), (5, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(c for *_, c in brute(rows)) == [0, 0, 5, 5, 5, 5]
    assert result(N.near_duplicates(df, words=4)) == brute(rows)
    assert sorted(map(tuple, N.near_deduplicated(df, words=4).collect())) == [(0, a + " x"), (5, b)]


def test_empty_tables(spark, empty):
    assert N.near_duplicates(empty, words=4).count() == 0
    assert N.near_deduplicated(empty, words=4).count() == 0
    only = spark.createDataFrame([(1, None, None, None), (2, "", None, None)], empty.schema)
    assert result(N.near_duplicates(only, words=4)) == [(1, 0, 1), (2, 0, 2)]


def test_hot_group_of_copies(spark):
    hot = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("a b c d e f g")).otherwise(
        F.concat_ws(" ", F.lit("q"), F.col("id"), F.col("id") + 7, F.col("id") * 3, F.lit("z"))).alias("text"))
    got = N.near_duplicates(hot, words=4).groupBy("component_id").count().filter("count > 1").collect()
    assert [tuple(x) for x in got] == [(0, 300)]


def all_sets(rows, k=4):
    return {i: N.shingles_of(N.words_of(t), k) for i, t in rows}


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_no_similar_pair_is_missed_by_its_differences(spark, tmp_path, percent):
    """Against all pairs: one reference for nodes of very different distance,
    nodes with the same edits, several references, every node a component."""
    r = random.Random(percent)
    base = prose(90, 70, 3000).split()
    rows = [(0, " ".join(base))] + family(r, base, 70, 1, 8)
    for i, t in rows[1:40]:  # near to one far from the reference
        w = t.split()
        w[r.randrange(70)] = "q"
        rows.append((100 + i, " ".join(w)))
    rows += [(300 + i, prose(700 + i, 60, 3000)) for i in range(10)] + [(400, " ".join(base[:30])), (401, " ".join(base[:31]))]
    sets = all_sets(rows)
    texts = spark.createDataFrame(rows, "node long, text string")
    similar = {(a, b) for a in sets for b in sets if a > b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    for n, ref in enumerate((0, 7, 300)):
        refs = texts.filter(F.col("node") != ref).select(F.lit(ref).cast("long").alias("ref"), "node")
        diffs = N.differences(refs, texts, 4).cache()
        assert {x.node: (x.n, x.n_ref, x.d) for x in diffs.collect()} == {
            i: (len(s), len(sets[ref]), len(s ^ sets[ref])) for i, s in sets.items() if i != ref}
        near = {i for i in sets if (max(i, ref), min(i, ref)) in similar}
        c = F.when(F.col("node").isin(*near), ref).otherwise(F.col("node")) if near else F.col("node")
        met = {(x.a, x.b) for x in N.met_by_difference(diffs.withColumn("c", c), percent, f"{tmp_path}/{n}").collect()}
        want = {(a, b) for a, b in similar if ref not in (a, b) and not {a, b} <= near}
        assert want <= met, want - met


def test_large_group_gives_few_pairs(spark, tmp_path):
    """A thousand copies of one text with one to eight edits each: those near
    to the reference against those that are not."""
    r = random.Random(11)
    base = prose(91, 150, 9000).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 1001):
        w = list(base)
        for at in r.sample(range(150), r.randint(1, 8)):
            w[at] = f"e{r.randrange(10 ** 9)}"
        rows.append((i, " ".join(w)))
    texts = spark.createDataFrame(rows, "node long, text string").repartition(4)
    diffs = N.differences(texts.filter("node > 0").select(F.lit(0).cast("long").alias("ref"), "node"), texts, 4)
    near = 180 * F.col("d") <= 20 * (F.col("n") + F.col("n_ref"))
    met = N.met_by_difference(diffs.withColumn("c", F.when(near, 0).otherwise(F.col("node"))), 80, f"{tmp_path}/x")
    sets = all_sets(rows)
    far = [i for i, s in sets.items() if i and 9 * len(s ^ sets[0]) > len(s) + len(sets[0])]
    want = {(max(a, b), min(a, b)) for a in far for b in sets if b and a != b and 9 * len(sets[a] ^ sets[b]) <= len(sets[a]) + len(sets[b])}
    got = {(x.a, x.b) for x in met.collect()}
    assert want <= got and len(far) > 200 and len(got) < 2000


def test_row_keys_tell_nulls_apart(spark):
    from pricelake.llm.common import row_key
    rows = [(None, None), (None, ""), (None, "-"), (1, None), (1, ""), (1, "=\n"), (11, "a"), (1, "1a")]
    df = spark.createDataFrame(rows, "i long, t string")
    assert df.select(row_key("i", "t")).distinct().count() == len(rows)


@pytest.mark.parametrize("words", [1, 5])
def test_other_shingles_against_brute_force(spark, nasty, words):
    assert result(N.near_duplicates(nasty, words=words)) == brute(nasty_rows(), words)
    r = random.Random(words)
    rows = family(r, prose(13, 90, 5000).split(), 50, 0, 6) + family(r, prose(14, 120, 5000).split(), 50, 100, 7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(N.near_duplicates(df, words=words)) == brute(rows, words)


def test_five_words_unless_the_contract_asks_for_four(nasty):
    assert result(N.near_duplicates(nasty)) == brute(nasty_rows(), 5)
