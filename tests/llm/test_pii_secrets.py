import hashlib
import itertools
import math
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricelake.llm import pii as P
from pricelake.llm import secrets as S

from .conftest import nasty_rows, rows_of


def brute_pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 16 <= len(d) <= 19:
            total = 0
            for i, x in enumerate(reversed(d)):
                x = x * 2 if i % 2 else x
                total += x - 9 if x > 9 else x
            if total % 10 == 0:
                out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def base(found):
    return [(x["kind"], x["start"], x["end"]) for x in found if x["base"]]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.1205 9+-()Zé%_\n", max_size=60))
def test_base_pii_is_the_contract(t):
    assert base(P.find(t)) == brute_pii(t)


def test_base_pii_planted():
    t = "é mail a.b+c@x-y.example.org, card 4111 1111 1111 1111, bad 4111111111111112, ip 10.0.0.255 and 10.0.0.256, call +1 (743) 555-3824."
    assert base(P.find(t)) == brute_pii(t) and [k for k, *_ in base(P.find(t))] == ["email", "ip", "card", "phone"]


def test_added_kinds_need_checksum_and_context():
    def added(t):
        return [(x["kind"], t[x["start"]:x["end"]]) for x in P.find(t) if not x["base"]]
    assert added("bank account DE89 3704 0044 0532 0130 00 please") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert added("bank account DE88 3704 0044 0532 0130 00 please") == []
    assert added("amex card 378282246310005 ok") == [("pan", "378282246310005")]
    assert added("order 378282246310005 ok") == []
    assert added("his ssn: 123-45-6789") == [("ssn", "123-45-6789")] and added("part 123-45-6789") == []
    assert added("call (743) 555-3824 now") == [("tel", "(743) 555-3824")] and added("x (743) 555-3824 y") == []
    assert P.mod97("GB82WEST12345698765432") and not P.mod97("GB83WEST12345698765432")


def test_pii_query_columns(nasty, spark):
    got = rows_of(P.find_pii(nasty), "doc_id")
    assert len(got) == len(nasty_rows())
    assert P.find(None) == [] and P.find("") == []
    d = spark.createDataFrame([(1, "a@b.cd 1.2.3.4"), (2, None)], "doc_id long, text string")
    assert [r.text for r in P.redacted(d).orderBy("doc_id").collect()] == ["<email> <ip>", ""]


def test_long_runs_are_linear():
    for t in ("1" * 300_000, "a" * 300_000 + "@", "+" + "1(" * 100_000, "@" * 100_000, "1.1" * 50_000):
        P.find(t)
        S.find(t, {})


def brute_secrets(t):
    out = [("assign", *m.span()) for m in re.finditer(
        r"""(?a:(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)))""", t) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out, key=lambda x: (x[1], S.BASE.index(x[0])))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "PASSWORD", "api_key", "apikey", "ſecret", "secret", " = ", ":", '"', "'", "abcdef01", "AKIA", "ABCDEFGH1234",
                                 "0123456789abcdef", " ", "\n", "é", "pwd: ", "-"]), max_size=12))
def test_base_secrets_are_the_contract(parts):
    t = "".join(parts)
    assert base(S.find(t, {})) == brute_secrets(t)


def brute_cost(v, ranks):
    """Every segmentation into single characters, words, full runs."""
    def span(i, j):
        low, s = v.lower(), v[i:j]
        costs = [S.one(low[i]) + (0.3 if v[i] != low[i] else 0)] if j == i + 1 else []
        if low[i:j] in ranks and j - i >= S.SHORTEST:
            upper = sum(a != b for a, b in zip(s, low[i:j]))
            costs.append(max(math.log10(ranks[low[i:j]] + 1), 0.1) + (0 if not upper else 0.3 if upper in (1, j - i) else 0.3 * upper))
        if j - i >= 3 and len(set(low[i:j])) == 1 and (j == len(v) or low[j] != low[i] or j + 1 == len(v) or low[j + 1] != low[i]):
            costs.append(S.one(low[i]) + math.log10(j - i))
        if j - i >= 4 and all((a, b) in S.NEXT for a, b in zip(low[i:j], low[i + 1:j])):
            k = j
            while k < len(v) and (low[k - 1], low[k]) in S.NEXT:
                k += 1
            if k - j <= 1:
                costs.append(math.log10(47 * (j - i)) + 0.5)
        if S.DATE.fullmatch(s):
            costs.append(2.1 if j - i == 4 else 4.6)
        return min(costs, default=math.inf)

    n = len(v)
    return min(sum(span(a, b) for a, b in itertools.pairwise([0, *cut, n]))
               for k in range(n) for cut in itertools.combinations(range(1, n), k))


@pytest.mark.parametrize("v", ["qwerty123", "Password1", "aaaab", "the1999cat", "xkcd!", "aaa111", "asdfgh", "CaTcat", "20191224x", "zxcvb"])
def test_guess_cost_is_the_cheapest_segmentation(v):
    ranks = {"password": 0, "the": 1, "cat": 5, "catcat": 9000}
    assert S.guess_cost(v, ranks) == pytest.approx(brute_cost(v, ranks))


def test_context_values_are_added_by_cost():
    ranks = {"password": 0, "welcome": 1, "the": 2}

    def added(t):
        return [t[x["start"]:x["end"]] for x in S.find(t, ranks) if not x["base"]]
    assert added("pwd: x9$Kq!72Lm#vT") == ["pwd: x9$Kq!72Lm#vT"]
    assert added("pwd: welcome123") == [] and added("passphrase = passwordpassword") == []
    assert added("postgres://bob:g7#kQ2!zWq9@host/db") == ["://bob:g7#kQ2!zWq9@"]
    assert added("pass the salt quickly") == []
    assert S.guess_cost("", ranks) == 0.0


def test_secrets_query(nasty, empty, spark):
    assert len(rows_of(S.find_secrets(nasty), "doc_id")) == len(nasty_rows())
    assert S.find_secrets(empty).count() == 0 and P.find_pii(empty).count() == 0
    d = spark.createDataFrame([(1, 'x token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" y')], "doc_id long, text string")
    (r,) = rows_of(S.find_secrets(d), "doc_id")
    joined = ",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in r["spans"] if x["base"])
    assert joined == "assign:2:51,hex:11:51" and len(hashlib.sha256(joined.encode()).hexdigest()) == 64
    r = random.Random(0)
    assert S.guess_cost("".join(r.choice("abcdefghijkmnpqrstuvwxyz23456789!#") for _ in range(50_000)), {}) > 10_000


def ranked(texts):
    """All words of all texts, by frequency, behind the common ones."""
    from collections import Counter

    from pricelake.llm.words import LETTERS
    n = Counter(w for t in texts for w in LETTERS.findall((t or "").lower()) if S.SHORTEST <= len(w) <= S.LONGEST and w not in S.COMMON)
    words = [*S.COMMON, *sorted(n, key=lambda w: (-n[w], w))]
    return {w: i for i, w in enumerate(words)}


def test_every_corpus_word_has_its_rank(spark):
    """More words than any fixed dictionary; each may be inside a value."""
    r = random.Random(8)
    vocabulary = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 9))) for _ in range(30_000)]
    texts = [" ".join(r.choice(vocabulary) for _ in range(200)) for _ in range(400)]
    texts += [f"pwd: {r.choice(vocabulary)}{r.choice(vocabulary).title()}{r.randint(1, 99)}{r.choice(['', '!x', 'q'])} end" for _ in range(150)]
    texts += [f'token = "{r.choice(vocabulary)}{r.choice(vocabulary)}" and password: {r.choice(vocabulary)}XX{r.choice(vocabulary)}' for _ in range(100)]
    texts += ["pwd: 1999İİqwerty" + r.choice(vocabulary), None, "", "pwd: " + "ab" * 400, "pwd: aaaa", texts[450], texts[450]]
    ranks = ranked(texts)
    assert len(ranks) > 25_000
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {x["doc_id"]: x["spans"] for x in rows_of(S.find_secrets(d), "doc_id")}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = S.find(t, ranks)
        assert [{k: v for k, v in x.items() if k != "cost"} for x in got[i]] == [{k: v for k, v in x.items() if k != "cost"} for x in want]
        assert [x["cost"] for x in got[i]] == [None if x["cost"] is None else pytest.approx(x["cost"]) for x in want]
    assert {x.word: x["rank"] for x in S.word_ranks(d).collect()} == ranks


def test_secret_query_on_clashing_names(nasty):
    got = rows_of(S.find_secrets(nasty.withColumnRenamed("text", "value").withColumnRenamed("doc_id", "row"), "row", "value"), "doc_id")
    assert len(got) == len(nasty_rows())


def test_pii_on_clashing_names(nasty):
    odd = nasty.withColumnRenamed("text", "spans").withColumnRenamed("doc_id", "kind") if "spans" not in nasty.columns else (
        nasty.drop("spans").withColumnRenamed("text", "spans").withColumnRenamed("doc_id", "kind"))
    got = rows_of(P.find_pii(odd, "kind", "spans"), P.find_pii(odd, "kind", "spans").columns[0])
    assert len(got) == len(nasty_rows())
