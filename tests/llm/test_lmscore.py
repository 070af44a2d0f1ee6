import math
from collections import Counter

import numpy as np
import pytest

from pricelake.llm import lmscore as M
from pricelake.llm.near_dedup import words_of

from .conftest import nasty_rows, rows_of


def grams(w, order):
    return Counter(tuple(w[i:i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1))


def brute(texts, order, alpha=0.4):
    words = [words_of(t) for t in texts]
    own = [grams(w, order) for w in words]
    corpus = sum(own, Counter())
    total, out = sum(map(len, words)), []
    for w, mine in zip(words, own):
        s = 0.0
        for i in range(len(w)):
            given_up = 0
            for k in range(min(order, i + 1), 0, -1):
                g = tuple(w[i - k + 1:i + 1])
                c = corpus[g] - mine[g]
                if k == 1:
                    s += math.log10((c or 0.5) / max(1, total - len(w)))
                elif c:
                    s += math.log10(c / (corpus[g[:-1]] - mine[g[:-1]]))
                    break
                else:
                    s += math.log10(alpha)
        out.append((len(w), s if w else None))
    return out


@pytest.mark.parametrize("order,chunk,part", [(1, 10**7, 10**7), (2, 700, 500), (3, 2000, 1000), (4, 10**7, 300)])
def test_against_brute_force(nasty, monkeypatch, order, chunk, part):
    monkeypatch.setattr(M, "CHUNK_CHARS", chunk)
    monkeypatch.setattr(M, "PART_CHARS", part)
    rows = [r for r in nasty_rows()]
    want = sorted(((d, n, s) for (d, *_), (n, s) in zip(rows, brute([t for _, t, *_ in rows], order))), key=lambda x: (str(x[0]), x[1], x[2] or 0))
    got = sorted(((r["doc_id"], r["n_words"], r["log10_score"]) for r in rows_of(M.lm_scores(nasty, order=order), "doc_id")),
                 key=lambda x: (str(x[0]), x[1], x[2] or 0))
    assert [x[:2] for x in got] == [x[:2] for x in want]
    for (_, _, a), (_, _, b) in zip(got, want):
        assert a == b if b is None else a == pytest.approx(b, abs=1e-6)


def test_blocks_round_trip():
    x = np.array([0, 1, 255, 256, 2**63, 2**64 - 1], np.uint64)
    assert M.unpack(M.pack(x)).tolist() == x.tolist() and len(M.unpack(M.pack(x[:0]))) == 0


def test_empty_and_alone(spark, empty):
    assert M.lm_scores(empty).count() == 0
    one = spark.createDataFrame([(1, "a b a", None, None), (2, None, None, None)], empty.schema)
    a, b = rows_of(M.lm_scores(one), "doc_id")
    assert a["log10_score"] == pytest.approx(3 * math.log10(0.5) + 3 * math.log10(0.4)) and b["log10_score"] is None and b["n_words"] == 0
