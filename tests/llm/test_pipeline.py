"""Every stage of the pipeline, on its own input, against brute force."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from pricelake.llm import langid, tokens
from pricelake.llm.common import run_folder, stored, table

from .test_decontaminate import brute as contaminated
from .test_mixing import filled, size_of
from .test_near_dedup import brute as grouped

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, folder = table(spark, SF, "documents"), run_folder(spark, "test-pipeline")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), f"{folder}/{name}")
        out.append(docs)
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]


def test_stage_names_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "token_shards"]
    assert all(s.columns == steps[0].columns for s in steps[:5])


def test_language_stage(steps):
    pred = {r.doc_id: r for r in langid.identify(steps[0]).collect()}
    want = [r for r in rows(steps[0]) if pred[r[0]].lang_pred != "und" and pred[r[0]].score >= 0.5]
    assert sorted(rows(steps[1])) == sorted(want) and len(want) > 150
    assert all(any(c.isalpha() for c in r[1]) for r in want)


def test_near_dedup_stage(steps):
    before = rows(steps[1])
    keep = {d for d, _, c in grouped(before, 5) if d == c}
    assert sorted(rows(steps[2])) == sorted(r for r in before if r[0] in keep)


def test_decontamination_stage(spark, steps):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    before = rows(steps[2])
    bad = {x[0] for x in contaminated(before, items) if x[4]}
    assert bad and sorted(rows(steps[3])) == sorted(r for r in before if r[0] not in bad)


def test_mixing_stage(steps):
    before, after = rows(steps[3]), rows(steps[4])
    sizes, taken = {}, {}
    for _, t, _, s in before:
        sizes[s] = sizes.get(s, 0) + size_of(t)
    for _, t, _, s in after:
        taken[s] = taken.get(s, 0) + size_of(t)
    target = filled(sizes)
    assert set(after) <= set(before) and max(after.count(r) for r in set(after)) <= 2
    for s in sizes:
        assert abs(taken.get(s, 0) - target[s]) <= max(size_of(t) for _, t, _, x in before if x == s)


def test_token_stage_and_run(spark, steps):
    tk = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    start, want = 0, []
    for d, t, *_ in sorted(rows(steps[4]), key=lambda r: r[0]):
        ids = np.asarray(tk.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted(tuple(r) for r in steps[5].select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == want
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == want


def test_entry_point_lists_all():
    import __spark_entry__
    q = __spark_entry__.queries()
    assert {f"op{i}" for i in range(1, 11)} <= {k.split("_")[0] for k in q} and "pipeline" in q
    assert set(__spark_entry__.oracle_sql()) <= set(q)
