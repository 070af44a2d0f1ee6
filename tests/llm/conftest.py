"""Fixtures for the training-data operators: a nasty documents table."""

import random

import pytest

#: Names that the operators use inside; no input column may disturb them.
CLASHING = ("digest", "norm", "salt", "kept", "node", "bucket", "row_key", "part", "chunk", "size", "rank", "target",
            "label", "word", "n", "spans", "items", "n_words", "shard", "upto", "last", "text_hash", "lang_pred", "score", "_key", "_m", "_n")


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{int(r.paretovariate(0.7)) % vocabulary}" for _ in range(n))


def nasty_rows():
    """(doc_id, text, lang, source): nulls everywhere, empty and long texts,
    copies, near copies, repeated rows."""
    base = prose(1, 60)
    near = base.split()
    near[30] = "changed"
    words = {"en": "the of and that with this from there which".split(), "de": "der die und nicht ist ein auch sich über".split()}
    r = random.Random(5)
    rows = [(i, " ".join(r.choice(words[lang]) for _ in range(20)) + f" x{i}y", lang, f"s{i % 4}")
            for i in range(40) for lang in [("en", "de")[i % 2]]]
    rows += [
        (100, base, "en", "s0"), (101, base.upper(), "en", "s0"), (102, " ".join(near), "en", "s1"), (103, base + "  \n", None, "s1"),
        (104, None, "en", "s0"), (105, "", None, None), (106, "   \t\n", "en", "s2"), (107, "!!! 123 ???", "en", None),
        (108, "ÄÖ É ſK İstanbul ΟΔΟΣ é H̱ <|endoftext|> x", "de", "s3"), (109, prose(2, 30_000, 3000), "en", "s3"),
        (110, "a" * 20_000, "en", "s3"), (None, base, "en", None), (None, prose(3, 40), None, "s1"), (None, None, None, None),
        (111, "one two three", "en", "s1"), (112, "ONE two  three", "en", "s1"), (113, "\x1c\x1d x\x0by\x85z", "en", "s1"),
        (1, prose(4, 50), "en", "s1"), (100, base, "en", "s0"),
    ]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def nasty(spark):
    from pyspark.sql import functions as F
    d = spark.createDataFrame(nasty_rows(), SCHEMA).repartition(4)
    return d.select("*", *[F.lit("clash").alias(c) for c in CLASHING]).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *order):
    """Collected rows as dicts, nulls first."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(out, key=lambda r: [(r[c] is not None, r[c] if r[c] is not None else 0) for c in order])
