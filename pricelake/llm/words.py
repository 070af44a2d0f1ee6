"""Corpus word counts, combined before they are shuffled."""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Runs of letters (and of letter-like numerals, which \d leaves out).
LETTERS = re.compile(r"[^\W\d_]+")
#: Distinct (label, word) pairs a task holds before it passes its counts on.
HELD = 400_000


def count_words(docs: DataFrame, text_col: str = "text", label_col: str | None = None,
                longest: int | None = 40) -> DataFrame:
    """(label, word, n): how often each lower-cased word occurs under each
    label, over whole texts.  Words over ``longest`` letters, if given, are
    not counted.  Each task counts locally and hands on its sums whenever it
    holds ``HELD`` pairs or much text in long words, so memory is bounded and frequent words travel once
    per task, not once per occurrence."""
    schema = pa.schema([("label", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def count(batches):
        held: dict[str | None, Counter] = {}
        long = 0

        def out():
            for label, c in held.items():
                yield pa.record_batch([pa.array([label] * len(c), pa.string()), pa.array(list(c), pa.string()),
                                       pa.array(list(c.values()), pa.int64())], schema=schema)
            held.clear()

        for b in batches:
            for label, text in zip(b.column(0), b.column(1)):
                words = LETTERS.findall((text.as_py() or "").lower())
                held.setdefault(label.as_py(), Counter()).update(w for w in words if longest is None or len(w) <= longest)
                if longest is None:
                    long += sum(n for n in map(len, words) if n > 40)
                if sum(map(len, held.values())) > HELD or long > 100 * HELD:
                    yield from out()
                    long = 0
        yield from out()

    label = F.lit(None).cast("string") if label_col is None else F.col(label_col).cast("string")
    return (docs.select(label.alias("label"), F.col(text_col).alias("text"))
            .mapInArrow(count, "label string, word string, n long")
            .groupBy("label", "word").agg(F.sum("n").alias("n")))
