"""Secrets: fixed patterns, and guess costs of credential-context values.

Base kinds (assign, access, hex) are the fixed patterns; they always stay.
The method adds ``cred`` spans: values in further credential contexts
(``pwd:``, ``passphrase=``, ``Bearer ...``, user:password@ in URLs, ...)
whose cheapest explanation still costs an attacker ``MIN_COST`` orders of
magnitude of guesses.  The cost of a value is the minimum, over all ways to
cut it into spans, of the spans' log10 guesses:

* words: the rank in the corpus's own word frequencies (counted over all
  whole texts, every word ranked), with capitals extra;
* dates: day, month and year in the usual orders;
* repeats: one character's cost times the run length;
* keyboard walks: start key, length and turns;
* brute force: the alphabet of each character.

The texts are scanned once for spans and values.  Values and the words inside
them are few beside the corpus: each distinct value's letter sequences are
joined to the table of all ranked words, and the value is costed with those
that are words, so nothing that grows with the corpus is broadcast or held.

Defined results: null texts are empty; a base assign value gets its cost as
well (``cost``), the other base kinds have none; added spans never overlap
base spans; an empty corpus has no words, and dates, repeats and walks still
count.  Offsets are code points, ends exclusive.  Values of any length are
costed whole, in time linear in the length.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import running_total
from .common import run_folder, stored, table
from .pii import listed
from .words import LETTERS, count_words

# The contract's kinds in their order and patterns.
BASE = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
CONTEXTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

CRED = re.compile(
    r"""(?<![A-Za-z0-9])(?:pwd|passphrase|passcode|pass|credentials?|auth[_-]?key|private[_-]?key|access[_-]?key|bearer)"""
    r"""["']?(?:\x20*[:=]\x20*|\x20+(?=\S*[0-9]))["']?([^\s"'<>,;]{8,})"""
    r"""|://[^\s/:@]+:([^\s/@]{4,})@""", re.I | re.A)
CRED_WORDS = ("pwd", "pass", "credential", "key", "bearer", "://")
#: log10 guesses from which an added value counts as a secret.
MIN_COST = 10.0
#: Letters a dictionary word has (a counted word has at most 40).
SHORTEST, LONGEST = 3, 40

# Rows of the usual keyboards, for walks.
KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertzuiop", "azertyuiop")
NEXT = {(a, b) for row in KEYBOARD for x, y in zip(row, row[1:]) for a, b in ((x, y), (y, x))}
#: Words that head any guesser's list, whatever the corpus.
COMMON = ("password", "secret", "admin", "welcome", "letmein", "login", "changeme", "default", "example", "test")
DATE = re.compile(
    r"(?:(?:19|20)[0-9]{2}([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12][0-9]|3[01])"
    r"|(?:0[1-9]|[12][0-9]|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)[0-9]{2}"
    r"|(?:0[1-9]|1[0-2])([-/._]?)(?:0[1-9]|[12][0-9]|3[01])\3(?:19|20)[0-9]{2})|(?:19|20)[0-9]{2}")


def one(c: str) -> float:
    """log10 guesses of one character by brute force."""
    return math.log10(10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 1000)


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """log10 of the guesses of the cheapest segmentation of ``value``."""
    low, n = value.lower(), len(value)
    best = [0.0] + [math.inf] * n
    if len(low) != n:  # lower-casing changed the length: no letter-case rules then
        low = value
    dates = {}
    if re.search("[0-9]{4}", low):
        for i in range(n):
            if low[i].isdigit() and (m := DATE.match(low, i)):
                dates[i] = (m.end(), 2.1 if m.end() - i == 4 else 4.6)
                if m.end() - i != 4 and low[i:i + 2] in ("19", "20"):
                    dates[i, 4] = (i + 4, 2.1)
    same = _run_ends(low, lambda x, y: x == y)
    walk = _run_ends(low, lambda x, y: (x, y) in NEXT)
    for i in range(n):
        here = best[i]

        def reach(end, cost):
            best[end] = min(best[end], here + cost)

        reach(i + 1, one(low[i]) + (0.3 if value[i] != low[i] else 0))
        for key in (i, (i, 4)):
            if key in dates:
                reach(*dates[key])
        # a run may give its last character to what follows
        for end in {same[i], same[i] - 1}:
            if end - i >= 3:
                reach(end, one(low[i]) + math.log10(end - i))
        for end in {walk[i], walk[i] - 1}:
            if end - i >= 4:
                reach(end, math.log10(47 * (end - i)) + 0.5)
        if ranks and low[i].isalpha():
            for end in range(i + SHORTEST, min(n, i + LONGEST) + 1):
                rank = ranks.get(low[i:end])
                if rank is not None:
                    upper = sum(x != y for x, y in zip(value[i:end], low[i:end]))
                    capitals = 0 if not upper else 0.3 if upper in (1, end - i) else 0.3 * upper
                    reach(end, max(math.log10(rank + 1), 0.1) + capitals)
    return best[n]


def _run_ends(low: str, joined) -> list[int]:
    """Per position the end of the run of ``joined`` neighbours it is in."""
    ends = list(range(1, len(low) + 1))
    for i in range(len(low) - 2, -1, -1):
        if joined(low[i], low[i + 1]):
            ends[i] = ends[i + 1]
    return ends


def candidates(text: str | None) -> list[tuple[str, int, int, str | None]]:
    """(kind, start, end, value to cost or null) by start, then kind: the base
    spans, and those that are added if their value costs enough."""
    text = text or ""
    low, out = text.lower(), []
    if any(w in low for w in CONTEXTS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 8:
                out.append(("assign", *m.span(), m[2]))
    if "AKIA" in text:
        out += [("access", *m.span(), None) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [("hex", *m.span(), None) for m in HEX.finditer(text)]
    if any(w in low for w in CRED_WORDS) and (more := list(CRED.finditer(text))):
        taken = bytearray(len(text))  # one mark per code point
        for _, a, b, _ in out:
            taken[a:b] = b"\1" * (b - a)
        for m in more:
            if 1 not in taken[m.start():m.end()]:
                out.append(("cred", *m.span(), m[1] or m[2]))
    order = (*BASE, "cred")
    out.sort(key=lambda x: (x[1], order.index(x[0])))
    return out


def find(text: str | None, ranks: dict[str, int]) -> list[dict]:
    """All spans of one text by start, then kind."""
    out = [(k, a, b, None if v is None else guess_cost(v, ranks)) for k, a, b, v in candidates(text)]
    return [{"kind": k, "start": a, "end": b, "cost": c, "base": k != "cred"} for k, a, b, c in out if k != "cred" or c >= MIN_COST]


def inside(value: str) -> set[str]:
    """The letter sequences of a value that a dictionary word could be."""
    low = value.lower()
    if len(low) != len(value):
        low = value
    return {low[i:j] for m in LETTERS.finditer(low) for i in range(m.start(), m.end())
            for j in range(i + SHORTEST, min(m.end(), i + LONGEST) + 1)}


def word_ranks(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, rank): COMMON from rank 0, then all other words of all texts by
    frequency.  Ranks are counted over ranges, in no single task."""
    counted = (count_words(docs, text_col).filter(F.length("word").between(SHORTEST, LONGEST) & ~F.col("word").isin(*COMMON))
               .withColumn("rare", -F.col("n")))
    ranked = running_total(counted, ["rare", "word"], "upto").select("word", (F.col("upto") + len(COMMON) - 1).alias("rank"))
    common = docs.sparkSession.createDataFrame([(w, i) for i, w in enumerate(COMMON)], "word string, rank long")
    return ranked.unionByName(common)


def costs(values: DataFrame, ranks: DataFrame) -> DataFrame:
    """(value, cost) of the distinct ``values(value)``."""
    def split(batches):
        for b in batches:
            for v in b.column(0).to_pylist():
                words = list(inside(v))
                for i in range(0, max(1, len(words)), 50_000):
                    part = words[i:i + 50_000]
                    yield pa.record_batch([pa.array([v] * len(part), pa.string()), pa.array(part, pa.string())], names=["value", "word"])

    def judge(batches):
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([
                guess_cost(v, {x["word"]: x["rank"] for x in known or ()}) for v, known in zip(b.column(0).to_pylist(), b.column(1).to_pylist())],
                pa.float64())], names=["value", "cost"])

    # a value's words are bounded by its own length
    known = (values.mapInArrow(split, "value string, word string").join(ranks, "word")
             .groupBy("value").agg(F.collect_list(F.struct("word", "rank")).alias("known")))
    return values.join(known, "value", "left").select("value", "known").mapInArrow(judge, "value string, cost double")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans: kind, start, end, cost (log10 guesses or null), base."""
    folder = run_folder(docs.sparkSession, "secrets")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))

    def search(batches):
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([[dict(zip(("kind", "start", "end", "value"), x)) for x in candidates(t.as_py())]
                                                          for t in b.column(1)], kind)], names=["doc_id", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.mapInArrow(search, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
                           "spans array<struct<kind string, start int, end int, value string>>")
    # numbered once: the files keep the numbers
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), f"{folder}/spans")
    costed = rows.select("row", F.posexplode("spans").alias("at", "x")).where("x.value IS NOT NULL").select("row", "at", "x.value")
    cost = stored(costs(costed.select("value").distinct(), word_ranks(docs, text_col)), f"{folder}/costs")
    # a row's spans are bounded by its text
    per_row = (costed.join(cost, "value").groupBy("row")
               .agg(F.map_from_entries(F.collect_list(F.struct("at", "cost"))).alias("cost")))
    spans = F.transform("spans", lambda x, i: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
        F.try_element_at(F.col("cost"), i).alias("cost"), (x["kind"] != "cred").alias("base")))
    found = F.filter(spans, lambda x: x["base"] | (x["cost"] >= MIN_COST))
    return rows.join(per_row, "row", "left").select("doc_id", found.alias("spans"))


def query(spark, sf_dir):
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["base"])

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"), count("cred"),
                        F.round(F.array_max(F.transform("spans", lambda x: x["cost"])), 6).alias("top_cost"))
