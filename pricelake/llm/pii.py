"""Personal data: patterns propose spans, checksums confirm, context scores.

Base kinds (email, ip, card, phone) are the fixed patterns with their
validators; a confirmed base span always stays, whatever its score.  The
method adds spans of further kinds, each proposed by a pattern, confirmed by
a validator and kept from ``THRESHOLD`` points on:

* iban: country and check digits, mod-97 of the rearranged digits is 1;
* pan: card numbers of 13 to 15 digits that pass Luhn;
* ssn: 3-2-4 digits in the ranges that are given out;
* tel: numbers in national form, ten digits with a separated area code.

The points are the kind's own (a strong checksum is worth more), plus a bonus
for one of the kind's context words among the ``NEAR`` code points on either
side, minus one for words that speak against it ("order", "invoice", ...).
Added spans never overlap a base span nor each other.

Offsets are code points, ends exclusive.  Each text is searched whole in the
task that holds its row; no pattern backtracks over more than one run.
Defined results: null texts are empty and give no spans; null ids stay null;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

# The contract's kinds in their order and patterns (possessive
# where that can't change a match).
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "pan", "ssn", "tel")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
TEL = re.compile(r"(?<![0-9+().-])\(?[2-9][0-9]{2}\)?[\x20.-][2-9][0-9]{2}[\x20.-][0-9]{4}(?![0-9-])")

NEAR, THRESHOLD = 48, 0.6
#: Points of a confirmed span without context.
POINTS = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "pan": 0.4, "ssn": 0.3, "tel": 0.3}
BONUS, MALUS = 0.3, 0.4
CONTEXT = {
    "email": ("mail", "contact", "write to"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "transfer"),
    "pan": ("card", "amex", "visa", "credit", "payment"),
    "ssn": ("ssn", "social security", "tax id"),
    "tel": ("phone", "call", "tel", "mobile", "fax"),
}
AGAINST = ("order", "invoice", "isbn", "version", "serial", "tracking", "sample", "example number")


def luhn(digits: str) -> bool:
    """Luhn check of a string of digits."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064 check of an account number without blanks."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def propose(text: str):
    """Confirmed (kind, start, end) of the base kinds, by kind, then start."""
    if "@" in text:
        yield from (("email", *m.span()) for m in _emails(text))
    yield from (("ip", *m.span()) for m in IP.finditer(text) if all(map(_byte, m[0].split("."))))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", *m.span()
    if "+" in text:
        yield from (("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15)


def _emails(text: str):
    """The pattern's leftmost matches.  A match starts at the start of a run
    of local characters (or at the end of the match before), and only a run
    that ends at an @ can hold one, so the search starts there."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and (c := text[start - 1]) < "\x80" and (c.isalnum() or c in "._%+-"):
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            yield m
            done = m.end()
        at = text.find("@", max(at + 1, done))


def propose_more(text: str):
    """Confirmed (kind, start, end) of the added kinds."""
    for m in IBAN.finditer(text):
        if 15 <= len(x := m[0].replace(" ", "")) <= 34 and mod97(x):
            yield "iban", *m.span()
    for m in CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 29 and 13 <= len(d := _digits(m[0])) <= 15 and luhn(d):
            yield "pan", *m.span()
    for m in SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            yield "ssn", *m.span()
    yield from (("tel", *m.span()) for m in TEL.finditer(text))


def points(text: str, kind: str, start: int, end: int) -> float:
    """The kind's points, adjusted by the words around the span."""
    around = f"{text[max(0, start - NEAR):start]} {text[end:end + NEAR]}".lower()

    def has(words):
        return any(re.search(rf"\b{re.escape(w)}", around) for w in words)

    x = POINTS[kind] + BONUS * has(CONTEXT[kind]) - MALUS * has(AGAINST)
    return round(min(1.0, max(0.0, x)), 3)


def find(text: str | None) -> list[dict]:
    """All spans of one text: kinds in their order, then by start."""
    text = text or ""
    out = [{"kind": k, "start": a, "end": b, "score": points(text, k, a, b), "base": True} for k, a, b in propose(text)]
    more, taken = [], None
    for k, a, b in propose_more(text):
        if (p := points(text, k, a, b)) < THRESHOLD:
            continue
        if taken is None:  # one mark per code point
            taken = bytearray(len(text))
            for x in out:
                taken[x["start"]:x["end"]] = b"\1" * (x["end"] - x["start"])
        if 1 not in taken[a:b]:
            more.append({"kind": k, "start": a, "end": b, "score": p, "base": False})
            taken[a:b] = b"\1" * (b - a)
    return out + sorted(more, key=lambda x: (ADDED.index(x["kind"]), x["start"]))


SPANS = "array<struct<kind string, start int, end int, score double, base boolean>>"


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans: kind, start, end, score and whether it is a base kind."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("score", pa.float64()), ("base", pa.bool_())]))

    def search(batches):
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([find(t.as_py()) for t in b.column(1)], kind)],
                                  names=["doc_id", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(search, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = 0.0) -> DataFrame:
    """doc_id and the text with every span of ``min_score`` replaced by its kind."""
    def cut(batches):
        for b in batches:
            out = []
            for t in b.column(1):
                text, done, parts = t.as_py() or "", 0, []
                for x in sorted(find(text), key=lambda x: (x["start"], -x["end"])):
                    if x["score"] >= min_score and x["start"] >= done:
                        parts += [text[done:x["start"]], f"<{x['kind']}>"]
                        done = x["end"]
                out.append("".join([*parts, text[done:]]))
            yield pa.record_batch([b.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def listed(spans):
    """Comma-joined kind:start:end."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def query(spark, sf_dir):
    found = find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["base"])

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"),
                        F.size(F.filter("spans", lambda x: ~x["base"])).cast("long").alias("n_added"),
                        F.array_max(F.transform("spans", lambda x: x["score"])).alias("top_score"))
