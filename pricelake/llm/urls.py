"""URL filters by Bloom filter cascades.

A rule is a key ``host/path-prefix``; a url's candidate keys are its host and
the host's parent domains, each with the path prefixes of the lengths that
listed keys have.  The distinct candidates of all urls are the complete key
universe.  A cascade holds a list exactly over that universe: level 0 encodes
the listed keys, level 1 the other keys of the universe that level 0 lets
through, level 2 the listed keys that level 1 lets through, and so on until a
level lets nothing wrong through.  Urls are then judged in one pass, without
a join, by the broadcast cascades.

Levels are built by Spark: bit positions of the keys, or-ed per 64-bit word.
Level 0 has about 1.44 * log2(1 / p) bits a listed key.  A list of more than
``CLASS_KEYS`` keys is dealt into classes by hash, each with its own cascade
of bounded size and its own pass over the urls, so a broadcast never grows
with the list.

Defined results: a null url, or one without ``://``, has empty host and path
and fits nothing; keys are compared as written (ports and user names are part
of a host); a key on both lists blocks; empty lists or tables are allowed;
rows repeat as they do in the table; other columns are ignored.
"""

from __future__ import annotations

import math
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, run_folder, stored, table

# The contract's rules.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
#: Where no rule fits, a site is blocked if a label of its name has one of
#: these words, alone or between hyphens: the site is that label and all after.
MARKS = ("ad", "ads", "adult", "bet", "bets", "casino", "gambling", "lottery", "pharma", "pills", "poker", "porn", "sex", "spam", "viagra", "xxx")
SITE = rf"(^|\.)(([^.-]*-)*({'|'.join(MARKS)})(-[^.]*)?\..+)$"
CLASS_KEYS = 4_000_000
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def parts(url: str | None) -> tuple[str, str]:
    """(host, path) of a url."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    stop = min((i for i in (rest.find("?", end), rest.find("#", end)) if i >= 0), default=len(rest))
    return rest[:end].translate(_LOWER), rest[end:stop]


def split_key(key: str) -> tuple[str, str]:
    host, slash, path = key.partition("/")
    return host, slash + path


class Shape:
    """How listed keys look: most host labels, and the path lengths."""

    def __init__(self, labels: int, lengths: list[int]):
        self.labels, self.lengths = labels, sorted(lengths, reverse=True)

    def candidates(self, host: str, path: str) -> list[str]:
        """Keys that could fit, longest first (longer hosts before longer paths among equals)."""
        if not host:
            return []
        labels = host.rsplit(".", self.labels)[-self.labels:] if self.labels else []
        hosts = [host] if host.count(".") < self.labels else []
        hosts += [h for i in range(len(labels)) if (h := ".".join(labels[i:])) != host]
        out = [h + path[:n] for h in hosts for n in self.lengths if n <= len(path)]
        return sorted(dict.fromkeys(out), key=len, reverse=True)


class Level:
    """One Bloom filter."""

    def __init__(self, number: int, n: int, p: float, size: tuple[int, int] | None = None):
        """For ``n`` keys at a rate ``p`` of false positives, or of a given
        size (bits, hashes)."""
        self.number = number
        self.m, self.k = size or (max(64, 64 * math.ceil(n * math.log(1 / p) / math.log(2) ** 2 / 64)),
                                  max(1, round(math.log(1 / p) / math.log(2))))
        self.bits = np.zeros(self.m // 64, np.uint64)

    def positions(self, key: str) -> list[int]:
        h = xxhash.xxh3_128_intdigest(key.encode("utf-8", "surrogatepass"), seed=self.number)
        a, b = h & 0xFFFFFFFFFFFFFFFF, (h >> 64) | 1
        return [((a + j * b) & 0xFFFFFFFFFFFFFFFF) % self.m for j in range(self.k)]

    def __contains__(self, key: str) -> bool:
        return all(int(self.bits[x >> 6]) >> (x & 63) & 1 for x in self.positions(key))


class Cascade(list):
    """Levels; exact for every key of the universe it was built over."""

    def __contains__(self, key: str) -> bool:
        for i, level in enumerate(self):
            if key not in level:
                return i % 2 == 1
        return len(self) % 2 == 1


def build(marked: DataFrame, lists: list[str]) -> dict[str, Cascade]:
    """A cascade for each of ``lists`` over ``marked(key, lists)``: the keys of
    the universe with the lists they are on.  All cascades gain a level at a
    time, in the same passes."""
    spark, folder = marked.sparkSession, run_folder(marked.sparkSession, "urls")
    out = {x: Cascade() for x in lists}
    # per list the keys to encode (inside) and to tell apart from them
    rows = marked.select("key", F.explode(F.array(*[
        F.struct(F.lit(x).alias("list"), F.array_contains("lists", x).alias("inside")) for x in lists])).alias("x")).select(
        "key", "x.list", "x.inside")
    number = 0
    while True:
        sizes = {x: [0, 0] for x in lists}
        for r in rows.groupBy("list", "inside").count().collect():  # two rows a list
            sizes[r.list][not r.inside] = r["count"]
        levels = {}
        for x, (n, others) in sizes.items():
            if n:
                p = min(0.5, max(1e-6, n * math.sqrt(2) / max(1, others))) if number == 0 else 0.5
                levels[x] = Level(number, n, p)
        if not levels:
            remove(spark, folder)
            return out
        shape = {x: (v.m, v.k) for x, v in levels.items()}

        def place(batches):
            mine = {x: Level(number, 0, 0.5, size) for x, size in shape.items()}
            for b in batches:
                lists, words, bits = [], [], []
                for key, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    for at in mine[x].positions(key):
                        lists.append(x)
                        words.append(at >> 6)
                        bits.append(1 << (at & 63))
                yield pa.record_batch([pa.array(lists, pa.string()), pa.array(words, pa.int64()),
                                       pa.array(np.array(bits, np.uint64).view(np.int64))], names=["list", "w", "b"])

        # at most one entry per 64-bit word of a filter reaches the driver, as columns
        words = (rows.filter("inside").select("key", "list").mapInArrow(place, "list string, w long, b long")
                 .groupBy("list", "w").agg(F.bit_or("b").alias("b")).toArrow())
        for x, level in levels.items():
            mine = words.filter(pc.equal(words["list"], x))
            level.bits[mine["w"].to_numpy()] = mine["b"].to_numpy().view(np.uint64)
        for x, level in levels.items():
            out[x].append(level)
        shared = spark.sparkContext.broadcast(levels)

        def turn(batches, shared=shared):
            """What passed wrongly is encoded next, told from what is encoded now."""
            for b in batches:
                keep = [(k, x, not i) for k, x, i in zip(*(c.to_pylist() for c in b.columns))
                        if x in shared.value and (i or k in shared.value[x])]
                yield pa.record_batch([pa.array([c[0] for c in keep], pa.string()), pa.array([c[1] for c in keep], pa.string()),
                                       pa.array([c[2] for c in keep], pa.bool_())], names=b.schema.names)

        number += 1
        rows = stored(rows.mapInArrow(turn, "key string, list string, inside boolean"), f"{folder}/{number}")


def filter_urls(pages: DataFrame, rules: DataFrame, sites: DataFrame, id_col: str = "page_id", url_col: str = "url",
                class_keys: int = CLASS_KEYS) -> DataFrame:
    """page_id, host, path, rule, verdict and listed (the blocked site).

    ``rules(verdict, key)``; ``sites(key)`` blocks where no rule fits."""
    spark, folder = pages.sparkSession, run_folder(pages.sparkSession, "urls")
    lists = ["allow", "block", "site"]
    listed = (rules.select(F.col("verdict").alias("list"), "key").unionByName(sites.select(F.lit("site").alias("list"), "key"))
              .filter(F.col("list").isin(lists)).groupBy("key").agg(F.collect_set("list").alias("lists")))
    # a few numbers about the listed keys, bounded by the longest key
    host = F.split_part("key", F.lit("/"), F.lit(1))
    shapes, n_keys = {}, {}
    for r in (listed.withColumn("list", F.explode("lists")).groupBy("list").agg(
            F.max(F.size(F.split(host, r"\."))).alias("labels"), F.collect_set(F.length("key") - F.length(host)).alias("lengths"),
            F.count(F.lit(1)).alias("n")).collect()):
        shapes[r.list], n_keys[r.list] = Shape(r.labels, list(r.lengths)), r.n
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))

    def keys(batches):
        for b in batches:
            found = {k for u in b.column(0).to_pylist() for s in shapes.values() for k in s.candidates(*parts(u))}
            yield pa.record_batch([pa.array(list(found), pa.string())], names=["key"])

    universe = rows.select("url").mapInArrow(keys, "key string").distinct()
    marked = stored(universe.join(listed, "key", "left").withColumn("lists", F.coalesce("lists", F.array().cast("array<string>")))
                    .withColumn("hash", F.xxhash64("key")), folder)
    n = max(1, math.ceil(max(n_keys.values(), default=0) / class_keys))
    found = rows.select("page_id", "url", *[F.lit(None).cast("string").alias(x) for x in lists])
    id_type = rows.schema["page_id"].dataType.simpleString()
    for c in range(n):
        cascades = build(marked if n == 1 else marked.filter(F.pmod("hash", F.lit(n)) == c), lists)
        found = _probe(found, cascades, shapes, id_type, n, c)
        if n > 1:
            found = stored(found, f"{folder}-pass-{c}")
    rule = F.when(F.length("block") >= F.coalesce(F.length("allow"), F.lit(0)), F.col("block")).otherwise(F.col("allow"))
    host, path = _host_path()
    return found.withColumn("rule", rule).select(
        "page_id", host.alias("host"), path.alias("path"), "rule",
        F.when(F.col("rule").isNotNull(), F.when(F.col("rule") == F.col("block"), "block").otherwise("allow"))
        .when(F.col("site").isNotNull(), "block").otherwise("allow").alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("site")).alias("listed"))


def _host_path():
    rest = F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def _probe(rows: DataFrame, cascades: dict[str, Cascade], shapes: dict[str, Shape], id_type: str, n: int, c: int) -> DataFrame:
    """Per list the longest key of the url that is on it, where it is longer
    than the one found so far."""
    shared = rows.sparkSession.sparkContext.broadcast(cascades)

    def judge(batches):
        lists = shared.value
        for b in batches:
            found = {x: b.column(i + 2).to_pylist() for i, x in enumerate(lists)}
            for i, u in enumerate(b.column(1).to_pylist()):
                for x, cascade in lists.items():
                    if not cascade:
                        continue
                    for key in shapes[x].candidates(*parts(u)):
                        if n > 1 and _class(key, n) != c:
                            continue
                        if key in cascade:
                            if found[x][i] is None or len(key) > len(found[x][i]):
                                found[x][i] = key
                            break
            yield pa.record_batch([b.column(0), b.column(1), *[pa.array(v, pa.string()) for v in found.values()]],
                                  names=b.schema.names)

    fields = ", ".join(f"{x} string" for x in cascades)
    return rows.mapInArrow(judge, f"page_id {id_type}, url string, {fields}")


def _class(key: str, n: int) -> int:
    """The class that Spark's xxhash64 deals the key to."""
    h = xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"), seed=42)
    return (h - (1 << 64) if h >> 63 else h) % n


def marked_sites(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """(key) of the sites that ``SITE`` finds among the hosts of all pages;
    the list grows with the corpus's hosts."""
    hosts = pages.select(F.col(url_col).alias("url")).select(_host_path()[0].alias("host")).distinct()
    return hosts.select(F.regexp_extract("host", SITE, 2).alias("key")).where("key <> ''").distinct()


def query(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, spark.createDataFrame(list(RULES), "verdict string, key string"), marked_sites(pages))


_RULES_SQL = ", ".join(f"('{v}', '{split_key(k)[0]}', '{split_key(k)[1]}')" for v, k in RULES)
SQL = f"""
WITH r(verdict, h, p) AS (VALUES {_RULES_SQL}),
u AS (
  SELECT row_number() OVER () AS n, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
k AS (
  SELECT n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
s AS (SELECT DISTINCT regexp_extract(host, '{SITE}', 2) AS h FROM k WHERE regexp_extract(host, '{SITE}', 2) <> ''),
f AS (
  SELECT n, arg_max(r.h || r.p, len(r.h || r.p)) AS rule, arg_max(r.verdict, len(r.h || r.p)) AS verdict
  FROM k JOIN r ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p) GROUP BY n),
l AS (
  SELECT n, arg_max(s.h, len(s.h)) AS listed
  FROM k JOIN s ON host = s.h OR ends_with(host, '.' || s.h) GROUP BY n)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       CASE WHEN rule IS NOT NULL THEN verdict WHEN listed IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN rule IS NULL THEN listed END AS listed
FROM k LEFT JOIN f USING (n) LEFT JOIN l USING (n)
"""
