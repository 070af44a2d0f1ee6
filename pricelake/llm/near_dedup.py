"""MinHash near-deduplication with sequential Bayesian verification.

1. Every text becomes a set of word shingles and a signature of
   ``BANDS * ROWS`` minimum hashes.  Equal word sequences (by SHA-256) are one
   node with a number of its own, so exact copies cost one row each and rows
   that repeat an id with other words are other nodes.
2. Nodes that agree on all rows of a band meet in that band's bucket.
3. Every bucket draws ``LEADERS`` of its nodes (by one order of all nodes, so
   that the buckets of a group draw much the same ones), and its other nodes
   are paired with them, so a bucket of thousands of near copies gives pairs in
   proportion to its size, and a small one all its pairs.  Signatures are
   compared batch by batch, a pair being pruned as soon as the posterior
   probability that its similarity reaches the threshold falls below
   ``MISS``.  Of the survivors each node's likeliest are compared by their
   full shingle sets and linked; of the others, those between different
   components after that.
4. Leaders have then met their whole bucket and leave it; buckets within one
   component are done.  What is left are pairs between components.  For their
   nodes the shingles that no other node left has are counted: two sets can
   share no more than the smaller number of their other shingles, and a node
   that this bound keeps below the threshold is alone.  Each bucket draws
   leaders once more, now its nodes with the fewest shingles of their own,
   which are the middle of a group.
5. Then every bucket takes the middle of its largest component as reference,
   and each node left is known by its difference from that: the shingles that
   only one of both has.  Two sets differ by the difference of their
   differences, so near sets that are not both near to the reference share a
   number of difference shingles that their sizes state (``least_shared``).
   Few nodes have one, even where thousands share all the others, and those
   that only one node has are left out.  Of a node's difference, in order of
   frequency, only the shingles enter lists after which enough others follow,
   and two nodes meet in a list if enough follow for both: no pair is compared
   only because a bucket holds both.

No pair of different components that meets in a bucket is left out, so apart
from the banding and the pruning, whose miss probabilities are chosen below,
no link is lost.  At a similarity of 0.8 a pair meets in no band with
probability (1 - 0.8**5)**32 = 3e-6.

Defined results: a text without words (or null) has an empty set and is
linked with nothing; a null id can't name a component, so rows with null ids
are linked to equal texts only and a group of them alone has a null
component; rows that repeat an id are judged by their own texts.  A component
is named by its smallest id once all links are made.  kept is
null-safe ``doc_id = component_id``.  Empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import remove, row_key, run_folder, set_aside, stored, table
from .components import components

#: Words of a shingle, and those of the query's contract.
WORDS, CONTRACT_WORDS = 5, 4
#: Similarity from which documents are linked, in percent.
PERCENT = 80
BANDS, ROWS = 32, 5
#: Signature values compared at a time, and the posterior below which a pair goes.
BATCH, MISS = 32, 1e-6
#: Leaders a bucket draws, and likeliest pairs of a node that are confirmed first.
LEADERS, FIRST = 2, 3
#: Difference shingles that a task holds before it passes them on.
TOKENS = 200_000
SEED = 7


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, then split at [\x20\x09-\x0D]."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles_of(words: list[bytes], k: int) -> set[bytes]:
    if len(words) < k:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*[words[i:] for i in range(k)])))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes(dict):
    """word -> 64-bit hash; the words met last are held."""

    def __missing__(self, w: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[w] = xxhash.xxh3_64_intdigest(w)
        return h


class Signer:
    def __init__(self, k: int, bands: int, rows: int):
        self.k, self.bands, self.rows = k, bands, rows
        n = bands * rows
        seeds = _mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(SEED))
        self.a, self.b = seeds[:n, None] | np.uint64(1), seeds[n:, None]
        self.hashes = Hashes()

    def shingle_hashes(self, words: list[bytes]) -> np.ndarray:
        """One 64-bit hash per distinct shingle."""
        if not words:
            return np.zeros(0, np.uint64)
        w = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        k = min(self.k, len(w))
        out = np.full(len(w) - k + 1, k, np.uint64)
        for i in range(k):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + w[i:len(w) - k + 1 + i])
        return np.unique(out)

    def sign(self, h: np.ndarray) -> np.ndarray:
        """Minimum of each permutation, as 32-bit values."""
        least = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(h), 2048):
            np.minimum(least, (self.a * h[i:i + 2048] + self.b).min(1), out=least)
        return (least >> np.uint64(32)).astype("<u4")

    def buckets(self, sig: np.ndarray) -> list[int]:
        return [xxhash.xxh3_64_intdigest(x.tobytes(), seed=i) - (1 << 63)
                for i, x in enumerate(sig.reshape(self.bands, self.rows))]


def least_matches(batches: list[int], threshold: float, miss: float) -> list[int]:
    """Per number of compared values, the fewest matches with which a pair
    stays: under a uniform prior P(S >= t | m of n match) is the probability
    of at most m successes in n + 1 draws at t."""
    out = []
    for n in batches:
        p, m = 0.0, -1
        while p < miss and m < n:
            m += 1
            p += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, row_key, n_shingles, digest (null without words), signature, buckets."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("row_key"),
                      F.col(text_col).alias("text"))

    def scan(batches):
        signer = Signer(k, bands, rows)
        for b in batches:
            for i in range(0, b.num_rows, 2000):
                part = b.slice(i, 2000)
                n, digest, sig, bucket = [], [], [], []
                for t in part.column(2):
                    w = words_of(t.as_py())
                    h = signer.shingle_hashes(w)
                    n.append(len(h))
                    s = signer.sign(h) if len(h) else None
                    digest.append(hashlib.sha256(b" ".join(w)).digest() if w else None)
                    sig.append(s.tobytes() if w else None)
                    bucket.append(signer.buckets(s) if w else [])
                yield pa.record_batch([part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                                       pa.array(sig, pa.binary()), pa.array(bucket, pa.list_(pa.int64()))],
                                      names=["doc_id", "row_key", "n_shingles", "digest", "signature", "buckets"])

    return src.mapInArrow(scan, "doc_id long, row_key binary, n_shingles long, digest binary, signature binary, buckets array<long>")


def likely(pairs: DataFrame, sigs: DataFrame, values: int, percent: int, miss: float) -> DataFrame:
    """The pairs (a, b) that survive the batch-wise comparison of signatures,
    with the number of values that match."""
    stops = list(range(BATCH, values, BATCH)) + [values]
    least = least_matches(stops, percent / 100, miss)
    both = (pairs.join(sigs.select(F.col("node").alias("a"), F.col("signature").alias("x")), "a")
            .join(sigs.select(F.col("node").alias("b"), F.col("signature").alias("y")), "b").select("a", "b", "x", "y"))

    def compare(batches):
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                part = b.slice(i, 4096)
                x, y = (np.frombuffer(b"".join(part.column(c).to_pylist()), "<u4").reshape(-1, values) for c in (2, 3))
                alive, done, matched = np.arange(len(x)), 0, np.zeros(len(x), np.int64)
                for stop, m in zip(stops, least):
                    matched[alive] += (x[alive, done:stop] == y[alive, done:stop]).sum(1)
                    alive, done = alive[matched[alive] >= m], stop
                if len(alive):
                    yield pa.record_batch([*part.select([0, 1]).take(pa.array(alive)).columns, pa.array(matched[alive])],
                                          names=["a", "b", "matched"])

    return both.mapInArrow(compare, "a long, b long, matched long").groupBy("a", "b").agg(F.max("matched").alias("matched"))


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y"))

    def compare(batches):
        last, held = None, set()
        for batch in batches:
            out = []
            for a, b, x, y in zip(*batch.columns):
                if b != last:  # rows of one leader come together
                    last, held = b, shingles_of(words_of(y.as_py()), k)
                other = shingles_of(words_of(x.as_py()), k)
                common = len(held & other)
                if 100 * common >= percent * (len(held) + len(other) - common):
                    out.append((a.as_py(), b.as_py()))
            if out:
                yield pa.record_batch([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())],
                                      names=["a", "b"])

    return both.mapInArrow(compare, "a long, b long").distinct()


def sharable(nodes: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(node, own): for ``nodes(node)`` the shingles that no other of them has."""
    def explode(batches):
        signer = Signer(k, 1, 1)
        for b in batches:
            for node, text in zip(b.column(0).to_pylist(), b.column(1)):
                h = signer.shingle_hashes(words_of(text.as_py()))
                yield pa.record_batch([pa.array([node] * len(h), pa.int64()), pa.array(h.view(np.int64))], names=["node", "h"])

    rows = texts.join(nodes, "node", "left_semi").select("node", "text").mapInArrow(explode, "node long, h long")
    alone = rows.groupBy("h").agg(F.min("node").alias("node"), F.max("node").alias("other")).filter("node = other")
    return alone.groupBy("node").agg(F.count(F.lit(1)).alias("own"))


def differences(refs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(ref, node, n, n_ref, d, tokens) of ``refs(ref, node)``: the sizes of
    both shingle sets, how many shingles only one of both has, their hashes."""
    both = (refs.join(texts.select("node", F.col("text").alias("x")), "node")
            .join(texts.select(F.col("node").alias("ref"), F.col("text").alias("y")), "ref").select("ref", "node", "x", "y"))
    schema = pa.schema([(c, pa.int64()) for c in ("ref", "node", "n", "n_ref", "d")] + [("tokens", pa.list_(pa.int64()))])

    def compare(batches):
        last, held = None, set()
        for batch in batches:
            out, size = [], 0
            for ref, node, x, y in zip(*batch.columns):
                if ref != last:  # rows of one reference come together
                    last, held = ref, shingles_of(words_of(y.as_py()), k)
                own = shingles_of(words_of(x.as_py()), k)
                only = held ^ own
                out.append((ref.as_py(), node.as_py(), len(own), len(held), len(only), [xxhash.xxh3_64_intdigest(s) - (1 << 63) for s in only]))
                size += len(only)
                if size > TOKENS:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out, size = [], 0
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return both.mapInArrow(compare, "ref long, node long, n long, n_ref long, d long, tokens array<long>")


def least_shared(w, percent: int):
    """With w = (100 + percent) d - (100 - percent) n per set, d its distance
    from the reference: sets a, b are similar if and only if their differences
    share at least this of ``w`` = w(a) + w(b)."""
    return F.greatest(F.lit(1), F.ceil(w / F.lit(2 * (100 + percent)))).cast("long")


def met_by_difference(diffs: DataFrame, percent: int, folder: str) -> DataFrame:
    """(a, b): every pair of similar nodes of different components that have a
    reference in common, and few others.  ``diffs`` holds ref, node, d, n,
    n_ref, tokens and the component c, in which all nodes near to their
    reference are together."""
    w = (100 + percent) * F.col("d") - (100 - percent) * F.col("n")
    near = (100 + percent) * F.col("d") <= (100 - percent) * (F.col("n") + F.col("n_ref"))
    nodes = diffs.withColumns({"w": w, "near": near})
    # a node that is not near may be similar to any other, one that is near to those that are not
    bounds = nodes.groupBy("ref").agg(F.min("w").alias("least"), F.min(F.when(~F.col("near"), F.col("w"))).alias("least_far"),
                                      F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").drop("lo", "hi")
    nodes = nodes.join(bounds, "ref").withColumn("t", least_shared(F.col("w") + F.when(
        F.col("near"), F.col("least_far")).otherwise(F.col("least")), percent))
    tokens = stored(nodes.filter("t <= d").select("ref", "node", "c", "w", "t", F.explode("tokens").alias("token")), f"{folder}/tokens")
    shared = tokens.groupBy("ref", "token").agg(F.count(F.lit(1)).alias("nodes")).filter("nodes > 1")
    by = Window.partitionBy("ref", "node")
    lists = (tokens.join(shared, ["ref", "token"])
             .withColumn("follow", F.count(F.lit(1)).over(by) - F.row_number().over(by.orderBy("nodes", "token")) + 1).filter("follow >= t"))
    lists = stored(lists.select("ref", "token", "node", "c", "w", "follow"), f"{folder}/difference-lists")

    def side(x):
        return lists.select("ref", "token", *[F.col(c).alias(c + x) for c in ("node", "c", "w", "follow")])

    met = side("x").join(side("y"), ["ref", "token"]).filter("cx < cy").filter(
        least_shared(F.col("wx") + F.col("wy"), percent) <= F.least("followx", "followy"))
    return met.select(F.greatest("nodex", "nodey").alias("a"), F.least("nodex", "nodey").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, miss: float = MISS) -> DataFrame:
    """One row per document: doc_id, row_key, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    folder = run_folder(spark, "near-dedup")
    signed = stored(signatures(docs, id_col, text_col, words, bands, rows), f"{folder}/signed")
    groups = stored(signed.filter("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("least"))
                    .withColumn("node", F.monotonically_increasing_id()), f"{folder}/groups")
    named = groups.filter("least IS NOT NULL").select(F.col("least").alias("doc_id"), "digest", "node")
    first = signed.select("doc_id", "digest", "n_shingles", "signature", "buckets").join(named, ["doc_id", "digest"])
    # the members of buckets that hold several nodes
    met = first.select(F.explode("buckets").alias("bucket"), "node", F.col("n_shingles").alias("n"))
    busy = met.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi")
    members = stored(met.join(busy.select("bucket"), "bucket").distinct(), f"{folder}/members-0")
    nodes = stored(members.select("node").distinct(), f"{folder}/nodes")
    sigs = stored(first.select("node", "signature").join(nodes, "node", "left_semi"), f"{folder}/signatures")
    wanted = named.join(nodes, "node", "left_semi")
    keys = signed.select("doc_id", "digest", "row_key").join(wanted, ["doc_id", "digest"]).select("row_key", "node").distinct()
    src = docs.select(row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))
    texts = stored(src.join(keys, "row_key").select("node", "text"), f"{folder}/texts")

    labels = None

    def relabelled(df, node, out):
        if labels is None:
            return df.withColumn(out, F.col(node))
        return (df.join(labels.select(F.col("node").alias(node), F.col("component").alias(out)), node, "left")
                .withColumn(out, F.coalesce(out, node)))

    def merged(links, name):
        """The labels after some more links between components."""
        links = stored(links, f"{folder}/links-{name}")
        if links.isEmpty():
            return labels
        new = components(links)
        if labels is not None:
            moved = new.select(F.col("node").alias("component"), F.col("component").alias("to"))
            old = labels.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
            new = old.unionByName(new.join(labels.select("node"), "node", "left_anti"))
        return stored(new, f"{folder}/labels-{name}")

    def side(df, x):
        return df.select("bucket", F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("c").alias(f"c{x}"), F.col("s").alias(f"s{x}"))

    def decided(pairs, r):
        """The labels after all pairs of a round are compared."""
        nonlocal labels
        best = Window.partitionBy("a").orderBy(F.desc("matched"), "b")
        alive = stored(likely(pairs, sigs, bands * rows, percent, miss).withColumn("turn", F.row_number().over(best)), f"{folder}/alive-{r}")
        for part in ("first", "rest"):
            some = alive.filter(F.col("turn") <= FIRST if part == "first" else F.col("turn") > FIRST).select("a", "b")
            if part == "rest":
                some = relabelled(relabelled(some, "a", "ca"), "b", "cb").filter("ca <> cb").select("a", "b")
            links = confirmed(some, texts, words, percent)
            links = relabelled(relabelled(links, "a", "ca"), "b", "cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
            labels = merged(links, f"{r}-{part}")

    own = None
    for r in range(3):
        left = relabelled(members, "node", "c")
        # the members of buckets with several components
        several = left.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("bucket")
        left = stored(left.join(several, "bucket"), f"{folder}/left-{r}")
        if left.isEmpty():
            break
        if r == 0:
            left = left.withColumn("s", F.col("n"))
        else:
            if own is None:  # holds for every later round, whose nodes are among these
                own = stored(sharable(left.select("node").distinct(), texts, words), f"{folder}/own")
            left = left.join(own, "node", "left").withColumn("s", F.col("n") - F.coalesce("own", F.lit(0)))
            # a set that shares too little with any other is alone
            left = stored(left.filter(100 * F.col("s") >= percent * F.col("n")).drop("own"), f"{folder}/bound-{r}")
        if r < 2:
            turn = F.lit(0) if r == 0 else F.col("n") - F.col("s")
            draw = Window.partitionBy("bucket").orderBy(turn, F.xxhash64("node", F.lit(r)), "node")
            lead = stored(left.withColumn("rn", F.row_number().over(draw)).filter(F.col("rn") <= LEADERS).drop("rn"), f"{folder}/lead-{r}")
            # the leaders are about to meet their whole bucket
            members = stored(left.select("bucket", "node", "n").join(lead.select("bucket", "node"), ["bucket", "node"], "left_anti"),
                             f"{folder}/members-{r + 1}")
            # sizes, and what can be shared, alone rule out pairs that can't be similar enough
            most = F.least("sx", "sy", "nx", "ny")
            decided(side(left, "x").join(side(lead, "y"), "bucket").filter("cx <> cy")
                    .filter(100 * most >= percent * (F.col("nx") + F.col("ny") - most))
                    .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), r)
            continue
        hubs = (left.select("c", "node", (F.col("n") - F.col("s")).alias("own")).distinct().groupBy("c")
                .agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("own", "node")).alias("hub")))
        largest = (left.select("bucket", "c").distinct().join(hubs, "c").groupBy("bucket")
                   .agg(F.max(F.struct("size", "hub.node")).alias("top")).select("bucket", F.col("top.node").alias("ref")))
        refs = left.join(largest, "bucket").select("ref", "node").filter("ref <> node").distinct()
        diffs = stored(differences(refs, texts, words), f"{folder}/differences")
        near = diffs.filter((100 + percent) * F.col("d") <= (100 - percent) * (F.col("n") + F.col("n_ref")))
        near = relabelled(relabelled(near.select("node", "ref"), "node", "a"), "ref", "b").select("a", "b").filter("a <> b").distinct()
        labels = merged(near, f"{r}-near")
        decided(met_by_difference(relabelled(diffs, "node", "c"), percent, folder), r)
    for x in ("texts", "signatures", "members-0", "nodes"):
        remove(spark, f"{folder}/{x}")
    named_all = groups.withColumnRenamed("least", "component_id")
    if labels is not None:
        least = labels.join(groups, "node").groupBy("component").agg(F.min("least").alias("of_all"))
        named_all = (named_all.join(labels.join(least, "component").select("node", "of_all"), "node", "left")
                     .withColumn("component_id", F.coalesce("of_all", "component_id")))
    core = signed.select("doc_id", "row_key", "n_shingles", "digest")
    judged = core.filter("n_shingles > 0").join(named_all.select("digest", "component_id"), "digest")
    alone = core.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    cols = ["doc_id", "row_key", "n_shingles", "component_id"]
    return judged.select(cols).unionByName(alone.select(cols)).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One document of every group (its smallest id), with all columns; a
    repeated row stays once, a text without words always."""
    kept = near_duplicates(docs, id_col, text_col, **how).filter("kept").select(F.col("row_key").alias("_row_key")).distinct()
    rows, names, back = set_aside(docs)
    rows = rows.withColumn("_row_key", row_key(names[id_col], names[text_col]))
    return back(rows.join(kept, "_row_key", "left_semi").dropDuplicates(["_row_key", names[id_col]]))


def query(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words=CONTRACT_WORDS).drop("row_key")


#: All pairs of rows that share a shingle, on whole sets.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
h AS (SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS h
      FROM (SELECT r, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM h GROUP BY r),
p AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM h x JOIN h y ON x.h = y.h AND x.r < y.r GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
t AS (SELECT r AS a, r AS b FROM d UNION SELECT t.a, e.b FROM t JOIN e ON e.a = t.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n ON n.r = d.r
JOIN (SELECT t.a, min(o.doc_id) AS component_id FROM t JOIN d o ON o.r = t.b GROUP BY t.a) c ON c.a = d.r
"""
