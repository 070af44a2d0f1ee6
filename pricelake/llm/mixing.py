"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time t in [0, 1], piecewise
linear.  Its integral, scaled to the source's target, is the source's
cumulative token demand D(t).  A document whose words start at offset u of
its source's stream is trained on at t = D^-1(u); documents are then
range-sorted by that position.

Targets are water-filled: target = min(limit * size, level * weight) with the
level chosen so that the targets add up to ``share`` of all words.  In the
order of limit * size / weight a source is at its limit exactly when filling
all to its level would not exceed the total, so two running totals over the
sources replace the round-by-round resharing.

A source's stream is its documents in the order of md5(doc_id), repeated.
Offsets are distributed running totals (range partitions plus partition
offsets), so a source with a third of all rows is spread over tasks.  A
document is taken whole, ``floor(target / size)`` times, and once more if its
middle lies before the remainder; a source's taken words thus differ from
its target by less than its largest document.

Defined results: null text has size 0; null sources are one source, last; a
document of size 0 takes no words but keeps a position; equal md5 order is
broken by id, size and text hash, and wholly equal rows are interchangeable.
Null ids sort as the empty string.  Empty tables and tables without words
give zero targets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import running_total
from .common import WORD, partitions, run_folder, set_aside, stored, table

#: Weights of the sources by code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Weight schedules by the same order: (t, weight) knots, linear between.
SCHEDULES = (((0.0, 1.0), (1.0, 1.0)),
             ((0.0, 0.5), (0.5, 0.5), (1.0, 1.5)),
             ((0.0, 1.5), (0.5, 0.5), (1.0, 0.5)))


def segments(knots) -> list[tuple[float, float, float, float, float]]:
    """Per linear piece: start t, start weight, slope, and the share of the
    whole integral at its start and end."""
    area = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
    whole, done, out = sum(area), 0.0, []
    for (a, b), x in zip(zip(knots, knots[1:]), area):
        slope = (b[1] - a[1]) / (b[0] - a[0])
        out.append((a[0], a[1] / whole, slope / whole, done, done + x / whole))
        done += x / whole
    return out


def inverse(share: Column, knots) -> Column:
    """The time by which ``share`` of the schedule's integral is reached."""
    out = None
    for t0, w0, slope, lo, hi in reversed(segments(knots)):
        d = share - F.lit(lo)
        t = F.lit(t0) + (d / F.lit(w0) if slope == 0 else
                         (F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * d)) - F.lit(w0)) / F.lit(slope))
        out = t if out is None else F.when(share < F.lit(hi), t).otherwise(out)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), out))


def targets(sources: DataFrame, share: float = 1.5, limit: int = 2, weights=WEIGHTS) -> DataFrame:
    """``sources(source, source_size)`` with rank (0-based), weight, target
    and the words of the sources before it."""
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"))
    ranked = running_total(sources.withColumn("last", F.col("source").isNull()), ["last", "source"], "upto",
                           weight=F.col("source_size"))
    ranked = running_total(ranked, ["last", "source"], "rank").withColumn("rank", F.col("rank") - 1)
    ranked = (ranked.withColumn("weight", w.cast("long"))
              .withColumn("full_at", F.lit(float(limit)) * F.col("source_size") / F.col("weight")))
    order = ["full_at", "rank"]
    ranked = running_total(ranked, order, "w_upto", weight=F.col("weight"))
    ranked = running_total(ranked, order, "s_upto", weight=F.col("source_size"))
    tot = ranked.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    total, w_all = share * (tot.s or 0), tot.w or 0
    at_limit = (F.lit(float(limit)) * F.col("s_upto") + F.col("full_at") * (F.lit(w_all) - F.col("w_upto"))) <= F.lit(total)
    ranked = ranked.withColumn("at_limit", at_limit)
    rest = ranked.filter("not at_limit").agg(F.sum("weight").alias("w")).first()
    capped = ranked.filter("at_limit").agg(F.sum("source_size").alias("s")).first()
    level = (total - limit * (capped.s or 0)) / rest.w if rest.w else 0.0
    return ranked.select(
        "source", "source_size", "rank", "weight", (F.col("upto") - F.col("source_size")).alias("before"),
        F.when(F.col("at_limit"), F.lit(float(limit)) * F.col("source_size"))
        .otherwise(F.lit(level) * F.col("weight")).alias("target"))


def plan_mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 share: float = 1.5, limit: int = 2, weights=WEIGHTS, schedules=SCHEDULES) -> DataFrame:
    """One row per document: doc_id, source, text_hash, size, source_size,
    target, copies, taken, positions (one per copy, ascending)."""
    spark = docs.sparkSession
    base = run_folder(spark, "mixing")
    rows = stored(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(text_col).alias("text_hash"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("turn")), f"{base}/sizes")
    sources = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), share, limit, weights),
                     f"{base}/targets")
    placed = running_total(rows.withColumn("last", F.col("source").isNull()),
                           ["last", "source", "turn", "doc_id", "size", "text_hash"], "upto", weight=F.col("size"),
                           num_partitions=partitions(spark))
    a = placed.alias("a").join(sources.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select(
        "a.doc_id", "a.source", "a.text_hash", "a.size", "b.source_size", "b.target", "b.rank",
        (F.col("a.upto") - F.col("a.size") - F.col("b.before")).alias("start"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    a = a.withColumn("whole", F.least(whole.cast("long"), F.lit(limit)))
    once_more = F.col("start") + F.col("size") / F.lit(2.0) < F.col("target") - F.col("whole") * F.col("source_size")
    a = a.withColumn("copies", F.least(F.col("whole") + once_more.cast("long"), F.lit(limit)).cast("int"))

    def position(epoch: int) -> Column:
        u = F.when(F.col("target") > 0, (F.col("start") + F.lit(epoch) * F.col("source_size")) / F.col("target")).otherwise(F.lit(0.0))
        out = inverse(u, schedules[-1])
        for i, knots in enumerate(schedules[:-1]):
            out = F.when(F.pmod(F.col("rank"), F.lit(len(schedules))) == i, inverse(u, knots)).otherwise(out)
        return out

    slots = F.slice(F.array(*[position(e) for e in range(math.ceil(limit))]), F.lit(1), F.col("copies"))
    return a.select("doc_id", "source", "text_hash", "size", F.col("source_size").cast("long").alias("source_size"),
                    "target", "copies", (F.col("size") * F.col("copies")).cast("long").alias("taken"),
                    slots.alias("positions"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **plan) -> DataFrame:
    """The training stream: every taken copy of every document with all its
    columns, range-sorted by training position."""
    p = plan_mixture(docs, id_col, text_col, source_col, **plan)
    # joined on one hash of id, source and text; a row that the table repeats
    # is numbered on both sides (the difference keeps the number out of the
    # join's keys, so window and join share one exchange)
    p = p.select(F.xxhash64("doc_id", "source", "text_hash").alias("_key"), "positions").withColumn(
        "_m", F.row_number().over(Window.partitionBy("_key").orderBy("positions")))
    rows, names, back = set_aside(docs)
    key = F.xxhash64(names[id_col], names[source_col], F.xxhash64(names[text_col]))
    rows = rows.withColumn("_key", key).withColumn("_n", F.row_number().over(Window.partitionBy("_key").orderBy("_key")))
    joined = rows.join(p, (rows["_key"] == p["_key"]) & (F.col("_m") - F.col("_n") == 0))
    return back(joined.withColumn("_position", F.explode("positions"))
                .repartitionByRange(partitions(docs.sparkSession), "_position", names[id_col])
                .sortWithinPartitions("_position", names[id_col]))


def query(spark, sf_dir):
    return plan_mixture(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken",
        F.round(F.get("positions", F.lit(0)), 9).alias("first_position"))


SQL = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS turn
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank
  FROM d GROUP BY source),
w AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
         sum(source_size) OVER () AS total FROM s),
q AS (
  SELECT *, sum(weight) OVER () AS w_all, 2.0::DOUBLE * source_size / weight AS full_at FROM w),
f AS (
  SELECT *, 2.0::DOUBLE * sum(source_size) OVER o + full_at * (w_all - sum(weight) OVER o) <= 1.5::DOUBLE * total AS at_limit
  FROM q WINDOW o AS (ORDER BY full_at, rank ROWS UNBOUNDED PRECEDING)),
l AS (
  SELECT (1.5::DOUBLE * max(total) - 2 * coalesce(sum(source_size) FILTER (at_limit), 0))
         / sum(weight) FILTER (NOT at_limit) AS level FROM f),
t AS (
  SELECT source, rank, source_size, CASE WHEN at_limit THEN 2.0::DOUBLE * source_size ELSE level * weight END AS target
  FROM f, l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.rank,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY turn, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS start,
         CASE WHEN t.source_size > 0 THEN least(floor(t.target / t.source_size), 2)::BIGINT ELSE 0 END AS whole
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, least(whole + CASE WHEN start + size / 2.0::DOUBLE < target - whole * source_size THEN 1 ELSE 0 END, 2) AS copies,
         CASE WHEN target > 0 THEN start / target ELSE 0 END AS u FROM p),
x AS (
  SELECT *, CASE rank % 3
    WHEN 0 THEN u
    WHEN 1 THEN CASE WHEN u < @R THEN u / @A ELSE 0.5::DOUBLE + (sqrt(@A2 + @S2 * (u - @R)) - @A) / @S END
    ELSE CASE WHEN u < @Q THEN (sqrt(@B2 - @S2 * u) - @B) / -@S ELSE 0.5::DOUBLE + (u - @Q) / @A END END AS pos
  FROM c)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken,
       CASE WHEN copies > 0 THEN round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, pos)), 9) END AS first_position
FROM x
"""
# the constants of SCHEDULES: integral 0.75, so weights are divided by it
_A, _B, _S = 0.5 / 0.75, 1.5 / 0.75, 2.0 / 0.75
for _k, _v in (("@A2", _A * _A), ("@B2", _B * _B), ("@S2", 2 * _S), ("@A", _A), ("@B", _B), ("@S", _S),
               ("@R", 0.25 / 0.75), ("@Q", 0.5 / 0.75)):
    SQL = SQL.replace(_k, f"{_v!r}::DOUBLE")
