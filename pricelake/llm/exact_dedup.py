"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Three stages, each grouping by the digest *and* the full normalised text, so
a digest collision can never merge two texts:

1. local: rows are salted by the scan partition they come from, so the
   map-side aggregation of the first exchange collapses every copy that lies
   in one partition;
2. salted: the first exchange is hashed on (digest, text, salt), so a text
   that makes up a third of the corpus arrives as at most ``salts`` groups of
   one row per map task;
3. global: the at most ``salts`` winners of a text are combined.

Every document then looks its group up by digest.  The join moves keys, not
texts, and its document side can be split by AQE when one digest is hot.
Digests carried by several texts (none for SHA-256, some for the weak digest
of the tests) are looked up by digest and full text instead.

Defined results: a null text counts as empty; of equal texts the largest
``doc_id`` stays (nulls lose to any id); every row with that id in the group
counts as kept, so a row repeated with its id is reported kept each time; a
group of null ids only keeps null.  An empty table gives no rows.  Columns
besides the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_az, run_folder, set_aside, stored, table


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def winners(rows: DataFrame, salts: int = 16) -> DataFrame:
    """(digest, norm) groups of ``rows(doc_id, norm, digest)``: ``keep_id``
    and ``group_size``."""
    salted = (rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
              .groupBy("digest", "norm", "salt")
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    return (salted.groupBy("digest", "norm")
            .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16,
                digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       lower_az(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"))
    rows = rows.withColumn("digest", digest(F.col("norm")))
    # the only columns kept of a digest with one text are three numbers
    by_digest = (winners(rows, salts).groupBy("digest")
                 .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"),
                      F.count(F.lit(1)).alias("n_texts")))
    groups = stored(by_digest, run_folder(spark, "exact-dedup"))
    plain = groups.filter("n_texts = 1").drop("n_texts")
    found = rows.select("doc_id", "digest", sha256(F.col("norm")).alias("text_sha256")).join(plain, "digest")
    if not groups.filter("n_texts > 1").isEmpty():
        shared = groups.filter("n_texts > 1").select("digest")
        clash = rows.join(shared, "digest", "left_semi")
        found = found.unionByName(
            clash.join(winners(clash, salts), ["digest", "norm"])
            .select("doc_id", "digest", sha256(F.col("norm")).alias("text_sha256"), "keep_id", "group_size"))
    return found.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """The documents that stay, with all their columns, one row per text."""
    decided = exact_dedup(docs, id_col, text_col, salts).filter("kept").select(
        F.col("keep_id").alias("_keep_id"), F.col("text_sha256").alias("_sha")).dropDuplicates()
    rows, names, back = set_aside(docs)
    rows = rows.withColumn("_sha", sha256(lower_az(F.coalesce(F.col(names[text_col]), F.lit("")))))
    kept = rows.join(decided, (rows["_sha"] == decided["_sha"]) & rows[names[id_col]].eqNullSafe(decided["_keep_id"]), "left_semi")
    return back(kept.dropDuplicates([names[id_col], "_sha"]))


SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS h,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY t) AS kept,
       h AS text_sha256
FROM d
"""


def query(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))
