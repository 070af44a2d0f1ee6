"""Connected components of a link table, in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, run_folder, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``: the smallest node
    reachable.

    Alternates two steps until neither changes anything: every node hands its larger
    neighbours its smallest one, then its smaller neighbours.  Paths halve,
    so the rounds grow with the logarithm of the longest path.  Each round is
    written to the shared folder; minima are combined before the shuffle and
    the joins on a busy node can be split.
    """
    spark, folder = links.sparkSession, run_folder(links.sparkSession, "components")
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                   f"{folder}/0")

    def sign(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    i, before = 0, sign(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = stored(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .filter("u <> v").distinct(), f"{folder}/{i}-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v")))
                 .filter("u <> v").distinct())
        small = stored(small, f"{folder}/{i + 1}")
        after = sign(small)
        done, before = after == before, after  # every node hangs on its smallest
        remove(spark, f"{folder}/{i}-large")
        remove(spark, f"{folder}/{i}")
        edges = small
        if done:
            break
        i += 1
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
