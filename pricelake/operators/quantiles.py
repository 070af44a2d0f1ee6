"""Exact order statistics of groups of any size, by repeated range counting.

A median that collects its group puts a hot group into one task.  Here every
pass counts the values of each group in ``BUCKETS`` equal ranges between the
bounds known so far (partial counts are combined before they move, so a pass
shuffles ranges, not values), finds the range that holds the wanted rank and
takes its least and greatest value as the new bounds.  A pass divides the
range by ``BUCKETS``; once no more than ``FEW`` values lie in it they are
ranked directly, so a few passes do, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

BUCKETS = 1024
#: Values between two bounds that are sorted in one task.
FEW = 10_000
#: Stands for infinity while ranges are divided: the greatest double.
GREATEST = 1.7976931348623157e308


def ranks(values: DataFrame, wanted: DataFrame, by: list[str], buckets: int = BUCKETS, few: int = FEW) -> DataFrame:
    """(by, rank, value): the value at each wanted rank (from 0) of each group.
    ``values``: by, v (finite, not NULL); ``wanted``: by, rank, and the
    group's n, lo, hi: how many values it has, and their bounds."""
    key = [*by, "rank"]
    state = cut_lineage(wanted.select(*key, "n", "lo", "hi", F.lit(0).cast("long").alias("below")))
    between = F.col("v").between(F.col("lo"), F.col("hi"))
    many = (F.col("lo") < F.col("hi")) & (F.col("n") > few)
    while not state.where(many).isEmpty():
        v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
        # halves where the range is wider than the greatest double
        part = F.when(hi - lo <= GREATEST, (v - lo) / (hi - lo)).otherwise((v / 2 - lo / 2) / (hi / 2 - lo / 2))
        counted = (values.join(state.where(many).drop("n"), by).where(between)
                   .withColumn("bucket", F.least(F.floor(part * buckets), F.lit(buckets - 1)))
                   .groupBy(*key, "below", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")))
        # at most `buckets` rows a rank
        upto = Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        found = (counted.withColumn("upto", F.col("below") + F.sum("n").over(upto))
                 .where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
                 .select(*key, "n", "lo", "hi", (F.col("upto") - F.col("n")).alias("below")))
        state = cut_lineage(state.where(~many).unionByName(found))
    # at most `few` rows a rank
    order = Window.partitionBy(*key).orderBy("v")
    sorted_ = (values.join(state.where("lo < hi").select(*key, "lo", "hi", "below"), by).where(between)
               .withColumn("at", F.col("below") + F.row_number().over(order) - 1).where(F.col("at") == F.col("rank")))
    return state.where("lo = hi").select(*key, F.col("lo").alias("value")).unionByName(sorted_.select(*key, F.col("v").alias("value")))


def exact_quantiles(df: DataFrame, value: str, probs: list[float], by: list[str], buckets: int = BUCKETS, few: int = FEW) -> DataFrame:
    """(by, p, quantile, n): linearly interpolated quantiles of each group, n
    its values.  NULL and NaN are left out; infinities are ordered like any
    value.  Groups without values give no rows.  A row takes part once, so a
    group of groups (the whole universe, say) is a call of its own."""
    v = F.col(value).cast("double")
    values = cut_lineage(df.select(*by, v.alias("v")).where("v IS NOT NULL AND NOT isnan(v)").withColumn(
        "v", F.greatest(F.lit(-GREATEST), F.least(F.lit(GREATEST), "v")) + 0.0))
    groups = cut_lineage(values.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")))
    p = groups.withColumn("p", F.explode(F.array(*[F.lit(float(x)) for x in probs])))
    p = p.withColumn("at", F.col("p") * (F.col("n") - 1)).withColumn("first", F.floor("at")).withColumn("second", F.ceil("at"))
    wanted = p.select(*by, F.explode(F.array("first", "second")).alias("rank"), "n", "lo", "hi").distinct()
    found = ranks(values, wanted, by, buckets, few)

    def real(c):
        return F.when(F.abs(c) < GREATEST, F.col(c)).when(F.col(c) > 0, float("inf")).otherwise(float("-inf"))

    one = found.select(*by, F.col("rank").alias("first"), real("value").alias("x"))
    two = found.select(*by, F.col("rank").alias("second"), real("value").alias("y"))
    step = F.col("at") - F.col("first")
    return (p.join(one, [*by, "first"]).join(two, [*by, "second"])
            .select(*by, "p", F.when((step == 0) | (F.col("x") == F.col("y")), F.col("x")).otherwise(
                F.col("x") + (F.col("y") - F.col("x")) * step).alias("quantile"), "n"))
