"""Exact percentiles of groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize

#: Error of the sketch, as a share of a group's ranks, and how far on either side of a percentile its bracket reaches.
SKETCH_ERROR, REACH = 1e-4, 3e-4
#: Values of a group up to which the whole group is the bracket; beyond it brackets reach at least three ranks further than the error.
SMALL = 15_000


def percentiles(df: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """``(group, name of each share ...)``: percentiles between the two nearest values in proportion; null values do not count,
    groups without values are left out, null is a group.

    A mergeable sketch brackets each percentile by values whose ranks are certain to lie on either side of it; values below
    the brackets are counted and the distinct ones inside them are counted one by one. So no task holds the values of a
    group, and what one sorts is REACH of a group at most, repeated values counting once.
    """
    d = df.where(F.col(value).isNotNull()).select(F.col(group).alias("g"), F.col(value).cast("double").alias("v"))
    names, points = list(shares), [min(1.0, max(0.0, p + side)) for p in shares.values() for side in (-REACH, REACH)]
    sketch = d.groupBy("g").agg(F.count("*").alias("n"), F.percentile_approx("v", points, int(1 / SKETCH_ERROR)).alias("at"), F.min("v").alias("least"), F.max("v").alias("most"))
    # a bracket that reaches over an end of the ranks begins or ends with the group
    low = [F.when((F.col("n") <= SMALL) | (F.col("n") * p <= 1), F.col("least")).otherwise(F.get("at", F.lit(2 * i))) for i, p in enumerate(points[::2])]
    high = [F.when((F.col("n") <= SMALL) | (F.col("n") * (1 - p) <= 1), F.col("most")).otherwise(F.get("at", F.lit(2 * i + 1))) for i, p in enumerate(points[1::2])]
    brackets = F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.lit(p) * (F.col("n") - 1)).alias("rank"), (F.lit(p) * (F.col("n") - 1)).alias("exact"), low[i].alias("low"), high[i].alias("high")) for i, p in enumerate(shares.values())])
    found = materialize(sketch.select("g", "n", F.inline(brackets)), "brackets")
    held = found.groupBy("g").agg(F.collect_list(F.struct("i", "low", "high")).alias("b")).withColumnRenamed("g", "g2")
    met = d.join(held, d["g"].eqNullSafe(held["g2"])).select("g", "v", F.explode("b").alias("b")).where("v <= b.high")
    # one row stands for all values below a bracket
    counts = met.groupBy("g", F.col("b.i").alias("i"), F.when(F.col("v") >= F.col("b.low"), F.col("v")).alias("v")).agg(F.count("*").alias("k"))
    upto = F.sum("k").over(Window.partitionBy("g", "i").orderBy(F.col("v").asc_nulls_first()))
    ranked = counts.withColumn("upto", upto).withColumnsRenamed({"g": "g2", "i": "i2"})
    at = found.join(ranked, found["g"].eqNullSafe(ranked["g2"]) & (F.col("i") == F.col("i2")))
    # the first value that reaches a rank has it
    first = at.groupBy("g", "i", "rank", "exact").agg(F.min(F.when(F.col("upto") > F.col("rank"), F.col("v"))).alias("a"), F.min(F.when(F.col("upto") > F.least(F.col("rank") + 1, F.col("n") - 1), F.col("v"))).alias("z"))
    each = first.select("g", "i", (F.col("a") + (F.col("z") - F.col("a")) * (F.col("exact") - F.col("rank"))).alias("p"))
    return each.groupBy(F.col("g").alias(group)).agg(*[F.max(F.when(F.col("i") == i, F.col("p"))).alias(n) for i, n in enumerate(names)])
