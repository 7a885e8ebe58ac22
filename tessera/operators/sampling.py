"""Deterministic samples: strides, first documents, and byte budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize


def stride(docs: DataFrame, every: int, index: str = "doc_index") -> DataFrame:
    """Every n-th document by its index, with its ordinal (from 1) in the sample; null indices are not sampled."""
    if every < 1:
        raise ValueError("a stride is at least 1")
    return docs.where(F.col(index) % every == 0).withColumn("ordinal", F.floor(F.col(index) / every).cast("long") + 1)


def nested(sample: DataFrame, every: int) -> DataFrame:
    """Every n-th row of a stride sample, by its ordinal."""
    return sample.where(F.col("ordinal") % every == 0)


def first(docs: DataFrame, n: int, index: str = "doc_index") -> DataFrame:
    """The first n documents of each shard by index, whatever the partitioning."""
    return docs.where(F.col(index) < n)


def byte_budget(docs: DataFrame, group: str, order: str, size: str, budget: int, salt: int = 256) -> DataFrame:
    """Documents of each group in order until the budget is reached; the one that reaches it is the last.

    Order is by ``order`` alone and must be unique in the group. Running sums over a whole group would put a large group
    into one task, so groups are cut into ranges of the order first: ranges are summed, their offsets found, and only the
    rows of ranges that begin within the budget are summed up one by one.
    """
    slim = docs.where(F.col(group).isNotNull() & F.col(order).isNotNull() & F.col(size).isNotNull())
    edges = slim.groupBy(group).agg(F.min(order).alias("_low"), F.max(order).alias("_high"))
    placed = slim.join(F.broadcast(edges), group).withColumn("_slot", F.floor((F.col(order) - F.col("_low")) / (F.col("_high") - F.col("_low") + 1) * salt))
    slots = placed.groupBy(group, "_slot").agg(F.sum(size).alias("_bytes"))
    before = Window.partitionBy(group).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(slots.withColumn("_before", F.coalesce(F.sum("_bytes").over(before), F.lit(0))).where(F.col("_before") < budget).drop("_bytes"), "slots")
    within = Window.partitionBy(group, "_slot").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.join(starts, [group, "_slot"]).withColumn("_sum", F.col("_before") + F.coalesce(F.sum(size).over(within), F.lit(0)))
    return rows.where(F.col("_sum") < budget).drop("_low", "_high", "_slot", "_before", "_sum")
