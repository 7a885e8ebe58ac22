"""Exact duplicates.

Identities are best the 16 bytes of :func:`tessera.functions.hashing.identity`: what is grouped by is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stats(docs: DataFrame, group: str, identity: str) -> DataFrame:
    """Documents, distinct identities and duplicate rate of each group.

    Identities are counted in two steps (within group and identity, then within group), so no group lies in one task.
    Null identities are documents but not identities. Empty input gives no rows.
    """
    per = docs.groupBy(group, identity).agg(F.count("*").alias("n"))
    out = per.groupBy(group).agg(F.sum("n").alias("docs"), F.count(identity).alias("unique_docs"))
    return out.withColumn("exact_dup_docs", F.col("docs") - F.col("unique_docs")).withColumn("dup_rate", F.round(F.col("exact_dup_docs") / F.col("docs"), 6))


def intra_cross(docs: DataFrame, group: str, identity: str) -> DataFrame:
    """One row: all duplicates, those within a group, and those only across groups."""
    per = docs.where(F.col(identity).isNotNull()).groupBy(identity, group).agg(F.count("*").alias("n"))
    each = per.groupBy(identity).agg(F.sum("n").alias("n"), F.count("*").alias("groups"))
    s = lambda c: F.coalesce(F.sum(c), F.lit(0))
    total = each.agg(s("n").alias("docs"), F.count("*").alias("unique_docs"), s(F.col("n") - 1).alias("global_dups"), s(F.col("groups") - 1).alias("cross_dups"))
    return total.withColumn("intra_dups", F.col("global_dups") - F.col("cross_dups"))


def keep_first(docs: DataFrame, identity: str, order: list[str]) -> DataFrame:
    """``is_first`` of every row: whether it is the first of its identity in order; rows with a null identity are each first.

    The first is found by an aggregate that combines before the shuffle, and joined back, so copies of one text, however
    many, are spread over tasks (AQE splits the join's hot key). Rows tied on the whole order are all first or none. All
    columns of ``docs`` are shuffled, so give keys and identities only and join texts by key where they are needed.
    """
    firsts = docs.where(F.col(identity).isNotNull()).groupBy(identity).agg(F.min(F.struct(*order)).alias("_first"))
    joined = docs.join(firsts, identity, "left")
    return joined.withColumn("is_first", F.col("_first").isNull() | (F.col("_first") == F.struct(*order))).drop("_first")


def keep_first_window(docs: DataFrame, identity: str, order: list[str]) -> DataFrame:
    """The same by a window, with exactly one first row even among rows tied on the order; for identities with few copies."""
    nth = F.row_number().over(Window.partitionBy(identity).orderBy(*order))
    return docs.withColumn("is_first", F.col(identity).isNull() | (nth == 1))


def missing_from(docs: DataFrame, measured: DataFrame, identity: str) -> DataFrame:
    """Identities that were not measured before: must be empty where a build follows a measured run."""
    return docs.select(identity).join(measured.select(identity), identity, "left_anti").distinct()
