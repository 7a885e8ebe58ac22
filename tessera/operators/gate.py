"""Provenance gate: which shards may be read at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What a registry row must hold and which classes of data there are.
REGISTRY_VERSION = 1
REQUIRED = ("shard_id", "path", "source", "license", "date_acquired", "data_class", "language")
ALLOWED = ("public", "licensed", "synthetic-own")
FORBIDDEN = ("customer", "customer-derived", "evaluation-only")
SUSPECT = r"(?i)customer|client|tenant|pilot|prod[-_]?log|bpo[-_]?qa|ticket"
PROVENANCE = ("shard_id", "source", "license", "date_acquired", "data_class", "language")


def refusal_reason(suspect: str = SUSPECT) -> Column:
    """Why a registry row is refused, null if it is not: a forbidden class first, which no reviewer can lift; then blank
    fields in order; an unknown class; a name that suggests customer or evaluation data, unless a reviewer signed."""
    kind = F.lower(F.trim(F.coalesce("data_class", F.lit(""))))
    blank = F.filter(F.array(*[F.when(F.trim(F.coalesce(f, F.lit(""))) == "", F.lit(f)) for f in REQUIRED]), lambda x: x.isNotNull())
    named = F.concat_ws(" ", "shard_id", "path", "source")
    return (
        F.when(kind.isin(*FORBIDDEN), F.concat(F.lit("forbidden data_class: "), kind))
        .when(F.size(blank) > 0, F.concat(F.lit("missing fields: "), F.array_join(blank, ", ")))
        .when(~kind.isin(*ALLOWED), F.concat(F.lit("unknown data_class: "), kind))
        .when(named.rlike(suspect) & (F.trim(F.coalesce("reviewed_by", F.lit(""))) == ""), F.lit("suspect name without reviewer"))
    )


def gate(registry: DataFrame, order: list[str] | None = None, suspect: str = SUSPECT) -> DataFrame:
    """The registry with ``reason``: null for accepted rows. Of rows with one shard_id the first in order counts, even if it was
    refused; the others are refused as duplicates. Null shard ids are missing fields, never duplicates of each other."""
    by = order or ["path", *[c for c in REQUIRED if c not in ("path", "shard_id")], "reviewed_by"]
    nth = F.row_number().over(Window.partitionBy("shard_id").orderBy(*[F.col(c).asc_nulls_first() for c in by]))
    out = registry.withColumn("_nth", nth).withColumn("reason", F.when((F.col("_nth") > 1) & F.col("shard_id").isNotNull(), F.lit("duplicate shard_id")).otherwise(refusal_reason(suspect)))
    return out.drop("_nth")


def accepted(gated: DataFrame) -> DataFrame:
    return gated.where("reason is null")


def provenance(gated: DataFrame) -> DataFrame:
    """The published fields of the accepted shards; paths and reviewers stay out."""
    return accepted(gated).select(*PROVENANCE)


def admit(docs: DataFrame, gated: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Documents of accepted shards, of the named ones if any are named; unknown names are ignored. The registry is a bounded
    ledger, so its accepted ids are broadcast."""
    ids = accepted(gated).select("shard_id").distinct()
    if only is not None:
        ids = ids.where(F.col("shard_id").isin(*only)) if only else ids.limit(0)
    return docs.join(F.broadcast(ids), "shard_id", "left_semi")


def licence_rollup(gated: DataFrame) -> DataFrame:
    """Accepted shards by class and licence, with totals."""
    return accepted(gated).withColumn("data_class", F.lower(F.trim("data_class"))).rollup("data_class", "license").agg(F.count("*").alias("shards"), F.grouping_id().cast("long").alias("level"))
