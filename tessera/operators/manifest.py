"""Roll-ups of measured runs, attestations, unions of builds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import hashing


def latest_runs(stats: DataFrame) -> DataFrame:
    """One row of statistics for each shard: that of its latest run; repeated rows count once."""
    newest = F.max(F.struct("generated_utc", "run_id", "full_pass", "lid.consistency_rate", "tokens")).alias("s")
    return stats.where("shard.shard_id is not null").groupBy(F.col("shard.shard_id").alias("shard_id")).agg(newest).select("shard_id", "s.*")


def rollup(latest: DataFrame) -> DataFrame:
    """Corpus totals. The token estimate is null if any shard lacks one; rates are 0 where nothing was measured."""
    fp = lambda c: F.coalesce(F.sum(f"full_pass.{c}"), F.lit(0)).alias(c)
    est = F.col("tokens.estimated_shard_tokens")
    out = latest.agg(
        F.count("*").alias("shards"), fp("file_bytes"), fp("docs"), fp("doc_bytes"), fp("exact_dup_docs"), fp("unique_docs"),
        F.when(F.bool_and(est.isNotNull()), F.sum(est)).alias("estimated_total_tokens"), F.round(F.coalesce(F.avg("consistency_rate"), F.lit(0.0)), 6).alias("mean_consistency"),
    )
    return out.withColumn("dup_rate", F.round(F.coalesce(F.try_divide("exact_dup_docs", "docs"), F.lit(0.0)), 6))


def attest(docs: DataFrame, group: str, text: str) -> DataFrame:
    """Documents, bytes and duplicate rate of each file of a foreign corpus, with a total (null group, level 1). Texts leave
    the scan as identities and lengths."""
    slim = docs.where(F.col(text).isNotNull()).select(F.col(group).alias("_g"), hashing.identity(F.col(text)).alias("_id"), F.octet_length(text).cast("long").alias("_b"))
    per = slim.groupBy("_g", "_id").agg(F.count("*").alias("n"), F.sum("_b").alias("b"))
    sums = lambda level: (F.sum("n").alias("docs"), F.sum("b").alias("bytes"), F.count("*").alias("unique_docs"), F.lit(level).cast("long").alias("level"))
    files = per.groupBy("_g").agg(*sums(0))
    # the total's distinct texts come from one row for each text, not from all pairs of file and text at once
    total = per.groupBy("_id").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).groupBy().agg(*sums(1)).where("docs is not null")
    out = files.unionByName(total.withColumn("_g", F.lit(None).cast(dict(docs.dtypes)[group]))).withColumnRenamed("_g", group)
    return out.withColumn("dup_rate", F.round(1 - F.col("unique_docs") / F.col("docs"), 6))


def union_builds(parts: list[DataFrame], identity: str) -> DataFrame:
    """One row: kept rows of all partitions, distinct ones, and those kept in more than one place."""
    rows = parts[0].select(identity)
    for p in parts[1:]:
        rows = rows.unionByName(p.select(identity))
    per = rows.groupBy(identity).agg(F.count("*").alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_docs")).withColumn("cross_partition_rekept_docs", F.col("rows") - F.col("distinct_docs"))


def check_union(manifests: list[dict]) -> None:
    """Raises unless partitions may be united: one corpus, registry and parent, equal configurations but for the cutoffs of
    languages that only one of them has, and no shard built twice. A receipt without a configuration cannot be compared."""
    if not manifests:
        raise ValueError("nothing to unite")
    seen: set[str] = set()
    cutoffs: dict[str, float] = {}
    first = manifests[0]
    for m in manifests:
        if not m.get("config"):
            raise ValueError("a partition's receipt names no configuration")
        for key in ("corpus_id", "registry_sha256", "parent_hash"):
            if m.get(key) != first.get(key):
                raise ValueError(f"partitions differ in {key}")
        for key in sorted((m["config"].keys() | first["config"].keys()) - {"cutoffs", "droplist_sha256"}):
            if m["config"].get(key) != first["config"].get(key):
                raise ValueError(f"partitions were built with different configurations: {key}")
        for lang, cut in m["config"].get("cutoffs", {}).items():
            if cutoffs.setdefault(lang, cut) != cut:
                raise ValueError(f"partitions have different cutoffs for {lang}")
        twice = seen & set(m.get("shards", []))
        if twice:
            raise ValueError(f"shards built twice: {', '.join(sorted(twice))}")
        seen |= set(m.get("shards", []))


def unite(manifests: list[dict]) -> dict:
    """The manifest of the union: counts of all reasons are summed, plugins' included, and warnings are kept."""
    check_union(manifests)
    reasons: dict[str, int] = {}
    cutoffs: dict[str, float] = {}
    for m in manifests:
        cutoffs |= m["config"].get("cutoffs", {})
        for k, n in m.get("reasons", {}).items():
            reasons[k] = reasons.get(k, 0) + n
    first = manifests[0]
    return {
        "corpus_id": first.get("corpus_id"), "registry_sha256": first.get("registry_sha256"), "parent_hash": first.get("parent_hash"), "config": first["config"] | {"cutoffs": dict(sorted(cutoffs.items()))},
        "droplists": sorted({m["config"].get("droplist_sha256") or "" for m in manifests} - {""}), "shards": sorted(s for m in manifests for s in m.get("shards", [])), "reasons": reasons,
        "warnings": [w for m in manifests for w in m.get("warnings", [])],
    }


def merge_runs(runs: list[dict], accepted: list[str], partial: bool = False) -> dict:
    """One corpus manifest of measured runs. Raises if runs measured different registries or one shard twice, if a shard that
    was measured is not accepted (any more), or, unless ``partial``, if an accepted one was not measured."""
    if not runs:
        raise ValueError("nothing to merge")
    if len({r.get("registry_sha256") for r in runs}) > 1:
        raise ValueError("the runs measured different registries")
    shards: dict[str, dict] = {}
    for r in runs:
        for s in r["shards"]:
            if s["shard_id"] in shards:
                raise ValueError(f"shard {s['shard_id']} was measured twice")
            shards[s["shard_id"]] = s
    if strange := sorted(set(shards) - set(accepted)):
        raise ValueError(f"measured but not accepted: {', '.join(strange)}")
    missing = sorted(set(accepted) - set(shards))
    if missing and not partial:
        raise ValueError(f"not measured: {', '.join(missing)}; measure them or merge in part")
    rows = [shards[k] for k in sorted(shards)]
    total = {k: sum(s.get(k) or 0 for s in rows) for k in ("docs", "doc_bytes")}
    tokens = [s.get("estimated_tokens") for s in rows]
    return {
        "corpus_id": runs[0].get("corpus_id", "unnamed"), "registry_sha256": runs[0].get("registry_sha256"), "shards": rows, **total, "missing_shards": missing, "partial": bool(missing),
        "truncated_by_max_docs": any(r.get("truncated_by_max_docs") for r in runs), "estimated_total_tokens": None if None in tokens else sum(tokens),
    }


def build_warnings(kept: int, total: int) -> list[str]:
    """Warnings of a build that kept nothing or less than half."""
    if not kept:
        return ["EMPTY BUILD: no document was kept"]
    return [f"HIGH DROP RATE: {1 - kept / total:.1%} of the documents were dropped"] if kept < total / 2 else []
