"""Measure and build: the whole chain from a registry to kept documents and their receipt."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import domain, hashing, lid, pii, quality, toxicity
from tessera.functions.toxicity import Lexicon
from tessera.operators import contamination, dedup, gate, lm, manifest, neardup, sampling, verdict
from tessera.plugins import Plugin
from tessera.session import materialize
from tessera.sources import corpus, sinks


@dataclass
class Build:
    """What a build needs beside the documents."""

    config: verdict.FilterConfig = field(default_factory=verdict.FilterConfig)
    lexicon: Lexicon | None = None
    items: DataFrame | None = None
    plugins: list[Plugin] = field(default_factory=list)
    near: bool = True
    perplexity: float | None = 0.99
    min_scored: int = lm.MIN_SCORED
    corpus_id: str = "unnamed"
    registry_sha256: str | None = None
    parent: dict | None = None


def _place(root: str, path: str) -> str:
    """A shard's path: as it is where it is absolute or a URI, else below the registry's folder."""
    return path if ":/" in path or os.path.isabs(path) else os.path.join(root, path)


def _root(registry_path: str) -> str:
    return os.path.dirname(registry_path if ":/" in registry_path else os.path.abspath(registry_path))


def _wanted(gated: DataFrame, only: list[str] | None) -> list:
    """Accepted rows in order, or the named ones; a name that is refused or unknown raises."""
    rows = gate.accepted(gated).select("shard_id", "path", "language").orderBy("position").collect()
    if only is not None:
        reasons = {r["shard_id"]: r["reason"] for r in gated.where("reason is not null").select("shard_id", "reason").collect()}
        held = {r["shard_id"] for r in rows}
        for name in only:
            if name not in held:
                raise ValueError(f"shard {name}: {reasons.get(name, 'not in the registry')}")
        rows = [r for r in rows if r["shard_id"] in set(only)]
    if not rows:
        raise ValueError("no shard was accepted")
    return rows


def places(gated: DataFrame, registry_path: str, only: list[str] | None = None) -> dict[str, str]:
    """Path of each accepted shard."""
    return {r["shard_id"]: _place(_root(registry_path), r["path"]) for r in _wanted(gated, only)}


def read(spark: SparkSession, registry_path: str, only: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(gated registry, documents)``. Files of refused shards are never listed or opened; a named shard that is refused or
    not registered is an error. All files are read together, whatever their number."""
    gated = gate.gate(corpus.registry(spark, registry_path), order=["position"])
    rows = _wanted(gated, only)
    root = _root(registry_path)
    places = [(r["shard_id"], i, r["language"], _place(root, r["path"])) for i, r in enumerate(rows)]
    texts = corpus.documents(spark, sorted({p[3] for p in places})).withColumn("path", corpus.plain_uri(F.col("path")))
    listed = spark.createDataFrame([(*p[:3], corpus.qualified(spark, p[3])) for p in places], "shard_id string, shard_ord int, language string, path string")
    docs = texts.join(F.broadcast(listed.withColumn("path", corpus.plain_uri(F.col("path")))), "path").drop("path")
    return gated, materialize(docs.withColumn("doc_hash", hashing.doc_hash(F.col("text"))).withColumn("n_bytes", F.octet_length("text")), "corpus")


#: Metrics whose means a measurement gives.
MEANS = ("symbol_ratio", "digit_ratio", "mean_word_len", "dup_line_frac", "top_bigram_frac", "boilerplate_hits", "quality_score")


def measure(docs: DataFrame, every: int = 50, items: DataFrame | None = None, models: tuple[DataFrame, DataFrame] | None = None, tokens: DataFrame | None = None) -> DataFrame:
    """Statistics of every shard: all documents are counted, a stride of them scored.

    ``items`` (id, text) add contaminated documents, ``models`` the distribution of bits per character, and ``tokens``
    (shard_id, bytes_per_token) an estimate of the shard's tokens.
    """
    full = docs.groupBy("shard_id", "doc_hash").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("b")).groupBy("shard_id")
    full = full.agg(F.sum("n").alias("docs"), F.sum("b").alias("doc_bytes"), F.count("*").alias("unique_docs")).withColumn("exact_dup_docs", F.col("docs") - F.col("unique_docs"))
    sample = sampling.stride(docs, every).withColumn("key", F.concat_ws(":", "shard_id", "doc_index"))
    s = quality.metrics(sample, "text").withColumn("lid", lid.dominant(lid.script_counts(F.col("text"))))
    s = s.withColumn("domain", domain.classify(F.col("text"), F.col("language"))).withColumn("pii", pii.scan(F.col("text")))
    s = s.withColumn("bin", quality.histogram_bin(F.col("quality_score"))).withColumn("lang", F.coalesce(lid.effective_language(F.col("lid.script"), F.col("language")), F.lit("und")))
    s = materialize(s.select("shard_id", "key", "language", "lid", "lang", "domain", "pii", "bin", "quality_bucket", *MEANS), "measured")
    count = lambda c: F.sum(c.cast("long"))
    kinds = (*pii.PATTERNS, "iban", "card")
    out = s.groupBy("shard_id").agg(
        F.count("*").alias("sampled"), *[F.round(F.avg(m), 4).alias(f"mean_{m}") for m in MEANS], F.array(*[count(F.col("bin") == i) for i in range(10)]).alias("quality_histogram"),
        *[count(F.col("quality_bucket") == b).alias(f"quality_{b}") for b in ("high", "medium", "low")], F.round(F.avg("lid.share"), 6).alias("mean_lid_share"),
        F.round(F.avg(lid.consistent(F.col("lid.script"), F.col("language")).cast("double")), 6).alias("purity"), *[count(F.col("domain") == d).alias(f"domain_{d}") for d in domain.DOMAINS],
        count(F.size("pii") > 0).alias("pii_docs"), F.create_map(*[x for k in sorted(kinds) for x in (F.lit(k), F.coalesce(F.sum(F.try_element_at("pii", F.lit(k))), F.lit(0)))]).alias("pii_spans"),
    )
    langs = s.groupBy("shard_id", "lang").agg(F.count("*").alias("n")).groupBy("shard_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", "n")))).alias("lang_counts"))
    near = neardup.within_shards(sample, "key", "text", "shard_id")
    for more in (langs, near):
        out = out.join(more, "shard_id", "left")
    if items is not None:
        hit = contamination.screen(sample, "key", "text", items, *items.columns[:2]).select("key").distinct().join(s.select("key", "shard_id"), "key")
        out = out.join(hit.groupBy("shard_id").agg(F.count("*").alias("contaminated_docs")), "shard_id", "left").fillna(0, ["contaminated_docs"])
    if models is not None:
        bits = lm.bits_per_char(sample, "key", "language", "text", *models).join(s.select("key", "shard_id"), "key")
        names = {c: f"ppx_{c}" for c in ("scored", "mean", "p50", "p90", "p99", "max")}
        out = out.join(lm.distribution(bits, "shard_id").withColumnsRenamed(names), "shard_id", "left")
    if tokens is not None:
        full = full.join(F.broadcast(tokens.select("shard_id", "bytes_per_token")), "shard_id", "left").withColumn("estimated_tokens", F.floor(F.try_divide("doc_bytes", "bytes_per_token")))
    return full.join(out, "shard_id", "left")


def check_measured(docs: DataFrame, measured: DataFrame) -> None:
    """Raises unless every document to be built has been measured: a shard that was edited since must not be built."""
    missing = dedup.missing_from(docs, measured, "doc_hash")
    n = missing.count()
    if n:
        shards = sorted(r[0] for r in docs.join(missing, "doc_hash", "left_semi").select("shard_id").distinct().collect())
        raise ValueError(f"{n} documents were not measured before, in shards: {', '.join(shards)}; measure again")


def build(docs: DataFrame, b: Build) -> tuple[DataFrame, dict]:
    """``(judged documents, receipt)``. Cutoffs come from all documents given, before any filter. The receipt's configuration
    names everything that decided, what was computed on the way included."""
    d = docs.withColumn("doc_key", F.concat_ws(":", F.format_string("%06d", "shard_ord"), F.format_string("%012d", "doc_index")))
    near = bits = cut = None
    warnings: list[str] = []
    config = replace(b.config, lexicon_sha256=b.lexicon.sha256 if b.lexicon else None, ppx_percentile=b.perplexity, min_scored=b.min_scored)
    if b.items is not None:
        config = replace(config, eval_sha256=hashing.rows_sha256(b.items.select(*b.items.columns[:2])))
    if b.near:
        clustered = neardup.clusters(d, "doc_key", "text").join(d.select("doc_key", "doc_hash"), "doc_key")
        ids = materialize(neardup.drop_list(clustered, "doc_hash"), "drop-list")
        near = d.select("doc_key", "doc_hash").join(ids, "doc_hash", "left_semi").select("doc_key")
        config = replace(config, droplist_sha256=hashing.droplist_sha256(ids), near=neardup.PARAMETERS)
    if b.perplexity is not None:
        bits = materialize(lm.bits_per_char(d, "doc_key", "language", "text", *lm.train(d, "language", "text"), b.config.probes.get("perplexity_chars")), "bits")
        cut = materialize(lm.cutoffs(bits, "lang", b.perplexity, b.min_scored), "cutoffs")
        by_lang = {r["lang"]: r["cutoff"] for r in cut.where("lang is not null").collect()}
        config = replace(config, cutoffs={k: v for k, v in sorted(by_lang.items()) if v is not None})
        warnings += [f"too few scored documents for a cutoff: {k}" for k, v in sorted(by_lang.items()) if v is None]
    judged = verdict.verdicts(d, "doc_key", "text", "language", ["shard_ord", "doc_index"], config=config, near_drop=near, bits=bits, cutoffs=cut, lexicon=b.lexicon, items=b.items, plugins=b.plugins)
    judged = materialize(judged, "judged")
    reasons = {r["reason"]: r["docs"] for r in verdict.reason_counts(judged, b.plugins).collect()}
    kept = judged.where("drop_reason is null")
    receipt = {
        "corpus_id": b.corpus_id, "registry_sha256": b.registry_sha256, "parent_hash": (b.parent or {}).get("corpus_build_hash"), "config": config.content(), "filter_config_sha256": config.sha256(), "reasons": reasons,
        "warnings": warnings + manifest.build_warnings(reasons["kept"], sum(reasons.values())), "corpus_build_hash": hashing.ids_digest(docs), "filtered_build_hash": hashing.ids_digest(kept, distinct=False),
        "corpus_tree_hash": hashing.ids_tree_digest(docs), "filtered_tree_hash": hashing.ids_tree_digest(kept, distinct=False),
        "shards": sorted(r[0] for r in docs.select("shard_id").distinct().collect()),
    }
    return judged, receipt


def emit(docs: DataFrame, judged: DataFrame, out: str, policy: str = "redact") -> None:
    """Kept texts of ``docs``, and the drop log. With ``redact``, texts that hold identifiers anywhere are emitted with
    placeholders, the others as they are."""
    kept = docs.join(judged.where("drop_reason is not null").select("shard_id", "doc_index"), ["shard_id", "doc_index"], "left_anti")
    if policy == "redact":
        kept = kept.withColumn("_clean", pii.redact(F.col("text"))["text"])
        sinks.text_shards(kept, f"{out}/text", redacted="_clean")
    else:
        sinks.text_shards(kept, f"{out}/text")
    sinks.json_lines(verdict.drops_log(judged, ["shard_id", "language", "doc_index"]), f"{out}/drops")
