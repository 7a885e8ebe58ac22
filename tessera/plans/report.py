"""Receipts for people: the provenance report, the composition table, the HTML page, attestations."""

from __future__ import annotations

import html
import platform
import sys
import unicodedata
from collections import Counter
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import hashing
from tessera.functions.pii import KINDS
from tessera.operators import gate, manifest

GAP = "GAP: not recorded"


def environment(spark: SparkSession | None = None) -> dict:
    """Versions that results can depend on."""
    return {
        "python": sys.version.split()[0], "unicode": unicodedata.unidata_version, "host": platform.machine(),
        "spark": spark.version if spark else None, "java": spark.sparkContext._jvm.System.getProperty("java.version") if spark else None,
    }


def provenance_block(meta: dict | None, accepted: list[dict] | None) -> dict:
    """Declared sources, or an explicit unknown; never blank."""
    if not accepted:
        return {"status": "UNKNOWN", "reason": "no registry was given" if meta is None else "no shard was accepted"}
    return {"status": "DECLARED", "corpus_id": (meta or {}).get("corpus_id", "unnamed"), "sources": sorted({a["source"] for a in accepted}), "shards": len(accepted)}


def attestation(docs: DataFrame, corpus_id: str, meta: dict | None = None, accepted: list[dict] | None = None, counters: DataFrame | None = None, distinct: bool = True, scan: Callable[[Column], Column] | None = None) -> dict:
    """The receipt of a foreign corpus of ``(path, text)``: counts, content hash, provenance.

    ``distinct=False`` hashes repeated ids too. ``scan`` makes a map of counters of each text, which are summed by name;
    ``counters`` has (name, n) rows of a scan made before.
    """
    total = manifest.attest(docs, "path", "text").where("level = 1").first()
    ids = docs.select(hashing.doc_hash(F.col("text")).alias("doc_hash"))
    if scan is not None:
        made = docs.select(F.explode(scan(F.col("text"))).alias("name", "n"))
        counters = made if counters is None else counters.select("name", "n").unionByName(made)
    found = {r[0]: r[1] for r in counters.groupBy("name").agg(F.sum("n")).orderBy("name").collect()} if counters is not None else {}
    return {
        "corpus_id": corpus_id, "generated_utc": datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"), "docs": total["docs"] if total else 0, "bytes": total["bytes"] if total else 0,
        "unique_docs": total["unique_docs"] if total else 0, "dup_rate": total["dup_rate"] if total else 0.0, "corpus_build_hash": hashing.ids_digest(ids, distinct=distinct),
        "hash_covers": "distinct ids" if distinct else "all ids", "scan": found, "provenance": provenance_block(meta, accepted), "environment": environment(docs.sparkSession),
    }


def attestation_text(a: dict) -> str:
    """The receipt for a terminal."""
    p = a["provenance"]
    lines = [f"corpus    {a['corpus_id']}", f"documents {a['docs']:,} ({a['unique_docs']:,} distinct, duplicate rate {a['dup_rate']:.4f})", f"bytes     {a['bytes']:,}", f"hash      {a['corpus_build_hash']}", f"origin    {p['status']}" + (": " + ", ".join(p["sources"]) if "sources" in p else f" ({p['reason']})")]
    return "\n".join(lines)


def is_filtered_build(m: dict | None) -> bool:
    """Whether a manifest is of a filtered build: only such a one has counts of dropped documents."""
    return bool(m) and "filtered_build_hash" in m


def table(head: tuple[str, ...], rows: list[tuple]) -> list[str]:
    """Lines of a Markdown table; what is null or blank is a gap."""
    return ["| " + " | ".join(head) + " |", "|" + "-|" * len(head), *("| " + " | ".join(GAP if v in (None, "") else f"{v:,}" if isinstance(v, int) else str(v).replace("|", "/") for v in r) + " |" for r in rows)]


def training_summary(gated: DataFrame, build: dict | None = None, corpus: dict | None = None, declared: dict | None = None) -> str:
    """Markdown summary of training content for publication, after the public template: who and what, where the data come from
    by class, languages, what was refused, and how the data were processed.

    Everything is a projection of the registry, the manifest of a filtered ``build`` and that of the measured ``corpus``;
    ``declared`` has what no receipt can know (provider, contact, model, opt-out policy). Whatever is not recorded is stated
    as a gap and counted, never left out; nothing is truncated.
    """
    declared, corpus = declared or {}, corpus or {}
    ok = gate.provenance(gated).orderBy("shard_id").collect()
    refused = gated.where("reason is not null").select("shard_id", "reason").orderBy("shard_id").collect()
    meta = gated.select(*[c for c in ("corpus_id",) if c in gated.columns]).first()
    measured = {s["shard_id"]: s for s in corpus.get("shards", [])}
    filtered = is_filtered_build(build)
    config = (build or {}).get("config", {}) if filtered else {}
    out = [f"# Summary of training content: {meta[0] if meta else 'unnamed'}", "", "## 1. General information"]
    out += [f"- {label}: {declared.get(key) or GAP}" for key, label in (("provider", "Provider"), ("contact", "Contact"), ("model", "Model"), ("released", "Placed on the market"))]
    out += ["- Modality: text", f"- Size: {corpus['docs']:,} documents, {corpus['doc_bytes']:,} bytes" if "docs" in corpus else f"- Size: {GAP}", f"- Estimated tokens: {corpus.get('estimated_total_tokens') or GAP}"]
    dates = sorted(r["date_acquired"] for r in ok if r["date_acquired"])
    out += [f"- Acquired: {dates[0]} to {dates[-1]}" if dates else f"- Acquired: {GAP}", ""]
    out += ["## 2. Sources"]
    for kind, title in (("public", "2.1 Publicly available data"), ("licensed", "2.2 Licensed data"), ("synthetic-own", "2.3 Synthetic data of our own")):
        mine = [r for r in ok if (r["data_class"] or "").strip().lower() == kind]
        out += ["", f"### {title}"]
        rows = [(r["shard_id"], r["source"], r["license"], r["language"], r["date_acquired"], measured.get(r["shard_id"], {}).get("docs"), measured.get(r["shard_id"], {}).get("doc_bytes")) for r in mine]
        out += table(("shard", "source", "licence", "language", "acquired", "documents", "bytes"), rows) if rows else ["None."]
    out += ["", "### 2.4 Data of users or customers", "None is admitted: the registry refuses such classes.", "", "### 2.5 Licences"]
    out += [f"- {k}: {n}" for k, n in sorted(Counter(r["license"] for r in ok).items(), key=lambda x: (-x[1], x[0]))] or [GAP]
    out += ["", "### 2.6 Languages"] + ([f"- {k}: {n} shards" for k, n in sorted(Counter(r["language"] for r in ok).items())] or [GAP])
    out += ["", "### 2.7 Refused", f"{len(refused)} shards were refused."] + [f"- {r['shard_id']}: {r['reason']}" for r in refused]
    out += ["", "## 3. Processing", "", "### 3.1 Filters"]
    if filtered:
        out += [f"- {k}: {n:,}" for k, n in sorted(build.get("reasons", {}).items())] + [f"- configuration {build.get('filter_config_sha256', GAP)}", f"- build hash {build['filtered_build_hash']}"]
    else:
        out += [GAP + " (the manifest given is not of a filtered build)"]
    out += ["", "### 3.2 Rights reserved by rightholders", f"- Opt-out policy: {declared.get('opt_out') or GAP}"]
    out += ["", "### 3.3 Illegal and harmful content", f"- Lexicon: {config.get('lexicon_sha256') or GAP}"]
    out += ["", "### 3.4 Personal data", f"- Policy: {config.get('pii_policy') or GAP}", "- Detectors: " + ", ".join(KINDS) + "."]
    out += ["", "### 3.5 Evaluation data", f"- Screened against: {config.get('eval_sha256') or GAP}"]
    gaps = sum(line.count(GAP) for line in out)
    return "\n".join([*out, "", "## 4. Gaps", f"{gaps} entries are not recorded."]) + "\n"


def composition(corpus: dict) -> str:
    """Markdown table of a measured corpus by shard with totals."""
    rows = [(s["shard_id"], s["docs"], s["doc_bytes"], s["unique_docs"], f"{1 - s['unique_docs'] / s['docs']:.4f}" if s["docs"] else "0.0000", s.get("mean_quality_score")) for s in corpus["shards"]]
    total = ("total", corpus["docs"], corpus["doc_bytes"], corpus.get("unique_docs"), f"{corpus.get('dup_rate', 0.0):.4f}", "")
    return "\n".join([f"# Composition of {corpus.get('corpus_id', 'unnamed')}", "", *table(("shard", "documents", "bytes", "distinct", "duplicates", "quality"), rows + [total])]) + "\n"


def page(title: str, sections: dict[str, dict]) -> str:
    """A page of its own without scripts or links; every value is escaped."""
    e = lambda x: html.escape(str(x))
    body = "".join(f"<h2>{e(h)}</h2><table>" + "".join(f"<tr><th>{e(k)}</th><td>{e(v)}</td></tr>" for k, v in s.items()) + "</table>" for h, s in sections.items())
    return f"<!doctype html><html><head><meta charset='utf-8'><title>{e(title)}</title><style>body{{font-family:sans-serif}}th{{text-align:left;padding-right:2em}}</style></head><body><h1>{e(title)}</h1>{body}</body></html>"
