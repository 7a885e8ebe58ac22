"""Command line: check a registry, measure, build, attest, report.  ``python -m tessera.cli VERB --help``"""

from __future__ import annotations

import argparse
import importlib.util
import json
import os
import shutil
import sys
import time
from functools import reduce

from pyspark.sql import functions as F


def _session():
    """The running session, one from the cluster that started this program, or else a local one."""
    from pyspark.sql import SparkSession

    from tessera.session import local_session

    held = SparkSession.getActiveSession()
    if held is not None:
        return held
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ or "SPARK_REMOTE" in os.environ
    return SparkSession.builder.appName("tessera").getOrCreate() if submitted else local_session()


def _read_json(*parts: str) -> dict:
    with open(os.path.join(*parts), encoding="utf-8") as f:
        return json.load(f)


def _plain(row: dict) -> dict:
    return {k: dict(v) if isinstance(v, dict) else v for k, v in row.items()}


def doctor(_: argparse.Namespace) -> int:
    """What is installed; 1 if the engine cannot run."""
    need = {m: importlib.util.find_spec(m) is not None for m in ("pyspark", "pyarrow", "pandas", "numpy")}
    more = {m: importlib.util.find_spec(m) is not None for m in ("ahocorasick", "regex", "zstandard", "tokenizers", "tiktoken")}
    need["java"] = shutil.which("java") is not None or "JAVA_HOME" in os.environ
    for name, ok in {**need, **more}.items():
        print(f"{'ok     ' if ok else 'missing'} {name}{'' if name in need else ' (optional)'}")
    return 0 if all(need.values()) else 1


def init(a: argparse.Namespace) -> int:
    """A registry of a folder's text files with blank provenance to be filled in by a person."""
    from tessera.operators.gate import SUSPECT
    import re

    if os.path.exists(a.registry) and not a.force:
        print(f"{a.registry} exists; use --force to overwrite", file=sys.stderr)
        return 2
    shards = []
    for name in sorted(os.listdir(a.folder)):
        stem, ext = os.path.splitext(name)
        if ext not in (".txt", ".jsonl"):
            continue
        tail = stem.rsplit("_", 1)[-1]
        suspect = re.search(SUSPECT, name)
        shards.append({"shard_id": stem, "path": os.path.join(a.folder, name), "source": "", "license": "", "date_acquired": "", "data_class": "" if suspect else a.data_class or "", "language": tail if len(tail) == 3 else "", "reviewed_by": ""})
    with open(a.registry, "w", encoding="utf-8") as f:
        json.dump({"registry_version": 1, "corpus_id": a.corpus_id, "shards": shards}, f, indent=1)
    print(f"{len(shards)} shards; fill in the blank fields before use")
    return 0


def check(a: argparse.Namespace) -> int:
    """Accepted and refused shards, missing and empty files; 2 if any shard is refused or cannot be read."""
    from tessera.operators import gate
    from tessera.sources import corpus

    spark, bad = _session(), 0
    root = os.path.dirname(os.path.abspath(a.registry))
    for r in gate.gate(corpus.registry(spark, a.registry), order=["position"]).orderBy("position").collect():
        state = f"refused: {r['reason']}" if r["reason"] else "accepted"
        if not r["reason"]:
            path = os.path.join(root, r["path"])
            state += "" if os.path.isfile(path) and os.path.getsize(path) else ", but its file is missing or empty"
        bad += state != "accepted"
        print(f"{r['shard_id']}: {state}")
    return 2 if bad else 0


def run(a: argparse.Namespace) -> int:
    """Measure the accepted shards and write statistics, ids, the corpus manifest and its composition."""
    from tessera.functions import hashing
    from tessera.operators import tokenizer_lab
    from tessera.plans import pipeline, report
    from tessera.sources import corpus, sinks

    spark, began = _session(), time.time()
    os.makedirs(a.out, exist_ok=True)
    log = sinks.Reporter(sinks.EventLog(a.out))
    log.phase("read")
    gated, docs = pipeline.read(spark, a.registry, a.shards)
    if a.max_docs:
        docs = docs.where(F.col("doc_index") < a.max_docs)
    items = corpus.eval_items(spark, a.eval_set).select("id", "text") if a.eval_set else None
    models = (spark.read.parquet(f"{a.lm}/trigram"), spark.read.parquet(f"{a.lm}/unigram")) if a.lm else None
    for given in a.lm_json or []:  # LANGUAGE=FILE
        one = corpus.language_model(spark, given.partition("=")[2], given.partition("=")[0])
        models = one if models is None else tuple(x.select(y.columns).unionByName(y) for x, y in zip(models, one, strict=True))
    tokens = tokenizer_lab.metered(docs, "shard_id", "doc_index", "text", int(a.token_mb * 1e6), a.tokenizer) if a.tokenizer else None
    log.phase("measure")
    rows = [_plain(r.asDict(recursive=True)) for r in pipeline.measure(docs, a.every, items, models, tokens).orderBy("shard_id").collect()]
    sinks.identities(docs, f"{a.out}/ids")
    total = {k: sum(r[k] for r in rows) for k in ("docs", "doc_bytes")}
    sums = {}
    if a.checksums:
        log.phase("checksums")
        wanted = pipeline.places(gated, a.registry, a.shards)
        names = {corpus.qualified(spark, p): k for k, p in wanted.items()}
        keyed = corpus.checksums(spark, sorted(wanted.values())).withColumn("path", corpus.plain_uri(F.col("path")))
        listed = spark.createDataFrame(list(names.items()), "path string, shard_id string").withColumn("path", corpus.plain_uri(F.col("path")))
        sums = {r["shard_id"]: {"bytes": r["length"], "sha256": r["sha256"]} for r in keyed.join(F.broadcast(listed), "path").collect()}
    content = {
        "files": sums, "corpus_id": gated.first()["corpus_id"], "registry_sha256": sinks.file_sha256(a.registry), "shards": rows, **total, "corpus_build_hash": hashing.ids_digest(docs), "truncated_by_max_docs": bool(a.max_docs),
        "every": a.every, "seconds": round(time.time() - began, 1), "environment": report.environment(spark),
    }
    print(sinks.manifest(f"{a.out}/MANIFEST.json", content))
    log.finish()
    return 0


def merge(a: argparse.Namespace) -> int:
    """One corpus manifest of several measured runs; 2 if accepted shards are missing, unless --partial."""
    from tessera.functions import hashing
    from tessera.operators import dedup, gate, manifest
    from tessera.plans import report
    from tessera.sources import corpus, sinks

    spark = _session()
    accepted = [r[0] for r in gate.accepted(gate.gate(corpus.registry(spark, a.registry), order=["position"])).select("shard_id").collect()]
    merged = manifest.merge_runs([_read_json(r, "MANIFEST.json") for r in a.runs], accepted, a.partial)
    ids = reduce(lambda x, y: x.unionByName(y), [spark.read.parquet(f"{r}/ids") for r in a.runs])
    counts = dedup.intra_cross(ids, "shard_id", "doc_hash").first().asDict()
    merged |= {k: counts[k] for k in ("unique_docs", "global_dups", "intra_dups", "cross_dups")} | {"dup_rate": round(counts["global_dups"] / counts["docs"], 6) if counts["docs"] else 0.0, "corpus_build_hash": hashing.ids_digest(ids)}
    sinks.identities(ids, f"{a.out}/ids")
    with open(os.path.join(a.out, "COMPOSITION.md"), "w", encoding="utf-8") as f:
        f.write(report.composition(merged))
    print(sinks.manifest(f"{a.out}/MANIFEST.json", merged))
    return 0


def _lexicon(spark, given: str | None):
    from tessera.functions import toxicity
    from tessera.sources import corpus

    if given is None:
        return None
    if given == "builtin":
        return toxicity.builtin()
    return toxicity.Lexicon(tuple(r["term"] for r in corpus.lexicon_terms(spark, given).collect()), given)


def build(a: argparse.Namespace) -> int:
    """Apply the filters and write the ids of kept documents, the build manifest and its page, and with --emit texts and drops."""
    from tessera.operators import contamination
    from tessera.operators.verdict import PUBLISHED_PROBES, FilterConfig, with_plugins
    from tessera.plans import pipeline, report
    from tessera.plugins import load
    from tessera.sources import corpus, sinks

    spark = _session()
    os.makedirs(a.out, exist_ok=True)
    log = sinks.Reporter(sinks.EventLog(a.out))
    log.phase("read")
    gated, docs = pipeline.read(spark, a.registry, a.shards)
    sha, parent = sinks.file_sha256(a.registry), None
    if a.measured:
        parent = _read_json(a.measured, "MANIFEST.json")
        if parent.get("registry_sha256") != sha:
            raise ValueError("the registry has changed since it was measured; measure again")
        pipeline.check_measured(docs, spark.read.parquet(f"{a.measured}/ids"))
    plugins = load(a.plugin or [])
    items = corpus.eval_items(spark, a.eval_set).select("id", "text") if a.eval_set else None
    cfg = with_plugins(FilterConfig(min_quality=a.min_quality, pii_policy=a.pii, probes=PUBLISHED_PROBES if a.published_probes else {}), plugins)
    want = pipeline.Build(config=cfg, items=items, plugins=plugins, lexicon=_lexicon(spark, a.lexicon), min_scored=a.min_scored, perplexity=a.perplexity or None, near=not a.no_near, corpus_id=gated.first()["corpus_id"], registry_sha256=sha, parent=parent)
    log.phase("judge")
    judged, receipt = pipeline.build(docs, want)
    if items is not None:
        keyed = docs.withColumn("document", F.concat_ws(":", "shard_id", "doc_index"))
        receipt["first_hits"] = [r.asDict() for r in contamination.first_hits(contamination.screen(keyed, "document", "text", items, "id", "text"), "document").collect()]
    sinks.identities(judged.where("drop_reason is null"), f"{a.out}/kept")
    if a.emit:
        pipeline.emit(docs, judged, a.out, a.pii)
    sinks.manifest(f"{a.out}/BUILD-MANIFEST.json", receipt)
    with open(os.path.join(a.out, "receipt.html"), "w", encoding="utf-8") as f:
        f.write(report.page(f"Build of {receipt['corpus_id']}", {"Reasons": receipt["reasons"], "Configuration": receipt["config"], "Hashes": {k: receipt[k] for k in ("corpus_build_hash", "filtered_build_hash", "filter_config_sha256")}}))
    for w in receipt["warnings"]:
        log.warn(w)
    log.finish()
    print(json.dumps(receipt["reasons"]))
    return 0


def union(a: argparse.Namespace) -> int:
    """Unite partition builds: one set of kept ids and its hash. A part without a manifest is an error, unless --partial."""
    from tessera.functions import hashing
    from tessera.operators import manifest
    from tessera.sources import sinks

    spark = _session()
    whole = [p for p in a.parts if os.path.isfile(os.path.join(p, "BUILD-MANIFEST.json"))]
    skipped = [p for p in a.parts if p not in whole]
    if skipped and not a.partial:
        raise ValueError(f"not finished: {', '.join(skipped)}")
    content = manifest.unite([_read_json(p, "BUILD-MANIFEST.json") for p in whole])
    ids = [spark.read.parquet(f"{p}/kept") for p in whole]
    counts = manifest.union_builds(ids, "doc_hash").first().asDict()
    content |= {"filtered_build_hash": hashing.ids_digest(reduce(lambda x, y: x.unionByName(y), [i.select("doc_hash") for i in ids])), "hash_covers": "distinct ids", "skipped_parts": skipped, **counts}
    print(sinks.manifest(f"{a.out}/BUILD-MANIFEST.json", content))
    return 0


def attest(a: argparse.Namespace) -> int:
    """A receipt for a folder of texts that was made elsewhere."""
    from tessera.functions import pii
    from tessera.operators import gate
    from tessera.plans import report
    from tessera.sources import corpus, sinks

    meta = accepted = None
    spark = _session()
    if a.registry:
        rows = gate.accepted(gate.gate(corpus.registry(spark, a.registry), order=["position"])).collect()
        meta, accepted = {"corpus_id": rows[0]["corpus_id"]} if rows else {}, [r.asDict() for r in rows]
    content = report.attestation(corpus.foreign_corpus(spark, a.folder), a.corpus_id, meta, accepted, scan=pii.scan if a.scan else None) | {"upstream": corpus.upstream(a.folder)}
    print(report.attestation_text(content))
    sinks.manifest(a.out, content)
    return 0


def summary(a: argparse.Namespace) -> int:
    """The Markdown summary of training content."""
    from tessera.operators import gate
    from tessera.plans import report
    from tessera.sources import corpus

    given = [_read_json(p) if p else None for p in (a.manifest, a.corpus, a.declared)]
    text = report.training_summary(gate.gate(corpus.registry(_session(), a.registry), order=["position"]), *given)
    with open(a.out, "w", encoding="utf-8") as f:
        f.write(text)
    return 0


def extract(a: argparse.Namespace) -> int:
    """Text of a folder of HTML files, with counts beside it."""
    from tessera.functions import html
    from tessera.sources import corpus, sinks

    pages = corpus.pages(_session(), a.folder)
    texts = html.extract(pages, "html", a.min_chars)
    texts.select("text").write.option("lineSep", "\n\n").text(a.out)
    kept = {r["extractor"]: r["n"] for r in texts.groupBy("extractor").agg(F.count("*").alias("n")).collect()}
    files = pages.count()
    sinks.manifest(f"{a.out.rstrip('/')}.extract.json", {"files": files, "kept": sum(kept.values()), "too_short": files - sum(kept.values()), "extractors": kept, "min_chars": a.min_chars})
    return 0


def tokenizer_sample(a: argparse.Namespace) -> int:
    """Equal bytes of every language from windows spread over the shards, with the recipe beside them."""
    from tessera.operators import tokenizer_lab
    from tessera.plans import pipeline
    from tessera.sources import sinks

    _, docs = pipeline.read(_session(), a.registry, a.shards)
    placed = docs.withColumn("place", F.col("shard_ord").cast("long") * (1 << 40) + F.col("doc_index"))
    sample = tokenizer_lab.balanced_sample(placed, "language", "place", "text", int(a.mb * 1e6), a.phase)
    sinks.text_shards(sample, f"{a.out}/text", shard="language", order="place")
    rows = [r.asDict() for r in sample.groupBy("language").agg(F.count("*").alias("docs"), F.sum("n_bytes").alias("bytes")).orderBy("language").collect()]
    print(sinks.manifest(f"{a.out}/RECIPE.json", {"registry_sha256": sinks.file_sha256(a.registry), "phase": a.phase, "budget_bytes": int(a.mb * 1e6), "windows": tokenizer_lab.WINDOWS, "languages": rows}))
    return 0


def tokenizer_eval(a: argparse.Namespace) -> int:
    """Bytes per token of several vocabularies by language, on the other phase's sample, with projections to the corpus."""
    from tessera.operators import tokenizer_lab
    from tessera.plans import pipeline, report
    from tessera.sources import sinks

    _, docs = pipeline.read(_session(), a.registry, a.shards)
    placed = docs.withColumn("place", F.col("shard_ord").cast("long") * (1 << 40) + F.col("doc_index"))
    sample = tokenizer_lab.balanced_sample(placed, "language", "place", "text", int(a.mb * 1e6), a.phase)
    sizes = docs.groupBy("language").agg(F.sum("n_bytes").alias("doc_bytes"))
    rows = [r.asDict() for r in tokenizer_lab.compare(sample, "language", "text", a.tokenizer, sizes).orderBy("tokenizer", "language").collect()]
    sinks.manifest(f"{a.out}/TOKENIZERS.json", {"phase": a.phase, "rows": rows})
    head = ("tokenizer", "language", "measured_docs", "bytes_per_token", "projected_tokens")
    with open(os.path.join(a.out, "TOKENIZERS.md"), "w", encoding="utf-8") as f:
        f.write("\n".join(report.table(head, [tuple(r[h] for h in head) for r in rows])) + "\n")
    return 0


def eval_set(a: argparse.Namespace) -> int:
    """An evaluation set of files, lines or fields of JSON lines: long enough items, each text once."""
    from tessera.functions import hashing
    from tessera.operators import contamination
    from tessera.session import materialize
    from tessera.sources import corpus, sinks

    spark, items = _session(), None
    for kind, paths in (("dir", a.from_dir), ("lines", a.from_lines), ("jsonl", a.from_jsonl)):
        for path in paths or []:
            one = corpus.eval_sources(spark, path, kind, a.field)
            items = one if items is None else items.unionByName(one)
    if items is None:
        raise ValueError("no source was given")
    built = materialize(contamination.build_eval_set(items, "source", "text", a.min_chars), "eval-set")
    sinks.json_lines(built, a.out)
    print(hashing.rows_sha256(built.select("id", "text")))
    return 0


def train_lm(a: argparse.Namespace) -> int:
    """Language models of the accepted shards, one for each language."""
    from tessera.operators import lm, sampling
    from tessera.plans import pipeline
    from tessera.sources import sinks

    _, docs = pipeline.read(_session(), a.registry, a.shards)
    sample = sampling.byte_budget(sampling.stride(docs, a.every), "shard_id", "doc_index", "n_bytes", int(a.max_mb * 1e6))
    for r in sample.groupBy("language").agg(F.count("*").alias("docs"), F.sum("n_bytes").alias("bytes")).collect():
        if r["docs"] < 50 or r["bytes"] < 200_000:
            print(f"warning: the model of {r['language']} is thin: {r['docs']} documents, {r['bytes']} bytes", file=sys.stderr)
    sinks.model(*lm.train(sample, "language", "text"), a.out)
    return 0


def neardup(a: argparse.Namespace) -> int:
    """Signatures, clusters and the drop list of near duplicates."""
    from tessera.functions.hashing import droplist_sha256
    from tessera.operators import neardup as N
    from tessera.plans import pipeline
    from tessera.session import materialize
    from tessera.sources import sinks

    _, docs = pipeline.read(_session(), a.registry, a.shards)
    d = docs.withColumn("key", F.concat_ws(":", F.format_string("%06d", "shard_ord"), F.format_string("%012d", "doc_index")))
    clustered, signed, linked = N.sweep(d, "key", "text", a.min_agree, a.max_words)
    clustered = materialize(clustered.join(d.select("key", "doc_hash"), "key"), "clusters")
    ids = N.drop_list(clustered, "doc_hash")
    sinks.signatures(signed.join(d.select("key", "shard_id"), "key"), f"{a.out}/sigs")
    sinks.drop_list(ids, f"{a.out}/drop")
    stats = N.sweep_stats(clustered, signed, linked, "doc_hash").first().asDict()
    print(sinks.manifest(f"{a.out}/NEARDUP.json", stats | {"droplist_sha256": droplist_sha256(ids), "params": N.PARAMETERS | {"verify_min_agree": a.min_agree, "max_words": a.max_words}}))
    return 0


def pipeline_(a: argparse.Namespace) -> int:
    """Check, measure, build and report in this order; stops at the first step that fails."""
    refused = check(a)
    if refused and not a.allow_refusals:
        return refused
    if code := run(a):
        return code
    a.measured = None if a.max_docs else a.out
    if code := build(a):
        return code
    a.manifest, a.corpus, a.declared, a.out = f"{a.out}/BUILD-MANIFEST.json", f"{a.out}/MANIFEST.json", None, f"{a.out}/REPORT.md"
    return summary(a)


def plugins(_: argparse.Namespace) -> int:
    """Installed filter plugins."""
    from tessera.plugins import available

    for name, e in sorted(available().items()):
        print(name, e.value)
    return 0


def ui(a: argparse.Namespace) -> int:
    """Show the runs below a folder on this machine only."""
    from tessera.viewer import serve

    server = serve(a.folder, a.port)
    print(f"http://127.0.0.1:{server.server_address[1]}/ (Ctrl-C ends it)")
    try:
        server.serve_forever()
    except KeyboardInterrupt:
        server.server_close()
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera", description=__doc__)
    verbs = p.add_subparsers(required=True)

    def verb(f, *args, name=None):
        v = verbs.add_parser(name or f.__name__, help=f.__doc__)
        v.set_defaults(fn=f)
        for names, options in args:
            v.add_argument(*names, **options)

    reg = (["registry"], {})
    out = (["--out"], {"required": True})
    shards = (["--shards"], {"nargs": "*"})
    verb(doctor)
    verb(init, (["folder"], {}), (["--registry"], {"default": "registry.json"}), (["--corpus-id"], {"default": "unnamed"}), (["--data-class"], {}), (["--force"], {"action": "store_true"}))
    verb(check, reg)
    measuring = [(["--every"], {"type": int, "default": 50}), (["--max-docs"], {"type": int}), (["--eval-set"], {}), (["--lm"], {}), (["--lm-json"], {"action": "append"}), (["--tokenizer"], {}), (["--token-mb"], {"type": float, "default": 30.0}), (["--checksums"], {"action": "store_true"})]
    building = [
        (["--plugin"], {"action": "append"}), (["--pii"], {"choices": ["keep", "redact", "drop"], "default": "redact"}), (["--emit"], {"action": "store_true"}), (["--min-scored"], {"type": int, "default": 200}),
        (["--min-quality"], {"choices": ["low", "medium", "high"], "default": "medium"}), (["--perplexity"], {"type": float, "default": 0.99}), (["--no-near"], {"action": "store_true"}), (["--lexicon"], {}),
        (["--published-probes"], {"action": "store_true"}),
    ]
    partial = (["--partial"], {"action": "store_true"})
    verb(run, reg, out, shards, *measuring)
    verb(merge, reg, (["runs"], {"nargs": "+"}), out, partial)
    verb(build, reg, out, shards, (["--eval-set"], {}), (["--measured"], {}), *building)
    verb(union, (["parts"], {"nargs": "+"}), out, partial, name="build-union")
    verb(attest, (["folder"], {}), (["--corpus-id"], {"default": "unnamed"}), (["--registry"], {}), (["--scan"], {"action": "store_true"}), out)
    verb(summary, reg, (["--manifest"], {}), (["--corpus"], {}), (["--declared"], {}), out, name="report")
    verb(extract, (["folder"], {}), out, (["--min-chars"], {"type": int, "default": 80}))
    verb(plugins)
    verb(ui, (["folder"], {}), (["--port"], {"type": int, "default": 8377}))
    source = {"action": "append"}
    verb(eval_set, (["--from-dir"], source), (["--from-lines"], source), (["--from-jsonl"], source), (["--field"], {"default": "text"}), (["--min-chars"], {"type": int, "default": 40}), out, name="eval-set")
    verb(train_lm, reg, out, shards, (["--every"], {"type": int, "default": 50}), (["--max-mb"], {"type": float, "default": 64.0}), name="train-lm")
    verb(neardup, reg, out, shards, (["--min-agree"], {"type": int, "default": 21}), (["--max-words"], {"type": int}))
    size = (["--mb"], {"type": float, "default": 10.0})
    verb(tokenizer_sample, reg, out, shards, size, (["--phase"], {"type": int, "choices": [0, 1], "default": 0}), name="tokenizer-sample")
    verb(tokenizer_eval, reg, out, shards, size, (["--phase"], {"type": int, "choices": [0, 1], "default": 1}), (["--tokenizer"], {"action": "append", "required": True}), name="tokenizer-eval")
    verb(pipeline_, reg, out, shards, *measuring, *building, (["--allow-refusals"], {"action": "store_true"}), name="pipeline")
    return p


def main(argv: list[str] | None = None) -> int:
    """Runs a verb; errors of use are 2."""
    a = parser().parse_args(argv)
    try:
        return a.fn(a)
    except (ValueError, FileNotFoundError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
