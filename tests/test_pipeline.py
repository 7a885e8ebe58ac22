"""Sources, sinks, the chain from files to receipts, streams, the command line."""

import io
import json
import struct
import threading
import urllib.request

import pytest
from pyspark.sql import functions as F

from tessera import cli, viewer
from tessera.functions import html, toxicity
from tessera.operators import manifest, tokenizer_lab, verdict
from tessera.plans import pipeline, report
from tessera.sources import corpus, sinks
from tessera.streaming import ingest

LONG = "The ferry keeper of the old town counted every boat on the river and wrote the numbers into a long green book that nobody else was ever allowed to read. " * 2


def _write(path, data):
    path.write_bytes(data.encode() if isinstance(data, str) else data)
    return str(path)


@pytest.mark.parametrize("sep", ["\n", "\r\n", "\r"])
def test_blank_line_documents(spark, tmp_path, sep):
    p = _write(tmp_path / "a.txt", "A\nA2\n\n\n\n B \n\nC\n".replace("\n", sep))
    got = [(r["doc_index"], r["text"]) for r in corpus.documents(spark, p).orderBy("doc_index").collect()]
    assert got == [(0, "A\nA2"), (1, "B"), (2, "C")]
    assert set(corpus.line_ends(spark, [p]).values()) == {{"\n": "lf", "\r\n": "crlf", "\r": "mixed"}[sep]}


def test_documents_in_many_parts(spark, tmp_path):
    docs = [f"document number {i} x" + "x" * (i % 97) for i in range(400)]
    p = _write(tmp_path / "big.txt", "\n\n".join(docs))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = [r["text"] for r in corpus.documents(spark, p).orderBy("doc_index").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == docs


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_many_files_in_one_scan(spark, tmp_path, end):
    want = {}
    for k in range(5):
        want[k] = [f"file {k} line {i}{end}more" for i in range(60)]
        (tmp_path / f"{k}.txt").write_bytes((end * 2).join(want[k]).encode())
    (tmp_path / "empty.txt").write_bytes(b"")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        rows = corpus.documents(spark, [str(p) for p in sorted(tmp_path.iterdir())]).orderBy("path", "doc_index").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r["path"].rsplit("/", 1)[1], r["doc_index"], r["text"]) for r in rows] == [(f"{k}.txt", i, t.replace("\r", "")) for k, texts in want.items() for i, t in enumerate(texts)]


def test_small_sources(spark, tmp_path):
    _write(tmp_path / "x.htm", "<p>hello</p>")
    _write(tmp_path / "eng.txt", "# no\nIdiot \n\nmoron\n")
    _write(tmp_path / "e.jsonl", '{"id": "1", "source": "s", "text": "t"}\n\n{"id": "2"}\n')
    _write(tmp_path / "ids.u64", struct.pack("<3Q", 1, 2**63, 7))
    assert corpus.pages(spark, str(tmp_path)).count() == 1
    assert {tuple(r) for r in corpus.lexicon_terms(spark, str(tmp_path)).collect()} == {("eng", "idiot"), ("eng", "moron")}
    assert corpus.eval_items(spark, str(tmp_path / "e.jsonl")).count() == 1
    assert [int.from_bytes(r["doc_hash"], "big") for r in corpus.raw_ids(spark, str(tmp_path / "ids.u64")).orderBy("at").collect()] == [1, 2**63, 7]
    assert corpus.checksums(spark, str(tmp_path / "eng.txt")).first()["length"] == 19
    assert corpus.eval_sources(spark, str(tmp_path / "e.jsonl"), "jsonl").count() == 1 and corpus.upstream(str(tmp_path)) is None


def _registry(tmp_path, shards):
    rows = [{"shard_id": k, "path": f"{k}.txt", "source": "s", "license": "CC0", "date_acquired": "2025-01-01", "data_class": c, "language": "eng"} for k, c in shards]
    return _write(tmp_path / "registry.json", json.dumps({"registry_version": 1, "corpus_id": "t", "shards": rows}))


@pytest.fixture
def two_shards(tmp_path):
    _write(tmp_path / "one.txt", "\n\n".join([f"{LONG} Ending {w}." for w in ("amber", "birch", "cedar")] + [f"{LONG} Ending amber.", "bad\n" * 50]))
    _write(tmp_path / "two.txt", "\n\n".join([f"{LONG} Ending amber.", "Write to a.b@example.org about it. " + " ".join(f"word{i} of{i}" for i in range(60))]))
    return _registry(tmp_path, [("one", "public"), ("two", "public"), ("three", "customer")])


def test_build_and_receipts(spark, tmp_path, two_shards):
    gated, docs = pipeline.read(spark, two_shards)  # the refused shard has no file at all
    assert docs.count() == 7
    m = {r["shard_id"]: r for r in pipeline.measure(docs, 1).collect()}
    assert m["one"]["exact_dup_docs"] == 1 and m["two"]["pii_docs"] == 1 and m["two"]["pii_spans"]["email"] == 1
    assert sum(m["one"]["quality_histogram"]) == m["one"]["sampled"] == 5 and m["one"]["lang_counts"] == {"eng": 5} and m["one"]["near_dup_rate"] == 0.6
    judged, receipt = pipeline.build(docs, pipeline.Build(near=False))
    assert receipt["reasons"] == receipt["reasons"] | {"exact_dup": 2, "quality": 1, "kept": 4} and receipt["warnings"]
    again, other = pipeline.build(docs.repartition(5), pipeline.Build(near=False))
    assert other["filtered_build_hash"] == receipt["filtered_build_hash"] != receipt["corpus_build_hash"]
    near = pipeline.build(docs, pipeline.Build())[1]["reasons"]
    assert near["near_dup"] == 2 and near["kept"] == 2
    pipeline.emit(docs, judged, str(tmp_path / "out"))
    text = "".join(r[0] for r in spark.read.text(str(tmp_path / "out/text/*/*"), wholetext=True).collect())
    assert "[PII:email]" in text and "a.b@example.org" not in text and "birch" in text
    assert spark.read.json(str(tmp_path / "out/drops")).count() == 3
    s = report.training_summary(gated, receipt)
    assert "three: forbidden" in s and "filtered" not in s.split("## Filters")[0] and receipt["filtered_build_hash"] in s and "GAP" in report.training_summary(gated, {})
    assert "&lt;b&gt;" in report.page("x", {"h": {"k": "<b>"}})


def test_a_build_is_identified_by_all_that_decides(spark, tmp_path, two_shards):
    _, docs = pipeline.read(spark, two_shards)
    items = spark.createDataFrame([("e", "the ferry keeper of the old town counted every boat on the river and wrote")], "id string, text string")
    ways = [{}, {"items": items}, {"lexicon": toxicity.Lexicon(("moron",))}, {"perplexity": 0.9}, {"near": True}, {"config": verdict.FilterConfig(probes={"pii_chars": 10})}]
    receipts = [pipeline.build(docs, pipeline.Build(**({"near": False} | w)))[1] for w in ways]
    assert len({r["filter_config_sha256"] for r in receipts}) == len(ways)
    assert receipts[1]["reasons"]["contamination"] and receipts[1]["config"]["eval_sha256"]
    with pytest.raises(ValueError):  # partitions that were screened against different items
        manifest.unite([receipts[0], receipts[1] | {"shards": ["other"]}])
    with pytest.raises(ValueError):
        verdict.FilterConfig(probes={"nothing": 1})
    assert pipeline.build(docs, pipeline.Build(near=False))[1]["filter_config_sha256"] == receipts[0]["filter_config_sha256"]


def test_only_measured_documents_are_built(spark, tmp_path, two_shards, capsys):
    out = str(tmp_path / "run")
    assert cli.main(["run", two_shards, "--out", out, "--every", "1", "--checksums"]) == 0
    held = json.loads((tmp_path / "run/MANIFEST.json").read_text())["files"]
    assert {k: v["sha256"] for k, v in held.items()} == {k: sinks.file_sha256(str(tmp_path / f"{k}.txt")) for k in ("one", "two")}
    assert cli.main(["build", two_shards, "--measured", out, "--out", str(tmp_path / "b"), "--lexicon", "builtin", "--no-near"]) == 0
    text = (tmp_path / "two.txt").read_text()
    (tmp_path / "two.txt").write_text(text.replace("amber", "ambers"))
    capsys.readouterr()
    assert cli.main(["build", two_shards, "--measured", out, "--out", str(tmp_path / "c")]) == 2 and "in shards: two" in capsys.readouterr().err
    (tmp_path / "two.txt").write_text(text)
    registry = json.loads((tmp_path / "registry.json").read_text())
    (tmp_path / "registry.json").write_text(json.dumps(registry, indent=2))
    assert cli.main(["build", two_shards, "--measured", out, "--out", str(tmp_path / "c")]) == 2 and "registry has changed" in capsys.readouterr().err
    assert cli.main(["run", two_shards, "--out", out, "--shards", "three"]) == 2 and "forbidden" in capsys.readouterr().err
    assert cli.main(["run", two_shards, "--out", out, "--shards", "nine"]) == 2


def test_partitions_unite_and_runs_merge(spark, tmp_path, two_shards, capsys):
    at = lambda name: str(tmp_path / name)
    whole = ["--no-near", "--perplexity", "0"]
    for shard in ("one", "two"):
        assert cli.main(["run", two_shards, "--out", at(f"run-{shard}"), "--shards", shard, "--every", "1"]) == 0
        assert cli.main(["build", two_shards, "--out", at(f"build-{shard}"), "--shards", shard, *whole]) == 0
    assert cli.main(["build-union", at("build-one"), at("build-two"), "--out", at("union")]) == 0
    united = json.loads((tmp_path / "union/BUILD-MANIFEST.json").read_text())
    assert united["rows"] == 5 and united["cross_partition_rekept_docs"] == 1 and united["shards"] == ["one", "two"] and united["reasons"]["kept"] == 5
    assert cli.main(["build-union", at("build-one"), at("nowhere"), "--out", at("u2")]) == 2
    assert cli.main(["build-union", at("build-one"), at("nowhere"), "--out", at("u2"), "--partial"]) == 0
    assert cli.main(["build", two_shards, "--out", at("other"), "--shards", "two", "--min-quality", "high", *whole]) == 0
    assert cli.main(["build-union", at("build-one"), at("other"), "--out", at("u3")]) == 2 and "min_quality" in capsys.readouterr().err
    assert cli.main(["merge", two_shards, at("run-one"), "--out", at("m")]) == 2
    assert cli.main(["merge", two_shards, at("run-one"), "--out", at("m"), "--partial"]) == 0
    assert cli.main(["merge", two_shards, at("run-one"), at("run-two"), "--out", at("merged")]) == 0
    m = json.loads((tmp_path / "merged/MANIFEST.json").read_text())
    assert (m["docs"], m["unique_docs"], m["intra_dups"], m["cross_dups"], m["partial"]) == (7, 5, 1, 1, False) and "| total | 7 |" in (tmp_path / "merged/COMPOSITION.md").read_text()


def test_measuring_with_a_model_of_json(spark, tmp_path, two_shards):
    text = f" {LONG}"
    contexts, singles = {}, {}
    for i in range(len(text) - 2):
        c = contexts.setdefault(text[i : i + 2], {})
        c[text[i + 2]] = c.get(text[i + 2], 0) + 1
    for ch in text:
        singles[ch] = singles.get(ch, 0) + 1
    _write(tmp_path / "eng.json", json.dumps({"k": 0.1, "contexts": contexts, "unigrams": singles}))
    assert cli.main(["run", two_shards, "--out", str(tmp_path / "r"), "--every", "1", "--lm-json", f"eng={tmp_path / 'eng.json'}"]) == 0
    shards = {s["shard_id"]: s for s in json.loads((tmp_path / "r/MANIFEST.json").read_text())["shards"]}
    assert shards["one"]["ppx_scored"] == 5 and 0 < shards["one"]["ppx_p50"] < shards["one"]["ppx_max"]
    assert cli.main(["attest", str(tmp_path), "--registry", two_shards, "--scan", "--out", str(tmp_path / "att.json")]) == 0
    a = json.loads((tmp_path / "att.json").read_text())
    assert a["provenance"]["status"] == "DECLARED" and a["scan"]["email"] >= 1


def test_tokenizer_laboratory(spark, tmp_path):
    for k in ("one", "two"):
        _write(tmp_path / f"{k}.txt", "\n\n".join(f"{k} {i} {LONG}" for i in range(400)))
    registry = _registry(tmp_path, [("one", "public"), ("two", "public")])
    at = lambda name: str(tmp_path / name)
    assert cli.main(["tokenizer-sample", registry, "--out", at("s0"), "--mb", "0.02"]) == 0
    assert cli.main(["tokenizer-sample", registry, "--out", at("s1"), "--mb", "0.02", "--phase", "1"]) == 0
    held = [{t for r in spark.read.option("lineSep", "\n\n").text(f"{at(s)}/text/*/*").collect() for t in [r[0]] if t} for s in ("s0", "s1")]
    assert all(held) and not held[0] & held[1]
    assert 20_000 <= json.loads((tmp_path / "s0/RECIPE.json").read_text())["languages"][0]["bytes"] < 20_400
    files = [f"{tokenizer_lab.TOKENIZERS}/{n}" for n in ("byte_bpe_50k.json", "word_bpe_49k.json")]
    assert cli.main(["tokenizer-eval", registry, "--out", at("e"), "--mb", "0.02", *(x for f in files for x in ("--tokenizer", f))]) == 0
    rows = json.loads((tmp_path / "e/TOKENIZERS.json").read_text())["rows"]
    assert len(rows) == 2 and all(r["bytes_per_token"] > 2 and r["projected_tokens"] > r["measured_tokens"] for r in rows)
    assert cli.main(["run", registry, "--out", at("run"), "--tokenizer", files[0], "--token-mb", "0.01"]) == 0
    assert all(s["estimated_tokens"] > 1000 for s in json.loads((tmp_path / "run/MANIFEST.json").read_text())["shards"])


def test_summary_states_gaps(spark, tmp_path, two_shards):
    gated, _ = pipeline.read(spark, two_shards)
    bare, told = report.training_summary(gated), report.training_summary(gated, declared={"provider": "P", "opt_out": "robots"})
    gaps = lambda t: int(t.split("## 4. Gaps\n")[1].split()[0])
    assert gaps(bare) == gaps(told) + 2 and "### 2.2 Licensed data\nNone." in bare and "three: forbidden" in bare


def test_attestation(spark, tmp_path):
    (tmp_path / "c").mkdir()
    _write(tmp_path / "c/a.txt", "one\n\ntwo")
    _write(tmp_path / "c/b.md", "two")
    _write(tmp_path / "c/attestation.json", "{}")
    docs = corpus.foreign_corpus(spark, str(tmp_path / "c"))
    a = report.attestation(docs, "x")
    assert (a["docs"], a["unique_docs"], a["provenance"]["status"]) == (3, 2, "UNKNOWN") and "one" not in report.attestation_text(a)
    assert report.attestation(docs, "x", scan=lambda t: F.create_map(F.lit("chars"), F.length(t)))["scan"] == {"chars": 9}
    assert a["corpus_build_hash"] == report.attestation(docs.repartition(3), "x")["corpus_build_hash"] != report.attestation(docs, "x", distinct=False)["corpus_build_hash"]


def test_viewer_shows_receipts_only(tmp_path):
    run = tmp_path / "runs/a b"
    run.mkdir(parents=True)
    sinks.manifest(str(run / "BUILD-MANIFEST.json"), {"corpus_id": "<c>", "reasons": {"kept": 3}})
    (run / "secret.txt").write_text("s")
    (tmp_path / "outside.json").write_text("o")
    (tmp_path / "runs/link").symlink_to(tmp_path)
    root = str(tmp_path / "runs")
    assert "a b" in viewer.respond(root, "/")[2] and "&lt;c&gt;" in viewer.respond(root, "/a%20b")[2]
    assert viewer.respond(root, "/a%20b/BUILD-MANIFEST.json")[0] == 200
    assert [viewer.respond(root, t)[0] for t in ("/a%20b/secret.txt", "/none", "/../outside.json", "/%2e%2e/outside.json", "/link/outside.json")] == [404, 404, 403, 403, 403]
    server = viewer.serve(root, 0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    with urllib.request.urlopen(f"http://127.0.0.1:{server.server_address[1]}/") as r:
        assert b"a b" in r.read()
    server.shutdown()
    server.server_close()


def test_reporter(tmp_path):
    out = io.StringIO()
    r = sinks.Reporter(sinks.EventLog(str(tmp_path)), out)
    for f, args in ((r.phase, ("read",)), (r.update, (5, 10)), (r.warn, ("w",)), (r.info, ("i",)), (r.error, ("e",)), (r.finish, ())):
        f(*args)
    assert "read: 5 of 10" in out.getvalue() and [e["kind"] for e in r.log.tail()] == ["phase", "update", "warn", "info", "error", "finish"]


def test_extraction_counts(spark, tmp_path):
    (tmp_path / "p").mkdir()
    _write(tmp_path / "p/a.html", f"<p>{LONG}</p>")
    _write(tmp_path / "p/b.html", "<p>short</p>")
    assert cli.main(["extract", str(tmp_path / "p"), "--out", str(tmp_path / "x")]) == 0
    assert json.loads((tmp_path / "x.extract.json").read_text()) == {"files": 2, "kept": 1, "too_short": 1, "extractors": {"strip_tags": 1}, "min_chars": 80}
    d = spark.createDataFrame([("<p>one</p>",), (None,)], "html string")
    assert [(r["text"], r["extractor"]) for r in html.extract(d, "html", 1, library=lambda c: F.upper(c)).collect()] == [("<P>ONE</P>", "main_content")]


def test_event_log(tmp_path):
    log = sinks.EventLog(str(tmp_path))
    log.emit("phase", n=1)
    assert log.running()
    log.emit("finish")
    assert not log.running() and len(log.tail()) == 2
    sinks.EventLog("/no/such/folder").emit("x")


def test_command_line(spark, tmp_path, two_shards, capsys):
    assert cli.main(["doctor"]) == 0
    assert cli.main(["init", str(tmp_path), "--registry", str(tmp_path / "new.json"), "--data-class", "public"]) == 0
    assert cli.main(["init", str(tmp_path), "--registry", str(tmp_path / "new.json")]) == 2
    assert cli.main(["check", two_shards]) == 2 and "forbidden" in capsys.readouterr().out
    assert cli.main(["run", two_shards, "--out", str(tmp_path / "run"), "--every", "1"]) == 0
    assert corpus.runs(str(tmp_path)) == [str(tmp_path / "run")]
    assert cli.main(["report", two_shards, "--out", str(tmp_path / "r.md")]) == 0
    _write(tmp_path / "q.txt", f"{LONG}\nshort\n{LONG}\n")
    assert cli.main(["eval-set", "--from-lines", str(tmp_path / "q.txt"), "--out", str(tmp_path / "ev")]) == 0 and spark.read.json(str(tmp_path / "ev")).count() == 1
    assert cli.main(["train-lm", two_shards, "--every", "1", "--out", str(tmp_path / "lm")]) == 0 and spark.read.parquet(str(tmp_path / "lm/trigram")).count() > 50
    assert cli.main(["neardup", two_shards, "--out", str(tmp_path / "nd")]) == 0 and spark.read.parquet(str(tmp_path / "nd/drop")).count() == 2
    assert cli.main(["pipeline", two_shards, "--out", str(tmp_path / "all"), "--every", "1"]) == 2
    assert cli.main(["pipeline", two_shards, "--out", str(tmp_path / "all"), "--every", "1", "--allow-refusals", "--emit"]) == 0 and (tmp_path / "all/REPORT.md").is_file()
    assert cli.main(["check", _write(tmp_path / "bad.json", '{"registry_version": 2, "shards": []}')]) == 2


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, "s", f"{LONG} {i % 5}", "2025-01-01 00:00:00") for i in range(20)] + [(99, "s", None, "2025-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "doc_id long, shard_id string, text string, at string").withColumn("acquired_at", F.to_timestamp("at")).drop("at")
    df.write.parquet(str(tmp_path / "in"))
    q = ingest.start(ingest.scored(ingest.landing(spark, str(tmp_path / "in"), "doc_id long, shard_id string, text string, acquired_at timestamp")), str(tmp_path / "out"), f"t{id(tmp_path)}")
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 5 and got.where("script = 'latn' and quality_score is not null").count() == 5


def test_carriage_returns_late_in_a_file(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"word " * 220_000 + b"\n\nsecond\r\n\r\nthird\r\nline\r\n\r\nfourth")
    row = {"shard_id": "a", "path": "a.txt", "source": "s", "license": "l", "date_acquired": "2025-01-01", "data_class": "public", "language": "eng"}
    (tmp_path / "registry.json").write_text(json.dumps({"registry_version": 1, "shards": [row]}))
    docs = pipeline.read(spark, str(tmp_path / "registry.json"))[1].where("doc_index > 0").orderBy("doc_index").collect()
    assert [r["text"] for r in docs] == ["second", "third\nline", "fourth"]
