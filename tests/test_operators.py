"""Operators on small tables: nulls, ties, repeats, empty tables, clashing columns, invariance to partitioning."""

import random
from pathlib import Path

import numpy as np
import psutil
import pytest
from pyspark.sql import functions as F

from tessera.functions.toxicity import Lexicon
from tessera.operators.percentiles import percentiles
from tessera.operators import contamination, dedup, gate, lm, manifest, neardup, sampling, tokenizer_lab, verdict
from tessera.plans import catalogue
from tessera.plugins import TextPlugin, identities, load, min_words

BASE = "the quick brown fox jumps over the lazy dog while the farmer counts every sheep on the green hill near the old mill and the river runs slowly past the stone bridge toward the quiet sea at dawn"
ROW = {"shard_id": "a", "path": "/a.txt", "source": "s", "license": "l", "date_acquired": "2025-01-01", "data_class": "public", "language": "eng", "reviewed_by": None}


def _registry(spark, *changes):
    cols = list(ROW)
    return spark.createDataFrame([tuple((ROW | {"shard_id": f"s{i}"} | c)[k] for k in cols) for i, c in enumerate(changes)], ", ".join(f"{c} string" for c in cols))


def test_gate(spark):
    reg = _registry(
        spark, {}, {"data_class": " CUSTOMER ", "reviewed_by": "me"}, {"source": " "}, {"data_class": "internal"}, {"path": "/client_x.txt"}, {"path": "/client_x.txt", "reviewed_by": "me"},
        {"shard_id": "s0", "path": "/b.txt"}, {"shard_id": None}, {"shard_id": None, "path": None},
    )
    got = {(r["shard_id"], r["path"]): r["reason"] for r in gate.gate(reg).collect()}
    assert got["s0", "/a.txt"] is None and got["s0", "/b.txt"] == "duplicate shard_id" and got["s1", "/a.txt"].startswith("forbidden")
    assert got["s2", "/a.txt"] == "missing fields: source" and got["s3", "/a.txt"].startswith("unknown") and got["s4", "/client_x.txt"].startswith("suspect")
    assert got["s5", "/client_x.txt"] is None and got[None, "/a.txt"] == "missing fields: shard_id" and got[None, None] == "missing fields: shard_id, path"
    docs = spark.createDataFrame([("s0", 1), ("s1", 2), (None, 3)], "shard_id string, reason int")
    assert gate.admit(docs, gate.gate(reg)).count() == 1 and gate.admit(docs, gate.gate(reg), ["zz"]).count() == 0


def _docs(spark, texts):
    return spark.createDataFrame([(i, f"s{i % 2}", t) for i, t in enumerate(texts)], "doc_id long, shard_id string, text string")


@pytest.mark.parametrize("parts", [1, 7])
def test_exact_duplicates(spark, parts):
    d = _docs(spark, ["x", "y", "x", "x", None, None, ""]).withColumn("n", F.lit("clash")).repartition(parts)
    one = dedup.intra_cross(d, "shard_id", "text").first()
    assert (one["docs"], one["unique_docs"], one["global_dups"], one["cross_dups"], one["intra_dups"]) == (5, 3, 2, 1, 1)
    firsts = {r["doc_id"] for r in dedup.keep_first(d, "text", ["doc_id"]).where("is_first").collect()}
    assert firsts == {0, 1, 4, 5, 6} == {r["doc_id"] for r in dedup.keep_first_window(d, "text", ["doc_id"]).where("is_first").collect()}
    s = {r["shard_id"]: (r["docs"], r["unique_docs"]) for r in dedup.stats(d, "shard_id", "text").collect()}
    assert s == {"s0": (4, 2), "s1": (3, 2)}
    assert dedup.stats(d.limit(0), "shard_id", "text").count() == 0


def test_samples(spark):
    d = spark.createDataFrame([(g, i, random.Random(i).randint(1, 50)) for g in "ab" for i in range(500)] + [("c", 0, 10_000), (None, 1, 1)], "g string, i long, size long")
    got = sampling.byte_budget(d.repartition(5), "g", "i", "size", 400)
    for g in "ab":
        want, total = [], 0
        for i in range(500):
            if total >= 400:
                break
            want.append(i)
            total += random.Random(i).randint(1, 50)
        assert sorted(r["i"] for r in got.where(F.col("g") == g).collect()) == want
    assert got.where("g = 'c'").count() == 1
    s = sampling.stride(d, 50, "i")
    assert sorted(r["ordinal"] for r in s.where("g = 'a'").collect()) == list(range(1, 11)) and sampling.nested(s, 5).where("g = 'a'").count() == 2
    with pytest.raises(ValueError):
        sampling.stride(d, 0)


def test_minhash_constants():
    a, b = neardup._constants()
    assert (int(a[0]), int(a[31]), int(b[0]), int(b[31])) == (1407639518939636933, 2135503771371547565, 2257599037232710396, 1085640342191777584)
    assert neardup.signature_of("one two three four") is None and neardup.signature_of(None) is None and len(neardup.signature_of(BASE)) == 32


@pytest.mark.parametrize("parts", [1, 6])
def test_near_duplicates(spark, parts):
    rng = random.Random(1)
    other = " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(rng.randint(0, 99)) for _ in range(60))
    d = _docs(spark, [BASE, BASE + " again", other, BASE, "tiny", None, "", BASE + " again"]).withColumn("sig", F.lit("clash")).repartition(parts)
    c = {r["doc_id"]: r["cluster"] for r in neardup.clusters(d, "doc_id", "text").collect()}
    assert c == {0: 0, 1: 0, 2: 2, 3: 0, 4: 4, 5: 5, 6: 6, 7: 0}
    stats = neardup.cluster_stats(neardup.clusters(d, "doc_id", "text")).first()
    assert tuple(stats) == (8, 1, 4, 4)
    named = neardup.clusters(d, "doc_id", "text").join(d.select("doc_id", F.col("text").alias("h")), "doc_id")
    assert [r["h"] for r in neardup.drop_list(named, "h").collect()] == [BASE + " again"]
    assert neardup.clusters(d.limit(0), "doc_id", "text").count() == 0


@pytest.mark.parametrize("held", [4096, 4])
def test_links_in_a_bucket_whose_least_key_is_unlike_the_rest(spark, held):
    rng = random.Random(5)
    base = [rng.randint(0, 1 << 40) for _ in range(32)]
    free = iter(range(1 << 41, 1 << 42))
    change = lambda sig, rows: [next(free) if i in rows else x for i, x in enumerate(sig)]
    # all share the first band only with key 0; 1 and 2 agree in 22 rows, 2 and 3 in 21, 1 and 3 in fewer; every other band of a pair differs in a row
    one = change(base, range(4, 32, 4))
    two = change(one, (5, 9, 13, 17, 21, 25, 29, 6, 10, 14))
    three = change(two, (5, 9, 13, 17, 21, 25, 29, 7, 11, 15, 19))
    rest = [change(base, range(4, 32)) for _ in range(6)]
    sigs = [change(base, range(4, 32)), one, two, three, *rest]
    got = neardup.links(spark.createDataFrame(list(enumerate(sigs)), "k long, sig array<long>"), "k", most_held=held).collect()
    assert {(max(r), min(r)) for r in got} == {(2, 1), (3, 2)}


def test_divided_buckets_lose_no_pair():
    for mask in (15, 15 << 28, neardup._finer(15, 21)[3]):
        for _ in range(300):
            differ = set(random.Random(_).sample([i for i in range(32) if not mask >> i & 1], 11))
            assert any(not any(m >> i & 1 for i in differ) for m in neardup._finer(mask, 21))
    assert neardup._finer((1 << 21) - 1, 21) == []


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {(r["node"], r["component"]) for r in neardup.components(spark.createDataFrame(edges, "left long, right long")).collect()}
    assert got == {(x, find(x)) for x in list(parent)}


def test_screening(spark):
    item = "In the year of the great flood the ferry keeper of Zorbal carried nine hundred sheep across the water without losing one"
    w = item.split()
    docs = _docs(spark, ["before " + item.upper() + " after", "x " + " ".join(w[3:11]) + " y", " ".join(w[3:10]), None, ""])
    items = spark.createDataFrame([("i1", item), ("i2", "too short to match"), ("i1", item), (None, item)], "id string, text string")
    got = {(r["doc_id"], r["eval_id"], r["kind"]) for r in contamination.screen(docs, "doc_id", "text", items, "id", "text").collect()}
    assert got == {(0, "i1", "exact"), (1, "i1", "near")}
    built = contamination.build_eval_set(spark.createDataFrame([("a/b.jsonl", item), ("c", "  " + item + "\n"), (None, "short")], "source string, text string"), "source", "text").collect()
    assert len(built) == 1 and built[0]["id"].startswith("b.jsonl:")


def test_language_model(spark):
    train = spark.createDataFrame([("eng", s) for s in (BASE, BASE.upper().lower(), "people walk by the river and talk about the weather")] * 10 + [(None, "x"), ("eng", None)], "lang string, text string")
    tri, uni = lm.train(train, "lang", "text")
    docs = spark.createDataFrame([(1, "eng", "the farmer counts every sheep near the river"), (2, "eng", "zxq kjw vbn qqq zzz xkcd wvu"), (3, "eng", "hi"), (4, "xx", "unknown language here"), (5, "eng", "नदी के पास एक मंदिर है")], "id long, lang string, text string")
    bits = {r["id"]: r["bits"] for r in lm.bits_per_char(docs, "id", "lang", "text", tri, uni).collect()}
    assert bits[2] - bits[1] > 1 and bits[3] is None and bits[4] is None and np.isfinite(bits[5])
    # row-wise check of one text
    counts = {(r["ctx"], r["nxt"]): r["n"] for r in tri.collect()}
    total = {}
    for (c, _), n in counts.items():
        total[c] = total.get(c, 0) + n
    one = {r["ch"]: r["n"] for r in uni.collect()}
    v, k = max(len(one), 2), lm.ADD_K
    p = " the farmer counts every sheep near the river "
    ps = [(counts.get((p[i : i + 2], p[i + 2]), 0) + k) / (total[p[i : i + 2]] + k * v) if p[i : i + 2] in total else (one.get(p[i + 2], 0) + k) / (sum(one.values()) + k * v) for i in range(len(p) - 2)]
    assert abs(bits[1] - float(np.mean([-np.log2(x) for x in ps]))) < 1e-9
    scored = spark.createDataFrame([("a", float(i)) for i in range(300)] + [("b", 1.0), ("b", None)], "lang string, bits double")
    cut = {r["lang"]: r["cutoff"] for r in lm.cutoffs(scored, "lang").collect()}
    assert abs(cut["a"] - np.percentile(range(300), 99)) < 1e-9 and cut["b"] is None


def test_percentiles_equal_sorting(spark):
    rng = random.Random(2)
    groups = {"one": [3.5], "two": [1.0, 2.0], "ties": [1.0] * 900 + [2.0] * 100, "many": [rng.gauss(0, 1) for _ in range(40_000)], "few": [rng.random() for _ in range(37)], None: [5.0, 7.0, 9.0], "far": [1e300, -1e300, 0.0, 5e-324]}
    rows = [(g, v, 1) for g, vs in groups.items() for v in vs] + [("one", None, 1), ("empty", None, 1)]
    df = spark.createDataFrame(rows, "g string, x double, n int").repartition(6)
    shares = {"a": 0.0, "b": 0.5, "c": 0.9, "d": 0.99, "e": 1.0, "f": 0.12345}
    got = {r["g"]: r for r in percentiles(df, "g", "x", shares).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        for name, p in shares.items():
            want = float(np.percentile(vs, 100 * p))
            assert abs(got[g][name] - want) <= 1e-9 * max(1.0, abs(want)), (g, name)
    assert percentiles(df.limit(0), "g", "x", shares).count() == 0


def _verdicts(spark, parts=3, **more):
    long = [f"{BASE} with a different ending number {i} that makes this document its own and long enough to pass every length rule" for i in range(20)]
    texts = [*long, long[0], "bad line here\n" * 60, "idiot moron " + long[3], None, "", long[5] + " write to a@b.org"]
    d = _docs(spark, texts).withColumn("lang", F.lit("eng")).withColumn("drop_reason_old", F.lit(1)).repartition(parts)
    return verdict.verdicts(d, "doc_id", "text", "lang", ["doc_id"], **more)


@pytest.mark.parametrize("parts", [1, 9])
def test_verdict_chain(spark, parts):
    cfg = verdict.FilterConfig(pii_policy="drop")
    near = spark.createDataFrame([(1,), (1,)], "doc_id long")
    got = {r["doc_id"]: r["drop_reason"] for r in _verdicts(spark, parts, config=cfg, near_drop=near, lexicon=Lexicon(("idiot", "moron")), plugins=[TextPlugin("seven", "1", lambda t: "has 7" if "number 7 " in t else None)]).collect()}
    want = {1: "near_dup", 7: "plugin:seven", 20: "exact_dup", 21: "quality", 22: "toxicity", 23: "quality", 24: "quality", 25: "pii"}
    assert {k: v for k, v in got.items() if v} == want
    counts = {r["reason"]: r["docs"] for r in verdict.reason_counts(_verdicts(spark, parts, config=cfg)).collect()}
    assert counts["contamination"] == 0 and sum(counts.values()) == 26
    log = verdict.drops_log(_verdicts(spark, parts, config=cfg), ["shard_id"]).collect()
    assert all(len(r["preview"] or "") <= 280 for r in log) and len(log) == 26 - counts["kept"]


def test_config_identity():
    a, b = verdict.FilterConfig(), verdict.FilterConfig(min_quality="high")
    assert a.sha256() == verdict.FilterConfig().sha256() != b.sha256()
    assert verdict.with_plugins(a, [min_words(3)]).sha256() != verdict.with_plugins(a, [min_words(4)]).sha256()
    assert identities([min_words(3)]) == [{"name": "min_words", "version": "1", "min_words": 3}]
    with pytest.raises(ValueError):
        load(["no such plugin"])


def test_roll_ups_and_unions(spark):
    d = _docs(spark, ["a", "b", "a", None])
    total = manifest.attest(d, "shard_id", "text").where("level = 1").first()
    assert (total["docs"], total["bytes"], total["unique_docs"]) == (3, 3, 2)
    u = manifest.union_builds([d, d.limit(1)], "text").first()
    assert u["rows"] - u["distinct_docs"] == u["cross_partition_rekept_docs"]
    m = {"corpus_id": "c", "parent_hash": "h", "config": {"x": 1, "cutoffs": {"eng": 3.0}}, "shards": ["a"], "reasons": {"plugin:z": 2}}
    assert manifest.unite([m, m | {"shards": ["b"]}])["reasons"] == {"plugin:z": 4}
    for bad in ({"shards": ["a"]}, {"parent_hash": "i", "shards": ["b"]}, {"registry_sha256": "r", "shards": ["b"]}, {"config": {"x": 2}, "shards": ["b"]}, {"config": {}, "shards": ["b"]}, {"config": {"x": 1, "cutoffs": {"eng": 4.0}}, "shards": ["b"]}):
        with pytest.raises(ValueError):
            manifest.unite([m, m | bad])
    run = {"registry_sha256": "r", "shards": [{"shard_id": "a", "docs": 2, "doc_bytes": 9, "estimated_tokens": 4}]}
    other = {"registry_sha256": "r", "shards": [{"shard_id": "b", "docs": 1, "doc_bytes": 1, "estimated_tokens": None}]}
    both = manifest.merge_runs([run, other], ["a", "b"])
    assert (both["docs"], both["doc_bytes"], both["partial"], both["estimated_total_tokens"]) == (3, 10, False, None)
    assert manifest.merge_runs([run], ["a", "b"], partial=True)["missing_shards"] == ["b"]
    for runs, accepted in (([run], ["a", "b"]), ([run, run], ["a"]), ([run, other], ["a"]), ([run, other | {"registry_sha256": "q"}], ["a", "b"]), ([], [])):
        with pytest.raises(ValueError):
            manifest.merge_runs(runs, accepted)
    assert manifest.build_warnings(0, 5)[0].startswith("EMPTY") and manifest.build_warnings(1, 5)[0].startswith("HIGH") and manifest.build_warnings(4, 5) == []


def test_token_ratio_measures_every_document(spark, tmp_path):
    docs = spark.createDataFrame([(i, lang, "a few words") for i, lang in ((0, "eng"), (1, "eng"), (2, "Rare"))], "doc_index long, lang string, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert sum(r["measured_docs"] for r in catalogue.queries()["token_ratio"](spark, str(tmp_path)).collect()) == 3


def test_token_counts_by_chunks_are_those_of_whole_texts(tmp_path):
    from tokenizers import Tokenizer, normalizers

    rnd = random.Random(3)
    parts = [*" \n\t\x0b\x1c\x1f\x85\xa0᠎  ​　", *"abZ09'\".,-_<|éΣς", *"́̈क्षि中가ẛ̣‍", "'s", " the", "  ", "<|endoftext|>"]
    texts = ["", *("".join(rnd.choices(parts, k=rnd.randint(1, 25))) for _ in range(4000))]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = f"{tokenizer_lab.TOKENIZERS}/{name}"
        whole, counter = Tokenizer.from_file(path), tokenizer_lab.TextCounter(path)
        whole.encode_special_tokens = True
        assert counter.additive and counter.count(None) is None
        assert [counter.count(t) for t in texts] == [len(t) for t in whole.encode_batch(texts, add_special_tokens=False)]
    whole.normalizer = normalizers.Replace(" ", "_")  # joins words
    whole.save(str(tmp_path / "joined.json"))
    joined = tokenizer_lab.TextCounter(str(tmp_path / "joined.json"))
    assert not joined.additive and joined.count("to be or not") == len(whole.encode("to be or not", add_special_tokens=False))


def test_token_ratio_keeps_no_encodings_of_a_batch(spark):
    def workers():
        alive = (p for p in psutil.Process(spark.sparkContext._gateway.proc.pid).children(recursive=True) if p.status() != psutil.STATUS_ZOMBIE)
        return [p for p in alive if "pyspark" in " ".join(p.cmdline())]

    words = "every number on the old bridge 17 was counted twice , and nobody knows why ; "
    docs = spark.range(2001, numPartitions=1).select(F.lit("eng").alias("lang"), F.when(F.col("id") == 2000, F.repeat(F.lit(words), 100_000)).otherwise(F.repeat(F.lit(words), 80)).alias("text"))
    tokenizer_lab.token_ratios(docs.limit(1), "lang", "text").collect()
    before = {}
    for p in workers():
        Path(f"/proc/{p.pid}/clear_refs").write_text("5")  # the peak begins anew
        before[p.pid] = p.memory_info().rss / 1e6
    (row,) = tokenizer_lab.token_ratios(docs, "lang", "text").collect()
    peaks = {p.pid: int(Path(f"/proc/{p.pid}/status").read_text().split("VmHWM:")[1].split()[0]) / 1e3 for p in workers()}
    assert row["measured_docs"] == 2001 and row["measured_bytes"] == (2000 * 80 + 100_000) * len(words)
    assert max(peak - before.get(pid, 0) for pid, peak in peaks.items()) < 400
