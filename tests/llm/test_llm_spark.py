"""Operators of the subpackage on small tables: nulls, empty tables, ties, repeats, clashing columns, brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import components, cutoffs, encodings, leaks, packing, pii
from tessera.functions.words import runs


def _groups(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {(find(x), x) for x in list(parent)}


@pytest.mark.parametrize("last", [2_000_000, 40])
def test_components_equal_brute_force(spark, last):
    rng = random.Random(5)
    edges = [(rng.randint(-300, 300), rng.randint(-300, 300)) for _ in range(260)]
    edges += [(0, i) for i in range(1000, 1300)] + [(i, i + 1) for i in range(5000, 5080)] + [(7, 7), (9001, 9001), (None, 4), (3, None), (1, 2), (2, 1), (1, 2)]
    df = spark.createDataFrame([(a, b, "x") for a, b in edges], "a long, b long, component string").repartition(7)
    got = {tuple(r) for r in components.connected_components(df, "a", "b", last_merge_edges=last).collect()}
    assert got == _groups(edges)


def test_hubs_with_many_inner_neighbours(spark):
    # every neighbour of the hub is a parent itself, so none is retired at once
    edges = [(0, i) for i in range(1, 150)] + [(i, 1000 + i) for i in range(1, 150)] + [(1000 + i, 3000 + 7 * i) for i in range(1, 150)] + [(90_000, 90_001)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(6)
    assert {tuple(r) for r in components.connected_components(df, "a", "b", last_merge_edges=60).collect()} == _groups(edges)


def test_components_of_nothing(spark):
    assert components.connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_cutoffs_equal_sorting(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for name, values, share in (
        ("ties", [1.0] * 50 + [2.0] * 50, 0.5), ("wide", [10.0 ** rng.randint(-300, 300) * rng.choice((-1, 1)) for _ in range(300)], 0.875),
        ("one", [3.5], 0.1), ("all", [rng.random() for _ in range(101)], 1.0), ("none", [rng.random() for _ in range(9)], 0.0), ("many", [round(rng.gauss(4, 1), 4) for _ in range(2000)], 0.96875),
    ):
        rows += [(name, v) for v in values]
        s = sorted(values)
        want[name] = next(c for c in s if sum(x <= c for x in s) >= share * len(s)) if share > 0 else s[0]
    df = spark.createDataFrame(rows, "shard_id string, score double")
    shares = {"ties": 0.5, "wide": 0.875, "one": 0.1, "all": 1.0, "none": 0.0, "many": 0.96875, "absent": 0.5}
    got = cutoffs.cutoffs(df, "shard_id", shares)
    assert {k: v["cutoff"] for k, v in got.items()} == want
    for k, v in got.items():
        assert v["kept"] == sum(x <= v["cutoff"] for n, x in rows if n == k)


def test_cutoffs_of_many_sources_in_blocks(spark, monkeypatch):
    df = spark.createDataFrame([(f"s{i % 7}", float(i)) for i in range(70)], "shard_id string, score double")
    shares = {f"s{i}": (i + 1) / 10 for i in range(7)}
    whole = cutoffs.cutoffs(df, "shard_id", shares)
    monkeypatch.setattr(cutoffs, "MOST_SOURCES", 3)
    assert cutoffs.cutoffs(df, "shard_id", shares) == whole and len(whole) == 7


def test_latest_score_counts(spark):
    rows = [("s", 1, 9.0, 1), ("s", 1, 2.0, 5), ("s", 1, 2.0, 5), ("s", 2, 3.0, 1), ("s", 2, None, 2), ("s", 3, 1.0, 1), ("s", 4, float("nan"), 1)]
    df = spark.createDataFrame(rows, "shard_id string, doc_index long, bits double, at int").withColumn("late", F.lit(0))
    got = {(r[1], r[2]) for r in cutoffs.latest_scores(df, ["shard_id", "doc_index"], "bits", "at", ["late"]).collect()}
    assert got == {(1, 2.0), (3, 1.0)}


@pytest.mark.parametrize(("capacity", "units", "broadcast"), [(10, 65_536, 400_000), (64, 65_536, 0), (512, 65_536, 400_000), (1000, 96, 0)])
def test_packing_places_every_piece_once(spark, monkeypatch, capacity, units, broadcast):
    monkeypatch.setattr(packing, "UNITS", units)  # below the capacity lengths are planned in units
    monkeypatch.setattr(packing, "BROADCAST_ROWS", broadcast)
    rng = random.Random(capacity)
    docs = [(i, rng.choice([1, 3, capacity, capacity - 1, capacity + 1, rng.randint(1, 3 * capacity), rng.randint(1, capacity // 8), 7, 7, 0, None])) for i in range(900)] + [(None, 5), (7, 7)]
    df = spark.createDataFrame(docs, "doc_id long, n long").withColumn("container", F.lit("x")).repartition(5)
    rows = packing.pack(df, "doc_id", "n", spark.createDataFrame([(1, capacity), (2, None)], "pack_id int, capacity_tokens int")).collect()
    total, windows, steps, of = Counter(), Counter(), defaultdict(set), {}
    for r in rows:
        total[r["container"]] += r["n_tokens"]
        windows[r["container"], r["window"]] += r["n_tokens"]
        assert of.setdefault(r["container"], r["context"]) == r["context"] and r["window"] * r["context"] < capacity
        steps[r["step"]].add(r["container"])
    assert max(total.values()) <= capacity and all(n <= of[c] for (c, _), n in windows.items())
    assert sum(total.values()) == sum(n for i, n in docs if n and i is not None)
    assert sorted(c for s in steps.values() for c in s) == sorted(total)
    per = defaultdict(list)
    for r in rows:
        per[r["doc_id"]].append(r["n_tokens"])
    for i, n in docs[8:50]:
        if n:
            assert len(per[i]) == -(-n // capacity)
    assert len(total) <= 1.05 * sum(total.values()) / capacity + 3


def test_packing_fills_long_windows_from_shorter_tiers_and_balances_steps():
    rng = random.Random(1)
    h = Counter(min(4096, int(rng.lognormvariate(6.5, 1.2)) + 1) for _ in range(60_000))
    containers, groups = packing.plan(h, 4096)
    assert len({tier for tier, *_ in groups}) == packing.CONTEXTS
    assert any(size <= 4096 >> 3 for tier, _, _, p in groups if tier == 0 for size in p)
    assert sum(s * n for s, n in h.items()) > 0.998 * 4096 * containers
    assert Counter({s: sum(c * p.get(s, 0) for _, _, c, p in groups) for s in h}) == h
    steps: Counter = Counter()
    used: Counter = Counter()
    for pack_id, unit, lo, hi, first, each, tier, context, base, n in packing.plan_rows(1, h, 4096, 4096):
        for r in range(lo, hi):
            used[base + ((first + (r - lo) // each) >> tier)] += unit
    for c, t in used.items():
        turn, seat = divmod(c, n)
        steps[seat if turn % 2 == 0 else n - 1 - seat] += t
    assert max(steps.values()) - min(steps.values()) <= 2 * 4096  # a container more or less, and a tier's last one, which is not full
    # where no short documents fill short windows, whole containers are used
    assert packing.plan({1300: 900}, 4096)[0] == 300


def test_packing_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, n long")
    assert packing.pack(empty, "doc_id", "n", spark.createDataFrame([(1, 8)], "pack_id int, capacity_tokens int")).count() == 0


@pytest.mark.parametrize("most", [50_000, 4])
def test_leaks_equal_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(leaks, "MOST_ITEMS", most)  # the small bound takes the items in four blocks
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(400)]
    items = [(f"i{k}", " ".join(rng.choice(vocab) for _ in range(30)) + ".") for k in range(12)] + [("short", "w1 w2 w3"), ("copy", None), (None, "w1 w2")]
    items.append(("same", items[0][1]))
    common = [f"c{i}" for i in range(50)]
    docs = []
    for d in range(150):
        words = [rng.choice(common) for _ in range(40)]
        if d % 3 == 0:
            src, n, at = rng.choice(items[:12])[1].rstrip(".").split(), rng.choice([7, 8, 12]), rng.randint(0, 18)
            words[10:10] = [w.upper() + rng.choice(["", ",", "​"]) for w in src[at : at + n]]
        docs.append((d, rng.choice([" ", "\n", "  "]).join(words)))
    docs += [(900, None), (901, ""), (902, items[3][1] * 2000)]
    got = leaks.leaks(spark.createDataFrame(docs, "doc_id long, text string").withColumn("eval_id", F.lit(1)), "doc_id", "text", spark.createDataFrame(items, "id string, text string"), "id", "text")
    found = {(r["doc_id"], r["eval_id"]) for r in got.where("kind = 'run'").collect()}
    grams = defaultdict(set)
    for k, t in items:
        if k and t:
            w = runs(t)
            for i in range(len(w) - 7):
                grams[tuple(w[i : i + 8])].add(k)
    want = set()
    for d, t in docs:
        w = runs(t or "")
        for i in range(len(w) - 7):
            want |= {(d, k) for k in grams.get(tuple(w[i : i + 8]), ())}
    assert found == want and want


def test_leaks_paraphrase_and_empty(spark):
    items = spark.createDataFrame([("q", "Explain how Zorbax engineers lifted the newspaper of Velqua by 4841 metres without using the Dravit crane.")], "id string, text string")
    docs = spark.createDataFrame([(1, "Explain how the Zorbax engineers quickly lifted a newspaper of Velqua by 4841 metres, not using any Dravit crane."), (2, "nothing to see here at all")], "doc_id long, text string")
    got = leaks.leaks(docs, "doc_id", "text", items, "id", "text").collect()
    assert [(r["doc_id"], r["kind"]) for r in got] == [(1, "paraphrase")]
    assert leaks.leaks(docs.limit(0), "doc_id", "text", items, "id", "text").count() == 0
    assert leaks.leaks(docs, "doc_id", "text", items.limit(0), "id", "text").count() == 0


def test_paraphrases_recall_against_brute_force(spark):
    rng = random.Random(12)
    vocab = [f"w{i}" for i in range(260)]
    sentences = [rng.sample(vocab, rng.randint(8, 24)) for _ in range(40)]
    items = [(f"i{k}", " ".join(s) + ".") for k, s in enumerate(sentences)]
    docs = []
    for d in range(160):
        said = [x for w in rng.choice(sentences) if rng.random() < rng.choice((0.6, 0.8, 0.95)) for x in ([w, "new"] if rng.random() < 0.3 else [w])]
        docs.append((d, " ".join([*(rng.choice(vocab) for _ in range(rng.randint(0, 90))), *said, *(rng.choice(vocab) for _ in range(rng.randint(0, 90)))])))
    index = leaks.EvalIndex(items)
    counts = Counter(w for _, t in docs for w in set(t.split()))
    want = set()
    for d, text in docs:
        words = text.split()
        for j, s in enumerate(index.sentences):
            names = {i: w for w, i in index.vocab.items()}
            order = sorted(set(s), key=lambda w: (counts[names[w]], w))
            answers = set(order[: max(2, len(order) // 4)])
            ids = [index.vocab.get(w, -1) for w in words]
            for at in range(0, max(1, len(ids) - index.window[j] + 1)):
                part = [x for x in ids[at : at + index.window[j]] if x in set(s)]
                if len(part) >= leaks.KEPT_ORDER * len(s) and leaks.lcs(part, s) >= leaks.KEPT_ORDER * len(s) and len(answers & set(part)) >= leaks.KEPT_ANSWER * len(answers):
                    want |= {(d, e) for e in index.sentence_keys[j]}
                    break
    got = leaks.leaks(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", spark.createDataFrame(items, "id string, text string"), "id", "text")
    found = {(r["doc_id"], r["eval_id"]) for r in got.where("kind = 'paraphrase'").collect()}
    assert len(want) > 60 and len(found & want) >= 0.9 * len(want)


def test_quantiser_finds_every_equal_vector():
    rng = np.random.default_rng(3)
    x = leaks._unit(rng.standard_normal((3000, 24))).astype(np.float32)
    x[1000:1100] = x[:100]  # ties
    q = leaks.Quantiser(x)
    assert sorted(np.concatenate(q.members).tolist()) == list(range(3000))
    got = {(int(a), int(b)) for i, j, _ in q.near(x[::7].copy(), 0.9999) for a, b in zip(i, j, strict=True)}
    assert {(k, i) for k, i in enumerate(range(0, 3000, 7))} <= got and (0, 1000) in got
    assert list(leaks.Quantiser(x[:0]).near(x[:0], 0.5)) == []


def test_leaks_paraphrases_inside_long_documents(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(300)]
    sentences = [rng.sample(vocab, n) for n in (8, 12, 20) for _ in range(6)]
    items = spark.createDataFrame([(f"i{k}", " ".join(s) + ".") for k, s in enumerate(sentences)], "id string, text string")
    # a foreign word after every fourth, in documents of evaluation words throughout
    around = lambda: [rng.choice(vocab) for _ in range(200)]
    docs = [(k, " ".join([*around(), *(x for i, w in enumerate(s) for x in ([w, "new"] if i % 4 == 3 else [w])), *around()])) for k, s in enumerate(sentences)]
    got = leaks.leaks(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text", items, "id", "text").where("kind = 'paraphrase'")
    assert {(r["doc_id"], r["eval_id"]) for r in got.collect()} >= {(k, f"i{k}") for k in range(len(sentences))}


def test_restoring_and_redacting_tables(spark):
    bad = encodings._decode("हमारे गाँव में".encode(), "cp1252")
    df = spark.createDataFrame([(1, bad), (2, "fine"), (3, None), (4, ""), (1, bad)], "doc_id long, text string").withColumn("spans", F.lit(3))
    got = encodings.restore_garbled(df, "doc_id", "text").collect()
    assert [(r["doc_id"], r["restored"]) for r in got] == [(1, "हमारे गाँव में")] * 2
    d = pii.detect(df.withColumn("redacted", F.lit(0)), "text", ["doc_id"]).collect()
    assert len(d) == 5 and all(r["spans"] == [] for r in d)
