"""Table operators of the subpackage that need labelled or several tables."""

import random

from pyspark.sql import functions as F

from tessera.llm import abuse, language, pii, tokens


def _previews():
    rng = random.Random(8)
    good = [f"the {a} near the {b} was {c} again" for a in ("well", "school", "market", "farm") for b in ("river", "road", "mill") for c in ("painted", "closed", "mapped")]
    bad = [f"you are nothing but a {a} {b}" for a in ("filthy", "rotten", "useless") for b in ("idiot", "moron", "liar", "loser")]
    rows, labels = [], []
    for i in range(240):
        y = i % 3 == 0
        rows.append((i, "s", f"{rng.choice(good)}. {rng.choice(bad) if y else rng.choice(good)}. {rng.choice(good)}."))
        if i < 180:
            labels.append((i, int(y)))
    return rows, labels, {i for i in range(180, 240) if i % 3 == 0}


def test_abuse_scores_of_tables(spark):
    rows, labels, want = _previews()
    labels += [(5, 1), (7, None), (9999, 1), (None, 1)]  # a tie, a null label, a missing text, a null key
    df = spark.createDataFrame(rows + [(900, "s", None), (901, "s", ""), (902, None, "x " * 50_000), rows[0]], "drop_id long, shard string, preview string").withColumn("score", F.lit("clash")).repartition(5)
    sample = abuse.labelled_sample(df, "drop_id", "preview", spark.createDataFrame(labels, "drop_id long, toxic int"), "toxic")
    assert len(sample) == 179
    got = abuse.scores(df, "preview", ["drop_id", "shard"], sample).collect()
    assert len(got) == len(rows) + 4
    found = {r["drop_id"] for r in got if r["score"] >= abuse.CASE and 180 <= r["drop_id"] < 900}
    assert found == want
    assert all(r["score"] == 0 for r in got if r["drop_id"] in (900, 901))
    assert all("nothing but" in r["evidence"] for r in got if r["drop_id"] in want)
    same = abuse.scores(df.repartition(2), "preview", ["drop_id"], sample).collect()
    assert {(r["drop_id"], round(r["score"], 9)) for r in got} == {(r["drop_id"], round(r["score"], 9)) for r in same}


def test_abuse_without_labels_or_rows(spark):
    rows, _, _ = _previews()
    df = spark.createDataFrame(rows[:5], "drop_id long, shard string, preview string")
    none = spark.createDataFrame([], "drop_id long, toxic int")
    assert abuse.labelled_sample(df, "drop_id", "preview", none, "toxic") == []
    assert [r["score"] for r in abuse.scores(df, "preview", ["drop_id"], []).collect()] == [0.0] * 5
    assert abuse.scores(df.limit(0), "preview", ["drop_id"], [(rows[0][2], 1), (rows[1][2], 0)]).count() == 0


def test_labels_name_languages(spark):
    names = {"eng": "eng", "en": "eng", "english": "eng", "hin": "hin", "hi": "hin", "hindi": "hin"}
    values = ["eng", " EN-IN", "English", "hin_Deva", "xx", "", None, "und", "HINDI"]
    df = spark.createDataFrame([(v,) for v in values], "lang string")
    assert [r[0] for r in df.select(language.label_code(F.col("lang"), names)).collect()] == ["eng", "eng", "eng", "hin", None, None, None, None, "hin"]


def test_training_sample_is_bounded_and_stable(spark, monkeypatch):
    monkeypatch.setattr(language, "TEXTS_PER_LABEL", 20)
    df = spark.createDataFrame([(i, "a" if i % 10 else "b", f"t{i}") for i in range(2000)] + [(1, None, "x"), (2, "a", None)], "k long, code string, text string")
    one = language.training_sample(df, F.col("code"), "text", "k")
    assert one == language.training_sample(df.repartition(6), F.col("code"), "text", "k")
    assert sum(c == "a" for c, _ in one) == 20 and 10 <= sum(c == "b" for c, _ in one) <= 20
    assert language.training_sample(df.limit(0), F.col("code"), "text", "k") == []


def test_token_budget(spark):
    docs = spark.createDataFrame([(1, "s", "one two three", "bfsi"), (2, "s", None, None), (3, "t", "def f(x):\n    return x;\nimport os", " "), (4, None, "", None)], "doc_id long, source string, text string, domain string").withColumn("n_tokens", F.lit("clash"))
    c = tokens.TokenCounter(tokens.vocabulary(f"{tokens.TOKENIZERS}/{tokens.VOCABULARY}"))
    got = {r["doc_id"]: r for r in tokens.token_counts(docs, "text", ["doc_id", "source", "domain"]).collect()}
    assert got[1]["n_tokens"] == c.count("one two three") and got[1]["n_bytes"] == 13 and got[2]["n_tokens"] == got[4]["n_bytes"] == 0
    cube = tokens.budget(tokens.token_counts(docs, "text", ["doc_id", "source", "domain"]), ["source", "domain"])
    total = cube.where("level = 3").collect()
    assert len(total) == 1 and total[0]["docs"] == 4 and total[0]["tokens"] == sum(r["n_tokens"] for r in got.values())
    assert cube.where("level = 1 and source is null").first()["docs"] == 1  # a null source is no total
    assert tokens.budget(tokens.token_counts(docs.limit(0), "text", ["source", "domain"]), ["source", "domain"]).where("level < 3").count() == 0


def test_identify_tables(spark):
    hin, eng = "हमारे गाँव में नदी के पास एक मंदिर बनाया गया है।", "The old market near the river was painted again last winter."
    model = language.train([("hin", f"{hin} {hin}"), ("eng", f"{eng} {eng}")] * 40)
    df = spark.createDataFrame([(1, "hin", f"{hin} {eng}"), (2, None, ""), (3, "eng", None), (4, "eng", eng * 3000)], "rec long, label string, text string").withColumn("segments", F.lit(1))
    got = {r["rec"]: [s["lang"] for s in r["segments"]] for r in language.identify(df, "text", "label", model, ["rec"]).collect()}
    assert got == {1: ["hin", "eng"], 2: [], 3: [], 4: ["eng"]}


def test_names_are_learned_from_the_table(spark):
    rng = random.Random(4)
    first, last = ["Anvelo", "Brimka", "Corvane", "Dulsha", "Ermindo", "Fostiq"], ["Galbrecht", "Hovanu", "Istrelli", "Jumbrae", "Kelstor", "Lomvik"]
    hindi = [("अनवेलो", "गालब्रेख"), ("ब्रिमका", "होवानू"), ("कोरवेन", "इस्त्रेली")]
    titled = ["Mr. {} came late to the fair.", "My name is {} and the bill is wrong.", "The room of Dr {} was painted."]
    rows = [(i, rng.choice(titled).format(f"{a} {b}")) for i, (a, b) in enumerate((a, b) for a in first for b in last)]
    rows += [(100 + i, f"श्री {a} {b} ने शिकायत की।") for i, (a, b) in enumerate(hindi)]
    # sentences without a form of address or any word about persons
    bare = ["The bill went to {} by mistake.", "Nothing was left for {} in the end.", "A parcel from {}; the rest is lost.", "{} paid twice, as the ledger shows."]
    want = [(200 + i, rng.choice(bare).format(f"{rng.choice(first)} {rng.choice(['', 'K. '])}{rng.choice(last)}")) for i in range(60)]
    want += [(300 + i, f"दुकान से {a} {b} को पैसा मिला।") for i, (a, b) in enumerate(hindi)]
    none = [(400, "The Lotus Road bridge near Station Cross was closed."), (401, "The market in Galbrecht stayed open."), (402, "The Corvane Hovanu road is wet."), (403, None), (404, ""), (405, "WRITE TO ANVELO_HOVANU@EXAMPLE.ORG NOW"), (406, "a " * 100_000)]
    df = spark.createDataFrame(rows + want + none + rows[:3], "rec long, text string").withColumn("spans", F.lit("clash")).repartition(5)
    got = pii.detect(df, "text", ["rec"]).collect()
    assert len(got) == len(rows) + len(want) + len(none) + 3
    named = {r["rec"] for r in got if r["spans"] and any(s["kind"] == "name" for s in r["spans"])}
    assert {i for i, _ in want} <= named and not named & {i for i, _ in none}
    assert pii.name_words(df.limit(0), "text") == [] and len(pii.name_words(df, "text")) == 18


def test_more_names_than_a_worker_holds(spark, monkeypatch):
    names = [("Anvelo", "Galbrecht"), ("Brimka", "Hovanu"), ("Corvane", "Istrelli"), ("अनवेलो", "गालब्रेख")]
    titled = [f"{'श्री' if not a.isascii() else 'Mr.'} {a} {b} came late." for a, b in names]
    bare = [f"The bill went to {a} {b} by mistake." for a, b in names] + ["Nothing was left for Brimka K. ISTRELLI in the end."]
    none = ["The market in Galbrecht stayed open.", "The Corvane Hovanu road is wet.", "anvelo galbrecht", "", None]
    # one form of address and its name many times, so that the others are rare
    texts = [*titled, *["Dr. Dulsha Jumbrae came late."] * 30, *bare, *none, bare[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "rec long, text string").repartition(3)
    held = sorted(pii.detect(df, "text", ["rec"]).collect())
    monkeypatch.setattr(pii, "MOST_NAME_WORDS", 3)
    assert sorted(pii.detect(df, "text", ["rec"]).collect()) == held
    named = {texts[r["rec"]] for r in held if any(s["kind"] == "name" for s in r["spans"])}
    assert named == {*titled, *bare, "Dr. Dulsha Jumbrae came late."}
    assert pii.name_words(df, "text").count() == 10
