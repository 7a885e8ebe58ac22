"""Functions on hand-made texts, against row-wise definitions where there are any."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tessera.functions import domain, hashing, html, lid, pii, quality, toxicity, words

PROSE = "The village council met by the river and talked about the old bridge for a long while. " * 6
HINDI = "हमारे गाँव में नदी के पास एक पुराना मंदिर है और लोग वहाँ हर सप्ताह जाते हैं। " * 6


def _rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, text string")


def test_word_normal_form(spark):
    texts = ["Straße ＡＢＣ", "ज़रा नुक़्ता", "naïve CAFÉ", "a‌b c­d", "snake_case 12½", "́ alone", "", None, "x" * 50_000]
    got = _rows(spark, texts).select("i", words.words_of(words.folded(F.col("text"))).alias("w")).orderBy("i").collect()
    for r, t in zip(got, texts, strict=True):
        assert (r["w"] or []) == words.normalize_words(t)
    assert words.normalize_words("Straße") == ["strasse"] and words.normalize_words("́") == []
    assert words.normalize_words("ज़रा") == words.normalize_words("ज़रा")


def test_quality(spark):
    junk = "same line again\n" * 40
    texts = [PROSE, HINDI, junk, "short text here.", "", None, "$$$ ### @@@ !!! " * 30, "click here subscribe newsletter cookie " + PROSE]
    got = {r["i"]: r for r in quality.metrics(_rows(spark, texts).withColumn("quality", F.lit(1))).collect()}
    assert got[1]["symbol_ratio"] < 0.05 and got[0]["boilerplate_hits"] == 0
    assert got[2]["dup_line_frac"] > 0.9 and got[2]["quality_score"] < 0.75
    assert got[3]["quality_score"] <= 0.3 and got[3]["quality_bucket"] == "low"
    assert got[4]["quality_score"] <= 0.3 and got[5]["quality_score"] is None and got[5]["quality_bucket"] is None
    assert got[6]["symbol_ratio"] > 0.5 and got[7]["boilerplate_hits"] == 4


def test_bigram_share_equals_counting(spark):
    from collections import Counter

    text = "a b a b a b c d e f g h i j k l m n o p q r s t a b"
    w = text.split()
    want = Counter(zip(w, w[1:])).most_common(1)[0][1] / (len(w) - 1)
    assert abs(quality.metrics(_rows(spark, [text])).first()["top_bigram_frac"] - want) < 1e-12


def test_script_language(spark):
    texts = ["தமிழ் வாக்கியம்", "plain English", "اردو جملہ", HINDI, "বাংলা", "12345", None, "ab गग"]
    d = _rows(spark, texts).withColumn("s", lid.dominant(lid.script_counts(F.col("text")))).orderBy("i")
    got = d.select("s.script", lid.language_of(F.col("s.script")).alias("l"), lid.consistent(F.col("s.script"), F.lit("hin")).alias("c"), lid.effective_language(F.col("s.script"), F.lit("hin")).alias("e")).collect()
    assert [r[1] for r in got] == ["tam", "eng", "urd", None, None, None, None, None]
    assert got[3][0] == "deva" and got[3][2] and got[3][3] == "hin" and not got[0][2] and got[7][0] == "deva"


def test_domain_both_ways(spark):
    texts = [
        "def load(x):\n    return x;\nimport os", "The bank gave a loan at a fixed deposit interest rate.", "बैंक ने ऋण पर ब्याज और बीमा दिया",
        "By the theorem, the equation 3 + 4 = 7 holds; therefore done.", HINDI, PROSE, "", None,
    ]
    langs = ["eng", "eng", "hin", "eng", "hin", "eng", None, None]
    df = spark.createDataFrame(list(zip(texts, langs, strict=True)), "text string, lang string")
    got = [r[0] for r in df.select(domain.classify(F.col("text"), F.col("lang"))).collect()]
    assert got == [domain.classify_text(t, x) for t, x in zip(texts, langs, strict=True)] == ["coding", "bfsi", "bfsi", "reasoning", "indic", "general", "general", None]


def test_toxicity(spark):
    lex = toxicity.Lexicon(("Idiot", "मूर्ख", "break your hands", "break"))
    texts = ["You idiot, I will break your hands", "one idiot in ten clean sentences", "idiots scidiot", "मूर्ख idiot", "", None]
    got = [r["toxicity"] for r in toxicity.flag(_rows(spark, texts), F.col("text"), lex).orderBy("i").collect()]
    assert (got[0]["hits"], got[0]["distinct"], got[0]["flagged"]) == (3, 3, True)
    assert not got[1]["flagged"] and got[2]["hits"] == 0 and got[3]["flagged"] and got[4]["hits"] == 0 and not got[5]["flagged"]
    assert lex.sha256 == toxicity.Lexicon(("break", "idiot", "break your hands", "मूर्ख")).sha256


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("mail a.b+c@x-y.co.in", {"email": 1}),
        ("call +91 9876543210 or 09876543210", {"phone_in": 2}),
        ("1234 5678 9012", {"aadhaar": 1}),
        ("123456789012", {}),
        ("ABCDE1234F abcde1234f", {"pan": 1}),
        ("4111 1111 1111 1111", {"card": 1}),
        ("4111 1111 1111 1112", {}),
        ("GB82 WEST 1234 5698 7654 32", {"iban": 1}),
        ("GB82 WEST 1234 5698 7654 33", {}),
        ("host 10.0.0.1", {"ip": 1}),
        ("४१११ ११११ ११११ ११११", {}),
        ("", {}),
    ],
)
def test_identifiers(spark, text, want):
    r = _rows(spark, [text]).select(pii.scan(F.col("text")).alias("s"), pii.redact(F.col("text")).alias("r")).first()
    assert r["s"] == want
    assert r["r"]["counts"] == want and r["r"]["text"].count("[PII:") == sum(want.values())


def test_identifiers_beyond_the_probe(spark):
    text = "x " * 4050 + "a@b.org"
    r = _rows(spark, [text, None]).select("i", pii.scan(F.col("text"), pii.PROBE_CHARS).alias("s"), pii.scan(F.col("text")).alias("all"), pii.redact(F.col("text")).alias("r")).orderBy("i").collect()
    assert r[0]["s"] == {} and r[0]["all"] == {"email": 1} and r[0]["r"]["counts"] == {"email": 1} and r[1]["s"] == {} and r[1]["r"]["text"] is None


def test_html(spark):
    page = "<html><head><style>p {x}</style><script>var a = '<p>';</script></head><!-- no <b> --><body><p>Tom &amp; Co &#65;&#x42;&copy;</p>\n\n<p>next&nbsp;line</p></body></html>"
    got = _rows(spark, [page, "", None]).select("i", html.strip_tags(F.col("text")).alias("t")).orderBy("i").collect()
    assert got[0]["t"] == "Tom & Co AB&copy;\nnext line" and got[1]["t"] == "" and got[2]["t"] is None
    kept = html.extract(_rows(spark, [page, "<p>" + "word " * 40 + "</p>"]), "text").collect()
    assert [r["i"] for r in kept] == [1] and kept[0]["extractor"] == "strip_tags"


def test_content_identity(spark):
    assert hashing.doc_hash_bytes(b" hello world\n").hex() == "878633aa32a3b150"
    ids = _rows(spark, ["hello world", "second doc", "second doc", None]).select(hashing.doc_hash(F.col("text")).alias("doc_hash"))
    golden = "7e511623482aa839c681b6b4bf41e2604ae7cedd2c207b5406286a7605d6e178"
    assert hashing.ids_digest(ids) == hashing.ids_digest(ids.repartition(7)) == golden
    assert hashing.ids_digest(ids.limit(0)) == "0e5751c026e543b2e8ab2eb06099daa1d1e5df47778f7787faab45cdf12fe3a8"
    assert hashing.ids_digest(ids, distinct=False) != golden


def test_model_identification_falls_back():
    assert lid.method_of(None) == lid.method_of("/no/model") == "script"
    assert lid.method_of("m", load=lambda _: object()) == "model"


def test_model_identification(spark):
    class Model:
        def predict(self, text):
            return (["__label__hi" if "है" in text else "__label__zz"], [0.75])

    got = _rows(spark, ["यह\nहै", "zz", None, " "]).select("i", lid.model_language(F.col("text"), "m", load=lambda _: Model()).alias("m")).orderBy("i").collect()
    assert [(r["m"]["language"], r["m"]["confidence"]) for r in got] == [("hin", 0.75), ("zz", 0.75), (None, None), (None, None)]


def test_tree_digest(spark):
    ids = [hashing.doc_hash_bytes(str(i % 900).encode()) for i in range(1000)]
    d = spark.createDataFrame([(bytearray(h),) for h in ids] + [(None,)], "doc_hash binary")
    for distinct in (True, False):
        by = {}
        for h in sorted(set(ids)) if distinct else sorted(ids):
            by.setdefault(h[:2], hashlib.blake2b(digest_size=32)).update(h)
        root = hashlib.blake2b(b"".join(p + x.digest() for p, x in sorted(by.items())), digest_size=32).hexdigest()
        assert hashing.ids_tree_digest(d.repartition(7), distinct=distinct) == hashing.ids_tree_digest(d.coalesce(1), distinct=distinct) == root
    assert hashing.ids_tree_digest(d.limit(0)) == hashlib.blake2b(digest_size=32).hexdigest()


def test_fixed_parts_of_signals():
    parts = {s: domain.fixed_parts(s) for r in domain.RULES if not r.literal for s in r.signals}
    assert [parts[s] for s in domain.CODE_SIGNALS] == [("def ",), ("function",), ("class",), ("import",), ("#include",), ("public",), ("console.log",), ("SELECT",), ("</",), ("=>",), ("return",), ("null", "None", "nullptr"), ()]
    assert [parts[s] for s in domain.REASONING_SIGNALS[6:]] == [("solve for",), ("step ",), ("therefore",), (), (), ("q",), ("प्रमेय",), ("समीकरण",), ("हल कीजिए",)]
    # whatever the case, also of letters with several small forms
    for text in ("A THEOREM and a Lemma", "ſolve for x, ſtep 3", "Q.E.D. therefore", "the pröof lemma"):
        assert domain.RULES[2].holds(text) == (sum(re.search(p.replace(domain.B, r"(?<!\w)").replace(domain.E, r"(?!\w)").replace(r"\p{Nd}", r"\d"), text, re.I) is not None for p in domain.REASONING_SIGNALS) >= 2)
