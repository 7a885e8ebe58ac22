"""Text operators of the subpackage, without Spark where they need none."""

import random

import numpy as np
import pytest

from tessera.functions import domain
from tessera.llm import abuse, encodings, language, leaks, pii, tokens

HIN = ["यह पुराना बाजार बहुत बड़ा है और लोगों को पसंद है।", "हमारे गाँव में नदी के पास एक मंदिर बनाया गया।", "लोग कहते हैं कि स्कूल अब बंद रहता है।"]
ENG = ["The old market near the river was painted again last winter.", "People say that the school will open before the rains.", "Nobody expected that the bridge would be repaired this year."]
MAR = ["जेव्हा नदी पुन्हा रंगवली गेली तेव्हा शाळा बंद होती.", "आमच्या गावात विहिरीची काळजी घेतली जाते.", "लोक म्हणतात की बाजार सर्वांना आवडला आहे."]


@pytest.mark.parametrize("codec", ["cp1252", "latin-1", "mac_roman", "cp437", "cp1251", "koi8-r"])
def test_garbled_text_round_trip(codec):
    for text in (*HIN, "اردو میں ایک جملہ ہے", "the café’s résumé — “quoted”"):
        bad = encodings._decode(text.encode(), codec)
        fixed, spans, lost, _ = encodings.restore(bad)
        assert fixed == text and spans and not lost


def test_garbled_span_in_correct_text_only():
    good, bad = HIN[0], encodings._decode(HIN[1].encode(), "cp1252")
    fixed, spans, lost, _ = encodings.restore(f"{good} naïve {bad}")
    assert fixed == f"{good} naïve {HIN[1]}" and spans


@pytest.mark.parametrize("text", ["ਪੰਜਾਬੀ ਵਿੱਚ ਇੱਕ ਵਾਕ", "ಕನ್ನಡದ ಒಂದು ವಾಕ್ಯ", "മലയാളത്തിൽ ഒരു വാക്യം", "ଓଡ଼ିଆ ବାକ୍ୟ", "Это русское предложение", "Αυτή είναι μια πρόταση", "zażółć gęślą jaźń", "so happy 😀🚀 today"])
def test_more_scripts_round_trip(text):
    for codec in ("cp1252", "mac_roman", "cp437"):
        assert encodings.restore(encodings._decode(text.encode(), codec))[0] == text


@pytest.mark.parametrize("true", ["cp1251", "koi8-r", "iso8859-5", "cp1253"])
def test_single_byte_pairs(true):
    text = "Η ελληνική γλώσσα έχει μεγάλη ιστορία" if true == "cp1253" else "Привет, это обычное русское предложение о погоде"
    for read in ("cp1252", "latin-1"):
        got = encodings.restore(f"He wrote: {encodings._decode(text.encode(true), read)} (1998)")
        assert sum(a == b for a, b in zip(got[0], f"He wrote: {text} (1998)")) >= len(got[0]) - 6 and got[1] >= 3 and got[3].startswith(true)


def test_twice_garbled():
    once = "don’t".encode().decode("cp1252")
    assert encodings.restore(once.encode().decode("cp1252"))[0] == "don’t"


@pytest.mark.parametrize("text", [None, "", "plain", "The chart shows Ã, Â and Å.", "ÂNCORA", "naïve résumé façade", "An ångström", "long Ð and round Þ", "₹1745 — ok…", "x" * 200_000, "ÄÖÜ ÉÈÊË", "créée à l’été, Þórður Ðæ", "Ä… und Å’", "3 × 4 × 5"])
def test_intended_letters_stay(text):
    assert encodings.restore(text)[:3] == (text, 0, 0)


def test_lost_characters_are_reported():
    assert encodings.restore("समिती �� का���")[1:3] == (5, 5)


def _model():
    rng = random.Random(3)
    texts = []
    for lang, pool in (("hin", HIN), ("eng", ENG), ("mar", MAR)):
        words = [s.rstrip("।.").split() for s in pool]
        for _ in range(60):
            texts.append((lang, " ".join(" ".join(rng.choice(words)) + (". " if lang != "hin" else "। ") for _ in range(6))))
    texts += [("hin", ENG[0])] * 5  # wrong labels
    return language.Classifier(language.train(texts))


def test_language_of_texts_and_segments():
    c = _model()
    assert [s[0] for s in c.segments(" ".join(HIN), None)] == ["hin"]
    assert [s[0] for s in c.segments(f"{MAR[0]} {ENG[0]} {MAR[1]}", "mar")] == ["mar", "eng", "mar"]
    assert c.main(" ".join(MAR)) == "mar" and c.main(None) is None and c.main("") is None
    assert c.segments(None) == [] and c.segments("") == []


def test_language_of_garbled_text_and_code():
    c = _model()
    assert c.segments(encodings._decode(HIN[0].encode(), "cp1252"), None)[0][0] == "hin"
    assert all(s[0] != "eng" for s in c.segments(f"{HIN[0]}\nfor (let i = 0; i < 9; i++) {{ log(x[i]); }}", "hin"))


def _drawn(seed, sizes):
    """Labelled texts of invented languages: two share a script, one of them is also romanised, texts have foreign
    sentences and some labels are wrong."""
    rng = random.Random(seed)
    word = lambda lo, hi: "".join(chr(rng.randint(lo, hi)) for _ in range(rng.randint(3, 8)))
    vocab = {"hin": [word(0x915, 0x939) for _ in range(120)], "eng": [word(97, 122) for _ in range(120)], "tam": [word(0xB95, 0xBB9) for _ in range(120)], "rom": [word(97, 122) for _ in range(60)]}
    vocab["mar"] = vocab["hin"][:40] + [word(0x915, 0x939) for _ in range(80)]
    said = lambda k: " ".join(rng.choice(vocab[k]) for _ in range(rng.randint(6, 14))) + ". "
    out, probe = [], []
    for lang, n in sizes.items():
        for _ in range(n):
            kinds = [rng.choice(list(sizes)) if rng.random() < 0.05 else lang for _ in range(6)]
            if lang == "hin" and rng.random() < 0.12:
                kinds = ["rom"] * 6
            out.append((rng.choice(list(sizes)) if rng.random() < 0.04 else lang, "".join(map(said, kinds))))
    for k in vocab:
        probe += [("hin" if k == "rom" else k, said(k).strip()) for _ in range(60)]
    return out, probe, [word(0xB95, 0xBB9) + " " + word(0xB95, 0xBB9) + " " + " ".join(word(0xB95, 0xBB9) for _ in range(8)) + "." for _ in range(60)]


@pytest.mark.parametrize(
    ("seed", "sizes"),
    [(1, {"hin": 300, "eng": 300, "tam": 200, "mar": 200}), (2, {"mar": 300, "hin": 200, "tam": 300, "eng": 150}), (3, {"tam": 300, "mar": 320, "eng": 320, "hin": 90}), (4, {"hin": 320, "mar": 60, "tam": 40, "eng": 60})],
)
def test_languages_hold_whatever_the_draw(seed, sizes):
    texts, probe, strange = _drawn(seed, sizes)
    model = language.train(texts)
    assert set(model) == {("hin", "deva"), ("mar", "deva"), ("eng", "latn"), ("hin", "latn"), ("tam", "taml")}
    c = language.Classifier(model)
    right = sum(c.decide(s, language.script_of(s))[0] == lang for lang, s in probe)
    assert right >= 0.97 * len(probe)
    assert sum(c.decide(s, "taml")[0] is None for s in strange) >= 0.9 * len(strange)  # no language because of its script alone


def test_a_long_head_of_signs_does_not_hide_a_sentence():
    c = _model()
    assert c.segments("1234567890 " * 8 + HIN[0], "eng")[0][0] == "hin"


def test_token_counts_equal_the_tokenizer():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = tokens.vocabulary(f"{tokens.TOKENIZERS}/{tokens.VOCABULARY}")
    c = tokens.TokenCounter(ranks)
    enc = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    rng = random.Random(1)
    texts = [*HIN, *ENG, *MAR, "", " ", "\n\n a  b\tc \r\n", "it's we'll x'd", "½ ⅓ 12345 ١٢٣", "ab" * 3000, "😀🇮🇳é́", "def f(x):\n    return {x: [1, 2]}"]
    texts += ["".join(rng.choice("abcdefg hij\n  'sté ा क ம்") for _ in range(rng.randint(1, 300))) for _ in range(200)]
    for t in texts:
        assert c.count(t) == len(enc.encode_ordinary(t)), repr(t)
    assert c.count(None) == 0


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("Write to a.b@example.org now", {"email"}),
        ("Write to a.b (at) example (dot) org now", {"email"}),
        ("Tomatoes @ 30 rupees; follow @canal_news; build 1.2.3-rc@nightly failed", set()),
        ("Call +91 98765 43210 after six", {"phone"}),
        ("मोबाइल नंबर ०९८७६५४३२१० है", {"phone"}),
        ("Order 9641924535449248 was shipped twice on 2024-06-15", set()),
        ("Card 4111 1111 1111 1111 was copied", {"id_number"}),
        ("Account GB82 WEST 1234 5698 7654 32 please", {"id_number"}),
        ("The code GB83WEST12345698765432 is printed below", set()),
        ("Identity number ABCPD1234E in the corner", {"id_number"}),
        ("Home address: Flat 16, 43 Station Cross, Kelmipur 511974", {"address"}),
        ("मेरा पता मकान नंबर 43, बगिया मार्ग, नेडनगर - 270591 है।", {"address"}),
        ("The Lotus Road bridge and Potter Lane market stayed open.", set()),
        ("My name is Velmi Zolkar and I complained twice.", {"name"}),
        ("মেলা ছিল। আমার নাম দেবথ সুলকান্তি।", {"name"}),
        (None, set()),
        ("", set()),
        ("a " * 100_000, set()),
    ],
)
def test_personal_information(text, kinds):
    assert {s[2] for s in pii.find(text)} == kinds


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765433")
    base = "23412341234"
    assert sum(pii.verhoeff(base + str(d)) for d in range(10)) == 1


def test_redaction_keeps_the_rest():
    assert pii.redact("Mail a@b.org, call +91 98765 43210.") == "Mail [EMAIL], call [PHONE]."
    assert pii.redact(None) is None and pii.redact("nothing") == "nothing"


def test_undisguised_words():
    assert abuse.plain("you total m o r o n") == "you total moron"
    assert abuse.plain("मूर्खखखख") == "मूर्ख" and abuse.plain("ना.ला.य.क") == "नालायक"
    assert "pathetic" in abuse.plain("you p4th3t1c thing") and abuse.plain("scu​m") == "scum"


def test_texts_encoded_at_once_equal_single_ones():
    rng = random.Random(6)
    bits = ["you", "m o r o n", "s.c.u.m", "scuuuum", "st0pid", "1dea", "id10t!", "f**l", "**", "a", "b", "१२", "42", "7 up", "मूर्खखख", "ना.ला.य.क", "а-б", "ѕсum", "e.g.", "...", "x\ny", "i a m", "ch*ap", "no!", "Liar.", "p 4 t", "A*B", "😀😀😀"]
    texts = [rng.choice([" ", "  ", "", ". ", "\n"]).join(rng.choice(bits) for _ in range(rng.randint(1, 9))) for _ in range(4000)] + [None, "", " ", "x" * 9000]
    vocab = sorted({f for t in texts[:900] for p in abuse.parts(t) for f in abuse.features(p)})
    folded = [abuse.fold(abuse._one_line(t)) if t else "" for t in texts]
    flags = abuse.disguised(folded)
    assert all(flag or abuse._bare(f) == f for f, flag in zip(folded, flags, strict=True))
    counts, ids, tfs, lens, unknown = abuse.pack([abuse.encode({f: i for i, f in enumerate(vocab)}, abuse.parts(t)) for t in texts])
    got = abuse.Encoder(vocab)(texts)
    order = np.lexsort((ids, np.repeat(np.arange(len(lens)), lens)))
    assert np.array_equal(got[0], counts) and np.array_equal(got[3], lens) and np.allclose(got[4], unknown)
    assert np.array_equal(got[1], ids[order]) and np.allclose(got[2], tfs[order])


def _abuse_sample():
    rng = random.Random(2)
    good = [f"the {a} near the {b} was {c}" for a in ("well", "school", "market", "farm") for b in ("river", "road", "mill") for c in ("painted", "closed", "mapped")]
    bad = [f"you are nothing but a {a} {b}" for a in ("filthy", "rotten", "useless") for b in ("idiot", "moron", "liar", "loser")]
    said = [f"the forum deleted {n} posts with the word idiot" for n in range(9)]
    rows = [(f"{rng.choice(good)}. {rng.choice(bad)}. {rng.choice(good)}.", 1) for _ in range(80)] + [(f"{rng.choice(good)}. {rng.choice(said + good)}.", 0) for _ in range(200)]
    return rows


def test_nearest_examples_equal_brute_force():
    import numpy as np

    rows = _abuse_sample()
    s = abuse.Scorer(abuse.choose(rows), {}, 1000)
    enc = [abuse.encode(s.vocab, abuse.parts(t)) for t, _ in rows[:60]]
    _, ids, tfs, lens, unknown = abuse.pack(enc)
    w = (tfs * s.idf[ids]).astype(np.float32)
    starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
    ok = lens > 0
    got = s.index.search(ids, w, starts[ok], 5)[1]
    dense = np.zeros((len(s.vocab), s.index.n), np.float32)
    for b, (terms, d) in enumerate(s.index.blocks):
        n = min(abuse.BLOCK, s.index.n - b * abuse.BLOCK)
        dense[terms, b * abuse.BLOCK : b * abuse.BLOCK + n] = d[:-1, :n]
    want = np.sort(np.add.reduceat(dense[ids] * w[:, None], starts[ok], axis=0), axis=1)[:, ::-1][:, :5]
    assert np.allclose(got[:, : want.shape[1]], want, atol=1e-5)


def test_abuse_is_told_from_talk_about_it():
    rows = _abuse_sample()
    s = abuse.Scorer(abuse.choose(rows), {}, 1000)
    s.calibrate(rows)
    probe = ["The mill was closed. You are nothing but a f1lthy m o r o n.", "the forum deleted 77 posts with the word idiot.", "the road near the well was mapped.", "", "you are nothing but a rotten ch*ap liar"]
    score = s.score(*abuse.pack([abuse.encode(s.vocab, abuse.parts(t)) for t in probe]))[0]
    assert score[0] > 0.5 and score[4] > 0.5 and max(score[1:4]) < 0.5


def test_longest_common_subsequence():
    assert leaks.lcs([1, 2, 3, 4], (2, 4, 5)) == 2 and leaks.lcs([], (1,)) == 0


def test_paraphrases_shorter_than_a_run():
    index = leaks.EvalIndex([("i", "alpha beta gamma delta epsilon zeta eta theta.")])
    near = leaks.Paraphrases(index, np.eye(8, dtype=np.float32), np.full((1, 8), 8**-0.5, np.float32), [{0, 7}])
    for kept, found in (([0, 2, 3, 5, 7], [(1, 0, 5)]), ([0, 2, 5, 7], []), ([0, 1, 2, 3, 4], []), ([7, 5, 3, 2, 0], [])):
        text = [-1] * 60 + [w for k in kept for w in (k, -1, -1)] + [-1] * 60
        held = [np.array([1, 1]), *(ids for _, ids in leaks._stretches(np.array(text), leaks.LEAST_KEPT, index.longest))]
        assert list(dict.fromkeys(x[:3] for x in near.find(np.concatenate(held), np.cumsum([0, *map(len, held)])))) == found


def test_domain_of_whole_texts():
    long = "plain words " * 500 + " loan interest bank credit insurance mortgage deposit " * 3
    signals = "\nimport os\ndef f(x):\n    return x\nclass A:\n    pass\n#include <a.h>\nconst x = 1;\n"
    for text in (long, "plain words " * 500 + signals):
        assert domain.classify_text(text, "eng", domain.PROBE_CHARS) == "general"
        assert domain.classify_text(text, "eng") == domain.classify_text(text[5900:], "eng") != "general"
