"""Language of texts and of the segments of mixed texts (problem 6).

Compression classification: for every language, and every script it is written in, raw text becomes a zstandard
dictionary; a sentence belongs to the language whose dictionary makes it smallest. A narrow margin decides nothing, and a
sentence that no dictionary makes small enough has no language.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.encodings import restore

#: Labelled texts per language that dictionaries are made of, and sentences per text; the bounds of the training sample.
TEXTS_PER_LABEL, SENTENCES_PER_TEXT = 320, 24
#: Bytes of a dictionary and zstandard's level.
DICTIONARY_BYTES, LEVEL = 32_000, -3
#: Rounds in which a dictionary is filled.
FILL_ROUNDS = 4
#: Bytes compressed at once where a whole text is classified, few enough that the dictionary still tells.
BLOCK_BYTES = 4096
#: A sentence has this many words and letters at least.
SENTENCE_WORDS, SENTENCE_LETTERS = 4, 12
#: The share of itself by which the second smallest size is larger than the smallest: below MARGIN it is narrow, and a sentence
#: is then only told from languages that are not the rest of the text's or its label's; below LEAST_MARGIN it decides nothing.
MARGIN, LEAST_MARGIN = 0.2, 0.05
#: Sentences of a label in a script from which it is tried as a language of that script, and the share of them that their own
#: half-made dictionary must claim against those of all other labels.
LEAST_SENTENCES, OWN_SHARE = 8, 2 / 3
#: A sentence is rejected if it stays larger than this many times what nine in ten unseen sentences of the language come to.
REJECT = 1.6

# Scripts by Unicode block (first, last).
SCRIPTS = {
    "latn": ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)),
    "deva": ((0x900, 0x97F), (0xA8E0, 0xA8FF)),
    "beng": ((0x980, 0x9FF),),
    "guru": ((0xA00, 0xA7F),),
    "gujr": ((0xA80, 0xAFF),),
    "orya": ((0xB00, 0xB7F),),
    "taml": ((0xB80, 0xBFF),),
    "telu": ((0xC00, 0xC7F),),
    "knda": ((0xC80, 0xCFF),),
    "mlym": ((0xD00, 0xD7F),),
    "arab": ((0x600, 0x6FF), (0x750, 0x77F), (0xFB50, 0xFDFF), (0xFE70, 0xFEFC)),
    "cyrl": ((0x400, 0x52F),),
}
_RANGES = {name: "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in spans) for name, spans in SCRIPTS.items()}
_RUNS = {name: re.compile(f"[{r}]+") for name, r in _RANGES.items()}
_SHARED = "।॥ـ،؛؟۔"  # signs that several scripts use are no evidence of a script
_FOREIGN = re.compile(f"(?![{_SHARED}])[" + "".join(r for name, r in _RANGES.items() if name != "latn") + "]")
_STOP = re.compile(r"[.!?।॥۔؟…][\"'’”)\]]*\s+")
_SHORT = re.compile(r"(?:^|[\s(])(?:[A-Za-z]|No|no|NO|Mr|Ms|Mrs|Dr|St|Rs)$")  # what stands before a full stop that ends no sentence
_ODD = re.compile(r"[@＠/\\_(){}\[\]<>=;]")
_NOISE = re.compile(r"\S*[@＠/\\_]\S*|\S*[(){}\[\]<>=;]{2,}\S*")
_CODE = re.compile(r"[{}\[\]<>=;_]|\(\w*\)")
_CODE_START = re.compile(r"\s*(?:import|from|def|class|return|select|insert|update|for|while|if|const|let|var|function|public|static|#include)\b.*(?:[(;={:]|_)", re.I)
_LETTERS = re.compile(r"[^\W\d_]")


def sentences(text: str) -> list[str]:
    """Sentences of a text: cut after closing marks and at line ends, but not at line ends inside runs of one or two words."""
    out: list[str] = []
    at = 0
    for m in [*_STOP.finditer(text), None]:
        if m is not None and m.group()[0] == "." and _SHORT.search(text, max(at, m.start() - 5), m.start()):
            continue
        part = text[at:] if m is None else text[at : m.end()].rstrip()
        if m is not None:
            at = m.end()
        if "\n" not in part and "\r" not in part:
            if part:
                out.append(part)
            continue
        held: list[str] = []
        for line in part.splitlines():
            words = line.split()
            if len(words) < 3 or (held and len(held) < 3):
                held += words
            else:
                if held:
                    out.append(" ".join(held))
                held = words
        if held:
            out.append(" ".join(held))
    return out


def script_of(s: str) -> str | None:
    """The script of a sentence. Two or more words, or a quarter of the letters, in another script outweigh Latin ones, since
    names, addresses and single foreign words are often Latin."""
    if s.isascii():
        return "latn" if _LETTERS.search(s) else None
    found = _FOREIGN.search(s)
    latin = _RUNS["latn"].search(s)
    if found is None:
        return "latn" if latin else None
    size = lambda name: sum(map(len, _RUNS[name].findall(s)))
    best = next(name for name, p in _RUNS.items() if p.match(found.group()))
    n = size(best)
    if 2 * n < len(s) or latin:
        counts = {name: size(name) for name in SCRIPTS}
        latin_letters = counts.pop("latn")
        best = max(counts, key=counts.get)
        if latin_letters > 3 * counts[best] and sum(1 for w in s.split() if _FOREIGN.search(w)) < 2:
            return "latn"
    return best


def clean(s: str) -> str:
    """Without addresses, handles and code-like tokens; lower case; composed."""
    if _ODD.search(s):
        s = _NOISE.sub(" ", s)
    if not s.isascii():
        s = unicodedata.normalize("NFC", s)
    return s.lower()


def is_code(s: str) -> bool:
    """Whether a Latin sentence is program code rather than prose."""
    return len(_CODE.findall(s)) >= 3 or bool(_CODE_START.match(s) and _CODE.search(s))


def _letters(s: str) -> int:
    """Letters of a sentence; counting stops once there are enough for a whole one."""
    n = len(_LETTERS.findall(s, 0, 60))
    return n if n >= SENTENCE_LETTERS else n + len(_LETTERS.findall(s, 60))


def _sizer(data: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)


def _fill(parts: list[bytes], rounds: int = 1) -> bytes:
    """Raw content of at most DICTIONARY_BYTES: the first sentences, then, in rounds, those that what is chosen so far makes
    least small, so that a bounded dictionary covers what the language's sentences say and not only how often."""
    left, out, n = list(dict.fromkeys(parts)), [], 0
    while left and n < DICTIONARY_BYTES:
        if out:
            have = _sizer(b"\n".join(out))
            left.sort(key=lambda b: -len(have.compress(b)) / max(1, len(b)))
        room, at = n + DICTIONARY_BYTES // rounds, 0
        while at < len(left) and n < room and n + len(left[at]) < DICTIONARY_BYTES:
            n += len(left[at]) + 1
            at += 1
        if not at:
            break
        out, left = out + left[:at], left[at:]
    return b"\n".join(out)


def _sizes(pools: dict[str, list[bytes]], asked: set[str]) -> dict[str, tuple[list[str], np.ndarray]]:
    """For each label asked for: the labels, and what their dictionaries, made of the other half of every label's sentences,
    make of each of its sentences."""
    names = sorted(pools)
    halves = [[_sizer(_fill(pools[k][h::2])) for k in names] for h in (0, 1)]
    return {k: (names, np.array([[len(c.compress(b)) for c in halves[1 - i % 2]] for i, b in enumerate(pools[k])])) for k in asked}


def languages_of_script(pools: dict[str, list[bytes]], shares: dict[str, float]) -> dict[str, list[bytes]]:
    """The labels that are languages of a script, each with its own sentences.

    The script that most of a label's sentences are in is one of its language. Elsewhere wrong labels and foreign sentences
    put one language's sentences under several labels, and then no dictionary claims most of its own unseen sentences: as
    long as such a label falls short of OWN_SHARE, it or the one that claims most of the rest is removed, namely the one
    with the smaller share of its sentences in this script; the pair with the smallest such share comes first. The labels'
    sizes and order make no difference. Of the languages left, sentences that are likelier another one's are removed.
    """
    pools = dict(pools)
    home = {k for k in pools if 2 * shares[k] > 1}
    sizes = _sizes(pools, pools.keys() - home)
    while len(pools) > 1 and pools.keys() - home:
        pairs = []
        for k in pools.keys() - home:
            names, table = sizes[k]
            held = [i for i, o in enumerate(names) if o in pools]
            best = table[:, held] == table[:, held].min(axis=1, keepdims=True)
            claims = {names[i]: float(c) for i, c in zip(held, (best / best.sum(axis=1, keepdims=True)).mean(axis=0), strict=True)}
            if claims[k] < OWN_SHARE:
                other = max((o for o in pools if o != k), key=lambda o: (claims[o], shares[o], o))
                pairs.append(min((shares[k], k), (shares[other], other)) if other not in home else (shares[k], k))
        if not pairs:
            break
        del pools[min(pairs)[1]]
    return _own(pools)


def _own(pools: dict[str, list[bytes]]) -> dict[str, list[bytes]]:
    """Each language's sentences without those whose words are likelier under another one, twice over. Shares of words
    tell where the foreign sentences of a small pool repeat each other, which dictionaries would take for its own."""
    for _ in range(2 if len(pools) > 1 else 0):
        counts = {k: Counter(w for b in p for w in b.split()) for k, p in pools.items()}
        kinds = len(set().union(*counts.values()))
        totals = {k: c.total() + kinds / 2 for k, c in counts.items()}

        def likely(k: str, words: list[bytes]) -> float:
            return sum(log((counts[k][w] + 0.5) / totals[k]) for w in words)

        pools = {k: [b for b in p if likely(k, b.split()) >= max(likely(o, b.split()) for o in pools)] for k, p in pools.items()}
    return pools


def _limit(parts: list[bytes]) -> float:
    """The size, as a share of itself, from which a sentence is not the language's; judged by unseen sentences."""
    halves = [_sizer(_fill(parts[h::2])) for h in (0, 1)]
    ratios = sorted(len(halves[1 - i % 2].compress(b)) / len(b) for i, b in enumerate(parts) if b)
    return REJECT * ratios[len(ratios) * 9 // 10] if ratios else 0.0


Model = dict[tuple[str, str], tuple[bytes, float]]


def train(labelled: list[tuple[str, str]]) -> Model:
    """``{(language, script): (raw content, largest share)}`` from ``(language, text)`` pairs whose labels may be wrong."""
    pool: dict[tuple[str, str], list[bytes]] = defaultdict(list)
    total: dict[str, int] = defaultdict(int)
    for lang, text in labelled:
        text = restore(text)[0] or ""
        for s in [s for s in sentences(text) if len(s.split()) >= SENTENCE_WORDS][:SENTENCES_PER_TEXT]:
            sc = script_of(s)
            if sc and not (sc == "latn" and is_code(s)):
                pool[lang, sc].append(clean(s).encode())
                total[lang] += 1
    by_script: dict[str, dict[str, list[bytes]]] = defaultdict(dict)
    for (lang, sc), parts in sorted(pool.items()):
        if len(parts) >= LEAST_SENTENCES:
            by_script[sc][lang] = parts
    model: Model = {}
    for sc, pools in by_script.items():
        for lang, parts in languages_of_script(pools, {k: len(p) / total[k] for k, p in pools.items()}).items():
            if parts:
                model[lang, sc] = (_fill(parts, FILL_ROUNDS), _limit(parts))
    return model


class Classifier:
    """Sizes under every dictionary; one per Python worker."""

    def __init__(self, model: Model):
        self.by: dict[str, list[tuple[str, zstandard.ZstdCompressor, float]]] = defaultdict(list)
        for (lang, sc), (data, limit) in sorted(model.items()):
            self.by[sc].append((lang, _sizer(data), limit))

    def decide(self, s: str, sc: str | None, reject: bool = True) -> tuple[str | None, float]:
        """Language and confidence of one sentence, None where no dictionary has its script or makes it small enough.

        Between languages of one script the confidence is 0.5 at MARGIN. A script with one language has nothing to compare
        with; there the confidence falls to 0.5 as the sentence's size comes to the limit. ``reject`` False, for what is
        shorter than a sentence, takes the smallest whatever its size.
        """
        langs = self.by.get(sc)
        if not langs:
            return None, 0.0
        b = clean(s).encode()
        sizes = sorted((len(c.compress(b)), lang, limit) for lang, c, limit in langs)
        first, lang, limit = sizes[0]
        ratio = first / max(1, len(b))
        if reject and ratio > limit:
            return None, 0.0
        if len(sizes) == 1:
            return lang, 0.5 + 0.5 * max(0.0, 1 - ratio / limit) if limit else 0.5
        return lang, min(1.0, (sizes[1][0] - first) / sizes[1][0] / (2 * MARGIN))

    def main(self, text: str | None) -> str | None:
        """The language most of a whole text is written in: of the languages of its commonest script, the one whose
        dictionary makes the text, block by block, smallest. Null for null and empty texts, unknown scripts, and texts that
        no language of the script makes small enough."""
        if not text:
            return None
        data = np.frombuffer(restore(text)[0].lower().encode(), np.uint8)
        first = np.bincount(data, minlength=256)
        second = np.bincount(data[1:][data[:-1] == 0xE0], minlength=256)
        sizes = {"latn": int(first[97:123].sum()), "arab": int(first[0xD8:0xDC].sum()), "cyrl": int(first[0xD0:0xD4].sum())}
        for i, name in enumerate(("deva", "beng", "guru", "gujr", "orya", "taml", "telu", "knda", "mlym")):
            sizes[name] = int(second[0xA4 + 2 * i : 0xA6 + 2 * i].sum())
        sc = max(sizes, key=sizes.get)
        langs = self.by.get(sc) if sizes[sc] else None
        if not langs:
            return None
        raw = data.tobytes()
        blocks = [raw[i : i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
        size, lang, limit = min((sum(len(c.compress(b)) for b in blocks), lang, limit) for lang, c, limit in langs)
        long = text.count(" ") >= SENTENCE_WORDS - 1 and sizes[sc] >= SENTENCE_LETTERS
        return None if long and size > limit * len(raw) else lang

    def segments(self, text: str | None, label: str | None = None, cut_at: int | None = None) -> list[tuple[str | None, float, int, int]]:
        """``(language, confidence, characters, whole sentences)`` of the segments of a text, in order.

        Garbled text is restored first. A sentence with a narrow margin is not told from the main language of the text,
        and a text with narrow margins only not from its label. Sentences that decide nothing join the segment before
        them, or else the one after. A text of which no sentence decides anything is classified as one, with no whole
        sentence. ``cut_at``: the length at which texts were cut off, whose last sentence is then not whole.
        """
        if not text:
            return []
        whole = cut_at is None or len(text) < cut_at
        text = restore(text)[0]
        parts = [s for s in sentences(text) if s.strip()]
        seen: list[tuple[str | None, float, str | None]] = []
        weight: dict[str, float] = defaultdict(float)
        for i, s in enumerate(parts):
            sc = script_of(s)
            full = (whole or i < len(parts) - 1) and s.count(" ") >= SENTENCE_WORDS - 1 and _letters(s) >= SENTENCE_LETTERS
            lang, conf = self.decide(s, sc) if full and not (sc == "latn" and is_code(s)) else (None, 0.0)
            if lang:
                weight[lang] += conf * len(s)
            seen.append((lang, conf, sc))
        if label and max(weight.values(), default=0) < 20:
            weight[label] += 20
        main = max(weight, key=lambda k: (weight[k], k)) if weight else label
        rows: list[list] = []
        for s, (lang, conf, sc) in zip(parts, seen, strict=True):
            if lang and lang != main and conf < 0.5 and (2 * MARGIN * conf < LEAST_MARGIN or any(k == main for k, *_ in self.by[sc])):
                lang = None
            if lang is None:
                if rows:
                    rows[-1][2] += len(s)
                else:
                    rows.append([None, 0.0, len(s), 0])
            elif rows and rows[-1][0] in (lang, None):
                r = rows[-1]
                r[1] = (r[1] * r[3] + conf) / (r[3] + 1)
                r[0], r[2], r[3] = lang, r[2] + len(s), r[3] + 1
            else:
                rows.append([lang, conf, len(s), 1])
        if len(rows) == 1 and rows[0][0] is None:  # shorter than a sentence, or nothing was decided: the text as one
            sc = script_of(text)
            if not (sc == "latn" and is_code(text)) and len(_LETTERS.findall(text)) >= 3:
                lang, conf = self.decide(text, sc, text.count(" ") >= SENTENCE_WORDS - 1 and _letters(text) >= SENTENCE_LETTERS)
                if conf < 0.5 and any(k == label for k, *_ in self.by.get(sc, ())):
                    lang = label
                rows[0][:2] = lang, conf
        return [tuple(r) for r in rows]


_SEGMENT = pa.struct([("lang", pa.string()), ("confidence", pa.float64()), ("chars", pa.int64()), ("sentences", pa.int64())])
SCHEMA = "segments array<struct<lang:string,confidence:double,chars:bigint,sentences:bigint>>"


def identify(df: DataFrame, text: str, label: str, model: Model, keep: list[str], cut_at: int | None = None) -> DataFrame:
    """``keep`` columns and the language segments of ``text`` for every row; null and empty texts have no segments.

    ``label`` holds a language code or null. Repeated rows give repeated rows. The model, at most DICTIONARY_BYTES for each
    language and script, is broadcast once.
    """
    held = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Classifier(held.value)
        for batch in batches:
            n = batch.num_columns
            pairs = zip(batch.column(n - 1).to_pylist(), batch.column(n - 2).to_pylist(), strict=True)
            got = [[dict(zip(("lang", "confidence", "chars", "sentences"), s, strict=True)) for s in c.segments(t, own, cut_at)] for t, own in pairs]
            cols = [batch.column(i) for i in range(n - 2)] + [pa.array(got, pa.list_(_SEGMENT))]
            yield pa.RecordBatch.from_arrays(cols, [*batch.schema.names[:-2], "segments"])

    kinds = dict(df.dtypes)
    return df.select(*keep, F.col(label).alias("_label"), F.col(text).alias("_text")).mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), SCHEMA]))


def label_code(label: Column, names: dict[str, str]) -> Column:
    """The code a label names: code, two-letter code or English name, whatever the case and what follows a hyphen or underscore."""
    key = F.lower(F.trim(F.regexp_extract(label, r"^([^-_]*)", 1)))
    return F.element_at(F.create_map(*[F.lit(x) for kv in sorted(names.items()) for x in kv]), key) if names else F.lit(None).cast("string")


def code_names(codes: DataFrame) -> dict[str, str]:
    """Every lower-case name of the languages of a small code table."""
    out = {}
    for r in codes.select("code", "code_two", "english_name").collect():
        for x in r:
            if x and x.strip():
                out[x.strip().lower()] = r["code"]
    return out


def training_sample(df: DataFrame, label: Column, text: str, key: str) -> list[tuple[str, str]]:
    """At most ``TEXTS_PER_LABEL`` texts of each label, the same for any order of the rows.

    Counts over all rows decide which share of a label's rows, by a hash of the key, is read with its text.
    """
    named = df.select(label.alias("code"), F.col(key).alias("key"), F.col(text).alias("text")).where("code is not null and text is not null")
    counts = {r["code"]: r["count"] for r in named.groupBy("code").count().collect()}
    shares = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1_000_000, 2_000_000 * TEXTS_PER_LABEL // n))]) if counts else None
    if shares is None:
        return []
    slot = F.pmod(F.xxhash64("key"), F.lit(1_000_000))
    few = named.where(slot < F.element_at(shares, F.col("code")))
    rank = F.row_number().over(Window.partitionBy("code").orderBy(F.xxhash64("key", F.lit(1)), "key"))
    return [(r["code"], r["text"]) for r in few.withColumn("rank", rank).where(F.col("rank") <= TEXTS_PER_LABEL).orderBy("code", "rank").collect()]
