"""Abusive, hateful or sexual content (problem 5).

Sentences are compared with labelled example sentences by exact TF-IDF cosine, found through an inverted index with
block maxima; the votes of the nearest examples, weighted by nearness, give a calibrated score, and the nearest
abusive example is the evidence.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.words import fold, plain_runs
from tessera.llm.language import sentences
from tessera.session import materialize

#: Labelled texts of each class that examples are taken from; example sentences of each class in the index.
LABELLED_PER_CLASS, EXAMPLES_PER_CLASS = 8000, 6000
#: Neighbours that vote, examples in a block, and the least cosine that counts as near.
NEIGHBOURS, BLOCK, LEAST_COSINE = 9, 64, 0.12
#: Sentences looked up at once, which bounds the memory of a worker.
SLICE = 8192
#: Calibrated score from which a text counts as a case.
CASE = 0.5

# Characters that stand for Latin letters in disguised spellings.
_LEET = str.maketrans("013457@$!|", "oieastasii")
_LIKE = str.maketrans("аеорсухіѕјԁһ", "aeopcyxisjdh")
_SINGLE = re.compile(r"(?<![^\W_])(?:[a-z][ .\-*_]{1,2}){2,}[a-z](?![^\W_])")
_INNER = re.compile(r"(?<=[^\s.])[.\-_·•](?=[^\s.])")
_REPEAT = re.compile(r"(.)\1{2,}")
_HIDDEN = re.compile(r"(?<=\w)\*+(?=\w)|(?<=\w)\*+")
_LEETHINT = re.compile(r"[a-z][013457@$!|][a-z]|[a-z][013457@$|]|[013457@$!|][a-z]")
_LEETWORD = re.compile(r"(?<!\S)(?=\S*[^\W\d_])(?=\S*[013457@$!|])[a-z013457@$!|]{3,}(?=[^\w]*(?:\s|$))")
_ALIKE = re.compile("[аеорсухіѕјԁһ]")


def plain(s: str) -> str:
    """A text with disguises removed: look-alike characters, letters set apart, stretched letters, invisible signs."""
    return _bare(fold(s))


def _bare(s: str) -> str:
    """The same of a folded text."""
    if not s.isascii() and _ALIKE.search(s):
        s = s.translate(_LIKE)
    s = _INNER.sub("", s)
    s = _SINGLE.sub(lambda m: re.sub(r"[\W_]+", "", m.group()), s)
    if _LEETHINT.search(s):
        s = _LEETWORD.sub(lambda m: m.group().translate(_LEET), s)
    s = _REPEAT.sub(r"\1", s)
    return _HIDDEN.sub("*", s) if "*" in s else s


# Kinds of characters that the patterns above need, one bit each.
_AZ, _APART, _DIGITS, _DIGITS_ALONE, _JOINS, _STAR, _LIKES, _BLANK = (1 << i for i in range(8))


@lru_cache(1)
def _kinds() -> np.ndarray:
    kinds = np.zeros(0x2100, np.uint8)
    for chars, bit in (
        ("abcdefghijklmnopqrstuvwxyz", _AZ), (" .-*_", _APART), ("013457@$!|", _DIGITS), ("013457@$|", _DIGITS_ALONE), (".-_·•", _JOINS), ("*", _STAR), ("".join(map(chr, range(0x400, 0x530))), _LIKES),
        ("".join(map(chr, range(33))), _BLANK),
    ):
        kinds[[ord(c) for c in chars]] |= bit
    return kinds


def disguised(folded: list[str]) -> np.ndarray:
    """Which folded texts may hold what :func:`_bare` removes, judged by pairs and triples of characters for all texts at once.
    It flags some texts too many but misses none."""
    lens = np.array([len(s) for s in folded], np.int64)
    chars = np.frombuffer("".join(["\n\n\n\n", *(x for s in folded for x in (s, "\n")), "\n\n\n\n"]).encode("utf-32-le"), np.uint32)
    k = _kinds()[np.minimum(chars, 0x20FF)]
    at = lambda i: k[4 + i : len(k) - 4 + i]
    here, before, after = at(0), at(-1), at(1)
    alone = (here & _AZ > 0) & (before & after & _APART > 0)
    alone &= ((at(-2) & _AZ > 0) & (at(-3) & _AZ == 0)) | ((at(-2) & _APART > 0) & (at(-3) & _AZ > 0) & (at(-4) & _AZ == 0))
    odd = alone | (here & (_STAR | _LIKES) > 0)
    odd |= (here & _JOINS > 0) & ((before | after) & _BLANK == 0)
    odd |= ((here & _AZ > 0) & (after & _DIGITS_ALONE > 0)) | ((here & _DIGITS > 0) & (after & _AZ > 0))
    c = chars[4 : len(chars) - 4]
    odd |= (c == chars[5 : len(chars) - 3]) & (c == chars[6 : len(chars) - 2])
    out = np.zeros(len(folded) + 1, bool)
    out[np.searchsorted(np.cumsum(lens + 1), np.flatnonzero(odd), side="right")] = True
    return out[: len(folded)]


def parts(text: str | None) -> list[str]:
    """Sentences of a text without disguises. Line ends within the text are blanks here, since disguised text is broken anywhere."""
    return [s for s in sentences(plain(_one_line(text))) if s.strip()] if text else []


def _one_line(text: str) -> str:
    return text.replace("\r", " ").replace("\n", " ")


def _words(sentence: str) -> list[str]:
    """Words of a plain sentence; one with hidden letters is one kind of word."""
    if "*" not in sentence:
        return plain_runs(sentence)
    words = []
    for part in sentence.split():
        words += ["\x01"] if "*" in part and any(c.isalpha() for c in part) else plain_runs(part)
    return words


def features(sentence: str) -> list[str]:
    """Words and pairs of words of a plain sentence; numbers are all alike."""
    words = ["0" if w.isdigit() else w for w in _words(sentence)]
    return words + list(map(" ".join, zip(words, words[1:])))


class BlockMaxIndex:
    """Exact nearest examples by cosine. Examples lie in blocks of alike ones; a term's largest weight in a block bounds
    what any example of the block can score, so only blocks whose bound beats the k-th best found so far are opened."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, starts: np.ndarray, size: int):
        """Examples are consecutive runs of terms; ``starts`` has one more entry than there are examples."""
        self.n, self.size = len(starts) - 1, size
        nb = -(-self.n // BLOCK)
        self.maxima = np.zeros((size, nb), np.float32)
        self.blocks = []
        for b in range(nb):
            first, last = b * BLOCK, min((b + 1) * BLOCK, self.n)
            span = slice(starts[first], starts[last])
            known, place = np.unique(terms[span], return_inverse=True)
            dense = np.zeros((len(known) + 1, BLOCK), np.float32)  # the last row is for terms the block lacks
            dense[place, np.repeat(np.arange(last - first), np.diff(starts[first : last + 1]))] = weights[span]
            self.maxima[known, b] = dense[:-1].max(axis=1, initial=0)
            self.blocks.append((known, dense))

    def cosines(self, b: int, terms: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Cosines of queries, consecutive runs of terms from ``starts``, with the examples of a block."""
        known, dense = self.blocks[b]
        place = np.minimum(np.searchsorted(known, terms), len(known) - 1)
        place[known[place] != terms] = len(known)
        return np.add.reduceat(dense[place] * weights[:, None], starts, axis=0)

    def search(self, terms: np.ndarray, weights: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, cosines)`` of the k nearest of each query; queries are consecutive runs of terms from ``starts``."""
        q = len(starts)
        ids, best = np.full((q, k), -1, np.int64), np.zeros((q, k), np.float32)
        if not q or not self.n:
            return ids, best
        bounds = np.add.reduceat(self.maxima[terms] * weights[:, None], starts, axis=0)
        ends = np.append(starts[1:], len(terms))
        order = np.argsort(-bounds, axis=1, kind="stable")
        opened = np.zeros(bounds.shape, bool)

        def open_(b: int, qs: np.ndarray) -> None:
            at, new, _ = _take(qs, starts, ends - starts)
            sims = self.cosines(b, terms[at], weights[at], new)
            here = np.arange(b * BLOCK, (b + 1) * BLOCK)
            both = np.concatenate([best[qs], sims], axis=1)
            who = np.concatenate([ids[qs], np.broadcast_to(np.where(here < self.n, here, -1), sims.shape)], axis=1)
            top = np.argsort(-both, axis=1, kind="stable")[:, :k]
            best[qs], ids[qs] = np.take_along_axis(both, top, 1), np.take_along_axis(who, top, 1)
            opened[qs, b] = True

        for turn in range(min(2, bounds.shape[1])):
            for b in np.unique(order[:, turn]):
                open_(int(b), np.nonzero(order[:, turn] == b)[0])
        for b in np.argsort(-bounds.max(axis=0)):
            qs = np.nonzero(~opened[:, b] & (bounds[:, b] > best[:, -1] + 1e-7) & (bounds[:, b] > 0))[0]
            if len(qs):
                open_(int(b), qs)
        return ids, best


def choose(labelled: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Example sentences from labelled texts. All sentences of harmless texts are harmless; of an abusive text those are
    abusive whose words are likeliest in abusive texts, the others are left out. Labels may be wrong: a sentence of both
    kinds of texts has the commoner label, and abusive texts in which no sentence stands out give none."""
    seen = {0: Counter(), 1: Counter()}
    total = Counter()
    texts = []
    for text, y in labelled:
        got = [(s, features(s)) for s in parts(text)]
        texts.append((got, y))
        total[y] += 1
        seen[y].update({f for _, fs in got for f in fs})
    a, b = total[1] + 1, total[0] + 1
    share = a / (a + b)
    # smoothed towards the share of all texts, so that a word seen once tells little
    odds = lambda f: float(np.log((seen[1][f] + 4 * share) / (seen[0][f] + 4 * (1 - share))) - np.log(share / (1 - share)))
    votes: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    odd: dict[str, float] = {}
    kept: dict[str, str] = {}
    for got, y in texts:
        if not got:
            continue
        scores = []
        for s, fs in got:
            o = sorted((odds(f) for f in set(fs)), reverse=True)[:6]
            scores.append(sum(o) / max(1, len(o)))
        top = max(scores)
        for (s, fs), score in zip(got, scores, strict=True):
            key = " ".join(fs)
            if y == 0 or (score > 1.0 and score >= 0.6 * top):
                votes[key][y] += 1
                kept.setdefault(key, s)
                odd[key] = score
    out: dict[int, list[tuple[float, str, str]]] = {0: [], 1: []}
    for key, (no, yes) in votes.items():
        # where there are too many, those that look most abusive come first: among the harmless they are the telling ones
        out[int(yes * b > no * a)].append((-round(odd[key], 2), hashlib.blake2b(key.encode(), digest_size=8).hexdigest(), kept[key]))
    return [(s, y) for y in (0, 1) for *_, s in sorted(out[y])[:EXAMPLES_PER_CLASS]]


class Scorer:
    """Index, weights and calibration, made once from examples and document frequencies."""

    def __init__(self, examples: list[tuple[str, int]], df: dict[str, int], n: int):
        fs = [Counter(features(s)) for s, _ in examples]
        self.vocab = {f: i for i, f in enumerate(sorted({f for c in fs for f in c}))}
        self.unknown = float(np.log(n + 1)) + 1
        self.idf = np.array([np.log((n + 1) / (df.get(f, 0) + 1)) + 1 for f in self.vocab])
        rows = []
        for c in fs:
            r = {self.vocab[f]: (1 + log(k)) * self.idf[self.vocab[f]] for f, k in c.items()}
            norm = sum(w * w for w in r.values()) ** 0.5 or 1.0
            rows.append({t: w / norm for t, w in r.items()})
        # alike examples share blocks: order by label and heaviest terms
        order = sorted(range(len(rows)), key=lambda i: (examples[i][1], sorted(rows[i], key=lambda t: -rows[i][t])[:2], i))
        terms = np.array([t for i in order for t in rows[i]], np.int64)
        weights = np.array([w for i in order for w in rows[i].values()], np.float32)
        starts = np.concatenate([[0], np.cumsum([len(rows[i]) for i in order])]).astype(np.int64)
        self._load([examples[i] for i in order], terms, weights, starts, self.idf, self.unknown, None)

    def _load(self, examples: list[tuple[str, int]], terms: np.ndarray, weights: np.ndarray, starts: np.ndarray, idf: np.ndarray, unknown: float, bins) -> None:
        self.examples, self.idf, self.unknown, self.bins = examples, idf, unknown, bins
        self.arrays = (terms, weights, starts)
        self.label = np.array([y for _, y in examples] + [0], np.float32)
        self.index = BlockMaxIndex(terms, weights, starts, len(idf))
        n = self.index.n
        blocks = [b for b in range(self.index.maxima.shape[1]) if self.label[b * BLOCK : min((b + 1) * BLOCK, n)].any()]
        self.abusive_blocks = blocks
        self.label_of = [np.append(self.label[b * BLOCK : min((b + 1) * BLOCK, n)], np.zeros(max(0, (b + 1) * BLOCK - n), np.float32)) for b in range(self.index.maxima.shape[1])]
        self.abusive = np.ascontiguousarray(self.index.maxima[:, blocks])
        self.abusive_most = self.abusive.max(axis=1) if blocks else np.zeros(len(idf), np.float32)

    def state(self) -> tuple:
        """What a worker needs to score encoded texts: bounded by the number of examples."""
        return self.examples, *self.arrays, self.idf, self.unknown, self.bins

    @classmethod
    def of_state(cls, state: tuple) -> Scorer:
        made = cls.__new__(cls)
        made._load(*state)
        return made

    def encode(self, sents: list[str]) -> tuple[list[int], list[float], list[int], list[float]]:
        """Known features of a text's sentences, their term frequency weights, how many each sentence has, and the sum of
        squares of the weights of its unknown features."""
        return encode(self.vocab, sents)

    def raw(self, ids: np.ndarray, tfs: np.ndarray, lens: np.ndarray, unknown: np.ndarray, without_self: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vote of each sentence, its nearest abusive example and the cosine; sentences are consecutive runs of ``lens`` features.

        A sentence whose bound over the blocks of abusive examples is below LEAST_COSINE has no abusive example near, so
        its vote is 0 and it is not looked up among the others.
        """
        n = len(lens)
        vote, near, cos = np.zeros(n), np.full(n, -1), np.zeros(n)
        starts = np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64)
        w = tfs * self.idf[ids]
        square = np.bincount(np.repeat(np.arange(n), lens), w * w, n) if len(ids) else np.zeros(n)
        norm = np.sqrt(square + unknown * self.unknown**2)
        w = (w / np.repeat(np.maximum(norm, 1e-9), lens)).astype(np.float32)
        have = np.nonzero(lens > 0)[0]
        bound = np.zeros(n)
        if len(have):
            bound[have] = np.add.reduceat(w * self.abusive_most[ids], starts[have])
        for at in range(0, n, SLICE):
            pick = np.nonzero(bound[at : at + SLICE] >= LEAST_COSINE)[0] + at
            if not len(pick):
                continue
            # a closer bound, the best of the abusive blocks instead of the best of each term, and then the blocks themselves
            take, new, _ = _take(pick, starts, lens)
            bounds = np.add.reduceat(self.abusive[ids[take]] * w[take][:, None], new, axis=0)
            close = np.zeros(len(pick), bool)
            for i, b in enumerate(self.abusive_blocks):
                asked = np.nonzero(~close & (bounds[:, i] >= LEAST_COSINE))[0]
                if len(asked):
                    take, new, _ = _take(pick[asked], starts, lens)
                    close[asked] = ((self.index.cosines(b, ids[take], w[take], new) >= LEAST_COSINE) & (self.label_of[b] > 0)).any(axis=1)
            pick = pick[close]
            if not len(pick):
                continue
            take, new, _ = _take(pick, starts, lens)
            found, sims = self.index.search(ids[take], w[take], new, NEIGHBOURS + without_self)
            if without_self:  # an example is its own nearest
                found, sims = found[:, 1:], sims[:, 1:]
            weight = np.where(sims >= LEAST_COSINE, sims, 0) ** 2
            y = self.label[found]
            vote[pick] = (weight * y).sum(axis=1) / (weight.sum(axis=1) + 0.01)
            first = np.where(y > 0, sims, -1).argmax(axis=1)
            rows = np.arange(len(pick))
            hit = y[rows, first] > 0
            near[pick] = np.where(hit, found[rows, first], -1)
            cos[pick] = np.where(hit, sims[rows, first], 0)
        return vote, near, cos

    def of_texts(self, counts: np.ndarray, *sentences_: np.ndarray, without_self: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of each text: its most abusive sentence's. ``counts`` are the texts' numbers of sentences."""
        vote, near, cos = self.raw(*sentences_, without_self=without_self)
        n = len(counts)
        score, best = np.zeros(n), np.full(n, -1)
        owner = np.repeat(np.arange(n), counts)
        order = np.lexsort((-np.arange(len(vote)), vote, owner))  # the last of each owner is its highest, the earlier of equals
        last = np.nonzero(np.append(owner[order][1:] != owner[order][:-1], True))[0] if len(order) else order
        best[owner[order][last]] = order[last]
        ok = best >= 0
        score[ok] = vote[best[ok]]
        return score, np.where(ok & (score > 0), near[best], -1) if len(near) else best, np.where(ok & (score > 0), cos[best], 0) if len(cos) else score

    def calibrate(self, labelled: list[tuple[str, int]]) -> None:
        """Monotone map from votes to the share of labelled texts with such votes that are abusive (pooled adjacent violators).
        A text's own sentences may be among the examples, so each sentence's nearest example is left out."""
        score, _, _ = self.of_texts(*pack([encode(self.vocab, parts(t)) for t, _ in labelled]), without_self=True)
        pools: list[list[float]] = []
        for s, y in sorted(zip(score.tolist(), [y for _, y in labelled], strict=True)):
            pools.append([s, float(y), 1.0])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                s1, y1, n1 = pools.pop()
                pools[-1][1] += y1
                pools[-1][2] += n1
                pools[-1][0] = s1
        self.bins = (np.array([p[0] for p in pools]), np.array([p[1] / p[2] for p in pools]))

    def score(self, *packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw, near, cos = self.of_texts(*packed)
        if self.bins is not None and len(self.bins[0]):
            raw = np.where(raw > 0, np.interp(raw, *self.bins), 0.0)
        return raw, near, cos


def _take(pick: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the picked runs' items laid end to end, where each run then starts, and the runs' sizes."""
    sizes = lens[pick]
    new = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    return np.repeat(starts[pick] - new, sizes) + np.arange(sizes.sum()), new, sizes


def encode(vocab: dict[str, int], sents: list[str]) -> tuple[list[int], list[float], list[int], list[float]]:
    """Known features of the sentences, their term frequency weights, how many each sentence has, and the unknown ones' squares."""
    ids, tfs, lens, unknown = [], [], [], []
    get = vocab.get
    for s in sents:
        fs = features(s)
        n, u = 0, 0.0
        if len(set(fs)) == len(fs):
            known = [t for t in map(get, fs) if t is not None]
            n, u = len(known), float(len(fs) - len(known))
            ids += known
            tfs += [1.0] * n
        else:
            for f, k in Counter(fs).items():
                t, w = get(f), 1.0 if k == 1 else 1 + log(k)
                if t is None:
                    u += w * w
                else:
                    ids.append(t)
                    tfs.append(w)
                    n += 1
        lens.append(n)
        unknown.append(u)
    return ids, tfs, lens, unknown


class Encoder:
    """:func:`encode` of many texts at once: words are numbered by their dictionary in Arrow, the rest is arithmetic."""

    def __init__(self, vocab: list[str]):
        self.vocab = {f: i for i, f in enumerate(vocab)}
        self.size = max(1, len(vocab))
        pairs = sorted((self.vocab[a] * self.size + self.vocab[b], i) for f, i in self.vocab.items() if " " in f for a, b in [f.split(" ")])
        self.pair_keys = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.pair_ids = np.array([i for _, i in pairs] or [-1], np.int64)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """What :func:`pack` makes of the texts' encodings."""
        plain_ = [fold(_one_line(t)) if t else "" for t in texts]
        for i in np.flatnonzero(disguised(plain_)).tolist():
            plain_[i] = _bare(plain_[i])
        counts, words, per = [], [], []
        for text in plain_:
            n = 0
            for s in sentences(text) if text else ():
                if s.strip():
                    got = _words(s)
                    words += got
                    per.append(len(got))
                    n += 1
            counts.append(n)
        per = np.array(per, np.int64)
        n, empty = len(per), np.zeros(0, np.int64)
        if not words:
            return np.array(counts, np.int64), empty, empty.astype(np.float64), np.zeros(n, np.int64), np.zeros(n)
        coded = pa.array(words, pa.string()).dictionary_encode()
        kinds = ["0" if w.isdigit() else w for w in coded.dictionary.to_pylist()]
        first: dict[str, int] = {}
        same = np.array([first.setdefault(w, i) for i, w in enumerate(kinds)], np.int64)
        known = np.array([self.vocab.get(w, -1) for w in kinds], np.int64)
        word = same[coded.indices.to_numpy()]
        owner = np.repeat(np.arange(n), per)
        m = len(kinds)
        if n * m * (m + 1) >= 1 << 62:  # too much for one number: text by text
            return pack([encode(self.vocab, parts(t)) for t in texts])
        beside = np.flatnonzero(owner[1:] == owner[:-1])
        a, b = word[beside], word[beside + 1]
        at = np.minimum(np.searchsorted(self.pair_keys, known[a] * self.size + known[b]), len(self.pair_keys) - 1)
        pair = np.where((known[a] >= 0) & (known[b] >= 0) & (self.pair_keys[at] == known[a] * self.size + known[b]), self.pair_ids[at], -1)
        ids = np.concatenate([known[word], pair])
        keys = np.concatenate([word, m + a * m + b])
        owners = np.concatenate([owner, owner[beside]])
        told = ids >= 0
        each, k = np.unique(owners[told] * self.size + ids[told], return_counts=True)
        _, place, j = np.unique(owners[~told] * (m + m * m) + keys[~told], return_index=True, return_counts=True)
        unknown = np.bincount(owners[~told][place], (1 + np.log(j)) ** 2, n)
        return np.array(counts, np.int64), each % self.size, 1 + np.log(k), np.bincount(each // self.size, minlength=n), unknown


def pack(encoded: list[tuple]) -> tuple[np.ndarray, ...]:
    """Encoded texts laid end to end: sentences of each text, then the four arrays of all sentences."""
    flat = lambda i, kind: np.array([x for e in encoded for x in e[i]], kind)
    return np.array([len(e[2]) for e in encoded], np.int64), flat(0, np.int64), flat(1, np.float64), flat(2, np.int64), flat(3, np.float64)


def labelled_sample(texts: DataFrame, key: str, text: str, labels: DataFrame, label: str) -> list[tuple[str, int]]:
    """At most LABELLED_PER_CLASS texts of each class with their label, the same for any order of the rows.

    A text judged several times has the label of the majority; ties, null labels and texts that are missing are left out.
    """
    judged = labels.where(f"{key} is not null and {label} in (0, 1)").groupBy(key).agg(F.avg(label).alias("mean")).where("mean <> 0.5").select(key, (F.col("mean") > 0.5).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in judged.groupBy("y").count().collect()}
    few = None
    for y, n in counts.items():
        slot = F.pmod(F.xxhash64(key), F.lit(1_000_000))
        some = judged.where((F.col("y") == y) & (slot < min(1_000_000, 1_500_000 * LABELLED_PER_CLASS // n))).orderBy(F.xxhash64(key), key).limit(LABELLED_PER_CLASS)
        few = some if few is None else few.unionByName(some)
    if few is None:
        return []
    found = texts.select(key, F.col(text).alias("text")).join(F.broadcast(few), key).where("text is not null").groupBy(key, "y").agg(F.min("text").alias("text"))
    return [(r["text"], r["y"]) for r in found.orderBy(key).collect()]


def _encoded(df: DataFrame, text: str, keep: list[str], vocab: list[str]) -> tuple[DataFrame, dict[int, int], int]:
    """The texts' features by number, written once, with document frequencies over all rows and the number of rows.

    Every task writes its texts' rows and one last row of counts (``n`` not null), so texts are read and cut only once.
    """
    held = df.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, counts, n = Encoder(held.value), np.zeros(len(held.value), np.int64), 0
        for batch in batches:
            m = batch.num_columns - 1
            per, ids, tfs, lens, unknown = cut(batch.column(m).to_pylist())
            text_of = np.repeat(np.arange(len(per)), per)
            if len(ids):
                counts += np.bincount(np.unique(np.repeat(text_of, lens) * cut.size + ids) % cut.size, minlength=len(counts))
            n += len(per)
            starts = np.concatenate([[0], np.cumsum(np.bincount(text_of, lens, len(per)).astype(np.int64))])
            cols = [_lists(starts, ids, pa.int32()), _lists(starts, tfs, pa.float32()), *(_lists(np.concatenate([[0], np.cumsum(per)]), x, k) for x, k in ((lens, pa.int32()), (unknown, pa.float32())))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(m)), *cols, pa.nulls(len(per), pa.int64())], [*batch.schema.names[:m], *_COLUMNS, "n"])
            kinds = [batch.column(i).type for i in range(m)]
        if n:
            ids = np.nonzero(counts)[0]
            last = [*(pa.nulls(1, k) for k in kinds), pa.array([ids.tolist()], pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.float32())), pa.array([counts[ids].tolist()], pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.float32())), pa.array([n], pa.int64())]
            yield pa.RecordBatch.from_arrays(last, [*batch.schema.names[:m], *_COLUMNS, "n"])

    kinds_of = dict(df.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds_of[k]}" for k in keep), "ids array<int>, tfs array<float>, lens array<int>, unknown array<float>, n long"])
    made = materialize(df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema), "features")
    tail = made.where("n is not null")
    sums = tail.select(F.explode(F.arrays_zip("ids", "lens")).alias("z")).groupBy("z.ids").agg(F.sum("z.lens").alias("n")).collect()
    total = tail.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return made.where("n is null").drop("n"), {r[0]: r[1] for r in sums}, total


def _lists(starts: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values).cast(kind))


_COLUMNS = ("ids", "tfs", "lens", "unknown")
_SCORERS: dict[str, Scorer] = {}


def scores(df: DataFrame, text: str, keep: list[str], labelled: list[tuple[str, int]]) -> DataFrame:
    """``keep`` columns with ``score`` (the calibrated share of such texts that are abusive), ``evidence`` (the nearest abusive
    example sentence, undisguised) and ``cosine`` of every row's text.

    Document frequencies are those of all rows. Null and empty texts score 0 without evidence; without labelled texts of
    both classes all score 0. Texts are read whole; repeated rows give repeated rows.
    """
    examples = choose(labelled) if {y for _, y in labelled} == {0, 1} else []
    vocab = sorted({f for s, _ in examples for f in features(s)})
    rows, counts, n = _encoded(df, text, keep, vocab)
    by_name = {vocab[i]: k for i, k in counts.items()}
    scorer = Scorer(examples, by_name, n)
    scorer.calibrate(labelled)
    mark = hashlib.blake2b(repr((examples, sorted(counts.items()), n)).encode()).hexdigest()
    held = df.sparkSession.sparkContext.broadcast((mark, scorer.state()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = held.value
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer.of_state(state)
        s = _SCORERS[key]
        for batch in batches:
            m = batch.num_columns - 4
            ids, tfs, lens, unknown = (batch.column(m + i) for i in range(4))
            per = np.diff(lens.offsets.to_numpy())
            flat = lambda c, kind: c.flatten().to_numpy(zero_copy_only=False).astype(kind)
            value, near, cos = s.score(per, flat(ids, np.int64), flat(tfs, np.float64), flat(lens, np.int64), flat(unknown, np.float64))
            said = pa.DictionaryArray.from_arrays(pa.array(near, pa.int32(), mask=near < 0), pa.array([t for t, _ in s.examples], pa.string())).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(m)), pa.array(value, pa.float64()), said, pa.array(cos, pa.float64())], [*batch.schema.names[:m], "score", "evidence", "cosine"])

    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "score double, evidence string, cosine double"])
    return rows.mapInArrow(run, schema)
