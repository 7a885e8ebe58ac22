"""Evaluation texts that leaked into training texts (problem 8).

Latent semantic retrieval. The corpus's passages are runs of words of the evaluation vocabulary, and for paraphrases
windows of a sentence's length. A distributed randomised SVD of the TF-IDF vectors of runs gives a latent space;
passages whose cosine with an evaluation passage is high are candidates; exact runs, or the longest common subsequence
and the answer's rare words, decide.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.words import runs
from tessera.session import materialize

#: Consecutive words that make a leak, and foreign words that a stretch may hold between two of its own.
RUN_WORDS, GAP = 8, 2
#: Rank of the latent space and columns drawn beyond it.
RANK, EXTRA = 64, 16
#: Cosine from which a passage is a candidate: for runs of the same words, and for paraphrased sentences.
COSINE_RUN, COSINE_PARAPHRASE = 0.95, 0.6
#: Share of a sentence's words that its paraphrase keeps in order, and of its rarest words ("answer") that it names.
KEPT_ORDER, KEPT_ANSWER = 0.6, 0.6
#: Known words of the shortest paraphrase.
LEAST_KEPT = math.ceil(KEPT_ORDER * RUN_WORDS)
#: Every worker holds the evaluation items of one block, at most about so many and so many characters; larger sets take several.
MOST_ITEMS, MOST_CHARS = 50_000, 50_000_000
#: A query looks into every cell of the quantiser whose centre is as near as the nearest, but for rounding.
SAME_CELL = 1e-3


class EvalIndex:
    """Vocabulary, runs and sentences of the evaluation items."""

    def __init__(self, items: list[tuple[str, str]]):
        self.vocab: dict[str, int] = {}
        at: dict[tuple[int, ...], set[str]] = defaultdict(set)
        sentences: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for key, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in runs(text)]
            for k in range(len(ids) - RUN_WORDS + 1):
                at[tuple(ids[k : k + RUN_WORDS])].add(key)
            for s in re.split(r"(?<=[.!?।۔])\s+", text):
                words = tuple(self.vocab[w] for w in runs(s) if w in self.vocab)
                if len(words) >= RUN_WORDS:
                    sentences[words].add(key)
        self.run_ids = np.array(sorted(at), np.int32).reshape(-1, RUN_WORDS)
        self.run_keys = [sorted(at[tuple(r)]) for r in self.run_ids.tolist()]
        self.sentences = sorted(sentences)
        self.sentence_keys = [sorted(sentences[s]) for s in self.sentences]
        # words of like weight have the cosine only in windows up to this length, unknown ones in between counted too
        self.window = [math.ceil(len(s) / COSINE_PARAPHRASE**2) for s in self.sentences]
        self.longest = max(self.window, default=GAP)


def _stretches(ids: np.ndarray, least: int = RUN_WORDS, gap: int = GAP) -> list[tuple[int, np.ndarray]]:
    """Start and ids of the stretches with at least ``least`` known words and at most ``gap`` unknown ones (-1) in a row."""
    at = np.flatnonzero(ids >= 0)
    if len(at) < least:
        return []
    ends = np.append(np.flatnonzero(np.diff(at) > gap + 1), len(at) - 1)
    starts = np.append(0, ends[:-1] + 1)
    return [(int(at[a]), ids[at[a] : at[b] + 1]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True) if b - a + 1 >= least]


_PASSAGES = pa.schema([("key", pa.string()), ("start", pa.int64()), ("ids", pa.list_(pa.int32())), ("df", pa.list_(pa.int64()))])


def _passages(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        vocab, size = index.vocab, len(index.vocab)
        df, docs = np.zeros(size, np.int64), 0
        get = vocab.get
        for batch in batches:
            keys, starts, out = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                docs += 1
                if not text:
                    continue
                words = runs(text)
                ids = np.fromiter(map(get, words, itertools.repeat(-1)), np.int32, len(words))
                seen = np.unique(ids)
                df[seen[seen >= 0]] += 1
                for start, s in _stretches(ids, LEAST_KEPT, index.longest):
                    keys.append(key)
                    starts.append(start)
                    out.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(starts, pa.int64()), pa.array(out, pa.list_(pa.int32())), pa.nulls(len(keys), pa.list_(pa.int64()))], schema=_PASSAGES)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.array([docs], pa.int64()), pa.nulls(1, pa.list_(pa.int32())), pa.array([df.tolist()], pa.list_(pa.int64()))], schema=_PASSAGES)

    return run


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a batch's passages end to end, and where each passage begins (and the last one ends)."""
    return column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(column).to_numpy())]).astype(np.int64)


def _windows(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All runs of RUN_WORDS known words inside passages, and the passage of each."""
    if len(flat) < RUN_WORDS:
        return np.zeros((0, RUN_WORDS), np.int32), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    known = np.concatenate([[0], np.cumsum(flat >= 0)])
    at = np.flatnonzero((known[RUN_WORDS:] - known[:-RUN_WORDS] == RUN_WORDS) & (owner[: len(flat) - RUN_WORDS + 1] == owner[RUN_WORDS - 1 :]))
    return np.lib.stride_tricks.sliding_window_view(flat, RUN_WORDS)[at], owner[at]


def _sum_blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            a = np.frombuffer(blob, np.float32)
            total = a.astype(np.float64) if total is None else total + a
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float32).tobytes()], pa.binary())], ["part"])


def _gather(passages: DataFrame, part, shape: tuple[int, int]) -> np.ndarray:
    """Sum of the matrices that ``part`` makes of the windows. There is one for each of about as many tasks as there are cores,
    however many partitions the passages have; they are summed in a tree, so the driver gets at most 4."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            w = _windows(*_flat(batch.column(0)))[0]
            if len(w):
                total += part(w)
        yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float32).tobytes()], pa.binary())], ["part"])

    cores = passages.sparkSession.sparkContext.defaultParallelism
    parts = passages.select("ids").coalesce(2 * cores).mapInArrow(run, "part binary")
    n = 2 * cores
    while n > 4:
        n = max(4, n // 16)
        parts = parts.repartition(n).mapInArrow(_sum_blobs, "part binary")
    return sum((np.frombuffer(bytes(r[0]), np.float32).reshape(shape).astype(np.float64) for r in parts.collect()), np.zeros(shape))


def latent_space(passages: DataFrame, own: np.ndarray, idf: np.ndarray, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """Word coordinates (vocabulary x rank) of the randomised SVD of the TF-IDF matrix of all passages and evaluation runs.

    Two passes: A'A times a random matrix gives the range, A'A within that range its singular vectors. Only matrices
    of the evaluation vocabulary's size leave the workers.
    """
    size = len(idf)
    cols = min(rank + EXTRA, size)
    omega = np.random.default_rng(seed).standard_normal((size, cols))

    def rows(w: np.ndarray, m: np.ndarray) -> np.ndarray:
        return (m * idf[:, None])[w].sum(axis=1)

    def spread(w: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = np.zeros((size, y.shape[1]))
        for k in range(RUN_WORDS):
            np.add.at(out, w[:, k], y)
        return out * idf[:, None]

    def first(w: np.ndarray) -> np.ndarray:
        return spread(w, rows(w, omega))

    q = np.linalg.qr(_gather(passages, first, (size, cols)) + first(own))[0]

    def second(w: np.ndarray) -> np.ndarray:
        y = rows(w, q)
        return y.T @ y

    values, u = np.linalg.eigh(_gather(passages, second, (cols, cols)) + second(own))
    return (q @ u[:, np.argsort(-values)[:rank]]).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


class Quantiser:
    """Unit vectors in cells around centres, about as many as the cells have members, so that a query meets the centres and one
    cell instead of all vectors. Equal vectors are in one cell, so none is missed among those that equal the query."""

    def __init__(self, x: np.ndarray, rounds: int = 4, seed: int = 7):
        self.x = x
        k = max(1, math.isqrt(len(x)))
        self.centres = x[np.sort(np.random.default_rng(seed).choice(len(x), k, replace=False))] if len(x) else x
        for _ in range(rounds if len(x) else 0):
            sums = np.zeros_like(self.centres, np.float64)
            np.add.at(sums, self._nearest(x), x)
            alive = np.linalg.norm(sums, axis=1) > 0
            self.centres = _unit(np.where(alive[:, None], sums, self.centres)).astype(np.float32)
        cell = self._nearest(x) if len(x) else np.zeros(0, np.int64)
        self.members = [np.flatnonzero(cell == c) for c in range(len(self.centres))]

    def _nearest(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([(x[at : at + 4096] @ self.centres.T).argmax(axis=1) for at in range(0, len(x), 4096)])

    def near(self, q: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Queries, vectors and cosines of the pairs of a cell that reach ``least``."""
        for at in range(0, len(q), 4096):
            sims = q[at : at + 4096] @ self.centres.T
            who, cell = np.nonzero(sims >= sims.max(axis=1, keepdims=True) - SAME_CELL)
            order = np.argsort(cell, kind="stable")
            who, cell = who[order], cell[order]
            for part in np.split(np.arange(len(cell)), np.flatnonzero(np.diff(cell)) + 1):
                if len(part):
                    mine, some = self.members[cell[part[0]]], who[part] + at
                    cos = q[some] @ self.x[mine].T
                    i, j = np.nonzero(cos >= least)
                    yield some[i], mine[j], cos[i, j]


def lcs(a: list[int], b: tuple[int, ...]) -> int:
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


class Paraphrases:
    """Sentences that recur in a text within a window of their length, with gaps and changes.

    A passage reaches from one of the sentence's words to another, is no longer than the window and must name enough of the
    answer, so only surroundings of answer words are looked at: all passages that can pass are tried.
    """

    def __init__(self, index: EvalIndex, weighted: np.ndarray, sents_at: np.ndarray, answers: list[set[int]]):
        self.index, self.weighted, self.sents_at, self.answers = index, weighted, sents_at, answers
        self.words = [np.array(sorted(set(s)), np.int32) for s in index.sentences]
        self.window = np.array(index.window, np.int64)
        self.least_answer = np.array([max(1, math.ceil(KEPT_ANSWER * len(a) - 1e-9)) for a in answers], np.int64)
        self.least_kept = [math.ceil(KEPT_ORDER * len(s) - 1e-9) for s in index.sentences]
        pairs = np.array(sorted((w, j) for j, a in enumerate(answers) for w in a), np.int64).reshape(-1, 2)
        self.sents = pairs[:, 1]
        self.first = np.searchsorted(pairs[:, 0], np.arange(len(weighted) + 1))

    def regions(self, flat: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Sentence, start and end of the places whose windows hold enough of its answer words."""
        pos = np.flatnonzero(flat >= 0)
        w = flat[pos]
        n = self.first[w + 1] - self.first[w]
        pos, w, n = pos[n > 0], w[n > 0], n[n > 0]
        if not len(pos):
            return
        at = np.repeat(pos, n)
        sent = self.sents[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[w], n)]
        order = np.lexsort((at, sent))
        at, sent = at[order], sent[order]
        last = np.arange(len(at)) + self.least_answer[sent] - 1
        inside = np.flatnonzero(last < len(at))
        inside = inside[(sent[last[inside]] == sent[inside]) & (at[last[inside]] - at[inside] < self.window[sent[inside]])]
        s, size = sent[inside], self.window[sent[inside]]
        begin, end = np.maximum(at[last[inside]] - size + 1, 0), np.minimum(at[inside] + size, len(flat))
        if not len(s):
            return
        new = np.r_[True, (s[1:] != s[:-1]) | (begin[1:] > end[:-1])]
        yield from zip(s[new].tolist(), begin[new].tolist(), end[np.r_[new[1:], True]].tolist(), strict=True)

    def find(self, ids: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """Stretch, sentence, words kept in order and cosine of the passages that pass, of stretches laid end to end."""
        starts = firsts + np.arange(len(firsts)) * self.index.longest  # unknown words keep the stretches apart
        flat = np.full(int(starts[-1]), -1, np.int64)
        flat[np.arange(len(ids)) + np.repeat(starts[:-1] - firsts[:-1], np.diff(firsts))] = ids
        for j, begin, end in self.regions(flat):
            part, least, size = flat[begin:end], self.least_kept[j], int(self.window[j])
            mine = np.flatnonzero(np.isin(part, self.words[j]))
            if len(mine) < least:
                continue
            first = np.flatnonzero(mine[least - 1 :] - mine[: len(mine) - least + 1] < size)
            if not len(first):
                continue
            sums, sentence = None, self.index.sentences[j]
            kept = part[mine].tolist()
            stretch = np.searchsorted(starts, begin + mine[first], "right") - 1
            tried: set[tuple[int, bytes]] = set()
            for a, which in zip(first.tolist(), stretch.tolist(), strict=True):
                # texts that repeat themselves have few different windows
                window = (which, part[mine[a] : mine[a] + size].tobytes())
                if window in tried:
                    continue
                tried.add(window)
                row, named = [0] * (len(sentence) + 1), set()
                for b in range(a, len(mine)):
                    if mine[b] - mine[a] >= size:
                        break
                    x, diagonal = kept[b], 0
                    for k, y in enumerate(sentence, 1):
                        diagonal, row[k] = row[k], diagonal + 1 if x == y else max(row[k], row[k - 1])
                    if x in self.answers[j]:
                        named.add(x)
                    if row[-1] >= least and len(named) >= self.least_answer[j]:
                        if sums is None:
                            each = np.where((part >= 0)[:, None], self.weighted[np.maximum(part, 0)], 0)
                            sums = np.vstack([np.zeros_like(each[:1]), each.cumsum(axis=0)])
                        v = sums[mine[b] + 1] - sums[mine[a]]
                        cos = float(v @ self.sents_at[j] / max(np.linalg.norm(v), 1e-12))
                        if cos >= COSINE_PARAPHRASE:
                            yield which, j, row[-1], cos


class Judge:
    """Candidates by cosine in the latent space, then the exact run or the paraphrase test."""

    def __init__(self, index: EvalIndex, words: np.ndarray, idf: np.ndarray):
        self.index = index
        self.weighted = weighted = words * idf[:, None].astype(np.float32)
        self.runs = Quantiser(self.vectors(index.run_ids))
        sents_at = _unit(np.array([weighted[list(s)].sum(axis=0) for s in index.sentences], np.float32)) if index.sentences else np.zeros((0, words.shape[1]), np.float32)
        answers = [set(sorted(set(s), key=lambda w: (-idf[w], w))[: max(2, len(set(s)) // 4)]) for s in index.sentences]
        self.paraphrases = Paraphrases(index, weighted, sents_at, answers)

    def vectors(self, windows: np.ndarray) -> np.ndarray:
        """Unit vectors of runs of words, added word by word, so that equal runs have equal vectors."""
        out = np.zeros((len(windows), self.weighted.shape[1]), np.float32)
        for k in range(RUN_WORDS if len(windows) else 0):
            out += self.weighted[windows[:, k]]
        return _unit(out)

    def __call__(self, keys: list[str], flat: np.ndarray, starts: np.ndarray) -> list[tuple[str, str, str, int, float]]:
        """Hits of passages laid end to end."""
        found: dict[tuple[str, str, str], tuple[int, float]] = {}
        every, owner = _windows(flat, starts)
        if len(every) and len(self.index.run_ids):
            kinds, back = np.unique(every, axis=0, return_inverse=True)
            order = np.argsort(back.ravel(), kind="stable")
            firsts = np.searchsorted(back.ravel()[order], np.arange(len(kinds) + 1))
            for i, j, cos in self.runs.near(self.vectors(kinds), COSINE_RUN):
                same = (kinds[i] == self.index.run_ids[j]).all(axis=1)
                for a, b, c in zip(i[same].tolist(), j[same].tolist(), cos[same].tolist(), strict=True):
                    for o in sorted(set(owner[order[firsts[a] : firsts[a + 1]]].tolist())):
                        for e in self.index.run_keys[b]:
                            n, most = found.get((keys[o], e, "run"), (0, 0.0))
                            found[keys[o], e, "run"] = (n + 1, max(most, c))
        for i, j, n, cos in self.paraphrases.find(flat, starts):
            for e in self.index.sentence_keys[j]:
                old = found.get((keys[i], e, "paraphrase"), (0, 0.0))
                found[keys[i], e, "paraphrase"] = max(old, (n, cos))
        return [(*k, *v) for k, v in sorted(found.items())]


def _decide(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(*held.value)
        for batch in batches:
            rows = judge(batch.column(0).to_pylist(), *_flat(batch.column(1)))
            cols = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.string(), pa.int64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(cols, ["key", "eval_id", "kind", "words", "cosine"])

    return run


def leaks(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """``(key, eval_id, kind, words, cosine)``: the items whose passages occur in each text.

    ``kind`` is ``run`` where at least RUN_WORDS consecutive words are the item's (``words`` counts such runs), or
    ``paraphrase`` where a sentence's words recur in order with gaps (``words`` of them). Case, punctuation, spacing,
    invisible characters and compatible Unicode forms make no difference. Items with a null id or text, or fewer than
    RUN_WORDS words, have no runs; null and empty texts hold none; repeated items count once; extra columns are ignored. A
    set that is too large for the workers is screened in blocks of items, each against all texts.
    """
    chosen = items.select(F.col(item_key).alias("id"), F.col(item_text).alias("text")).where("id is not null and text is not null").distinct()
    size = chosen.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-size[0] // MOST_ITEMS), -(-size[1] // MOST_CHARS))
    slim = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    hits = None
    for block in range(blocks):
        mine = chosen if blocks == 1 else chosen.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        some = _leaks_of_block(slim, [(r["id"], r["text"]) for r in mine.collect()])
        hits = some if hits is None else hits.unionByName(some)
    best = hits.groupBy("key", "eval_id", "kind").agg(F.when(F.col("kind") == "run", F.sum("words")).otherwise(F.max("words")).alias("words"), F.max("cosine").alias("cosine"))
    return best.withColumn("key", F.col("key").cast(dict(docs.dtypes)[key])).withColumnRenamed("key", key)


def _leaks_of_block(slim: DataFrame, items: list[tuple[str, str]]) -> DataFrame:
    """Hits of one block of items in all texts."""
    spark = slim.sparkSession
    index = EvalIndex(items)
    made = materialize(slim.mapInArrow(_passages(spark.sparkContext.broadcast(index)), "key string, start long, ids array<int>, df array<long>"), "passages")
    n = made.where("df is not null").agg(F.coalesce(F.sum("start"), F.lit(0))).first()[0]
    counts = {r["pos"]: r["n"] for r in made.where("df is not null").select(F.posexplode("df").alias("pos", "n")).groupBy("pos").agg(F.sum("n").alias("n")).collect()}
    df = np.array([counts.get(i, 0) for i in range(len(index.vocab))], np.float64)
    idf = np.log((n + 1) / (df + 1)) + 1
    passages = made.where("ids is not null").select("key", "ids")
    words = latent_space(passages, index.run_ids, idf) if len(index.run_ids) else np.zeros((len(idf), 1), np.float32)
    return passages.mapInArrow(_decide(spark.sparkContext.broadcast((index, words, idf))), "key string, eval_id string, kind string, words long, cosine double")
