"""Character trigram language models: training, bits per character, cutoffs."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.percentiles import percentiles
from tessera.session import materialize

# Smoothing, caps of a model, probe and least length, and the least number of scored documents for a cutoff.
ADD_K, MAX_CONTEXTS, MAX_NEXT, PROBE_CHARS, MIN_CHARS, MIN_SCORED = 0.1, 100_000, 64, 512, 12, 200
#: Rows of a model that is sent to every worker; a larger one is joined by shuffle.
BROADCAST_ROWS = 2_000_000
#: Distinct trigrams that a training task holds before it hands its counts on.
HELD_TRIGRAMS = 1_000_000


def padded(text: str) -> str:
    """The text without outer blanks, between one blank on each side."""
    return f" {text.strip(' ')} "


def _grams(text: str) -> list[str]:
    return [text[i : i + 3] for i in range(len(text) - 2)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams and single characters of a partition's texts, counted by language before anything is shuffled."""
    counts: dict[str, Counter] = {}

    def hand_on() -> pa.RecordBatch:
        rows = [(lang, g, n) for lang, c in counts.items() for g, n in c.items()]
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], ["lang", "gram", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            t = padded(text)
            c = counts.setdefault(lang, Counter())
            c.update(_grams(t))
            c.update(t)
        if sum(map(len, counts.values())) > HELD_TRIGRAMS:
            yield hand_on()
    yield hand_on()


def train(docs: DataFrame, lang: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``(trigram, unigram)`` counts per language. Contexts and continuations beyond the caps are left out, ties in order of
    the characters. Null languages and texts do not train. Texts are counted whole, once."""
    d = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = materialize(d.mapInArrow(_count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    tri = counts.where(F.length("gram") == 3).select("lang", F.substring("gram", 1, 2).alias("ctx"), F.substring("gram", 3, 1).alias("nxt"), "n")
    totals = tri.groupBy("lang", "ctx").agg(F.sum("n").alias("total"))
    ctx_rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("total"), "ctx"))
    top = totals.withColumn("r", ctx_rank).where(F.col("r") <= MAX_CONTEXTS).select("lang", "ctx")
    next_rank = F.row_number().over(Window.partitionBy("lang", "ctx").orderBy(F.desc("n"), "nxt"))
    kept = tri.withColumn("r", next_rank).where(F.col("r") <= MAX_NEXT).drop("r").join(top, ["lang", "ctx"], "left_semi")
    return materialize(kept, "model"), counts.where(F.length("gram") == 1).select("lang", F.col("gram").alias("ch"), "n")


class Model(dict):
    """Bits of a trigram of one language, worked out once for each trigram that is met."""

    def __init__(self, trigrams: list[tuple[str, str, int]], singles: dict[str, int]):
        super().__init__()
        self.counts = {c + x: n for c, x, n in trigrams}
        self.context: Counter = Counter()
        for c, _, n in trigrams:
            self.context[c] += n
        self.singles, self.all, self.v = singles, sum(singles.values()), max(len(singles), 2)

    def __missing__(self, gram: str) -> float:
        total = self.context.get(gram[:2])
        p = (self.counts.get(gram, 0) + ADD_K) / (total + ADD_K * self.v) if total else (self.singles.get(gram[2], 0) + ADD_K) / (self.all + ADD_K * self.v)
        bits = self[gram] = -log2(p)
        return bits

    def score(self, text: str) -> float | None:
        """Mean bits of the padded text's trigrams; None for texts that are too short."""
        t = padded(text)
        if len(t) < MIN_CHARS:
            return None
        if len(self) > HELD_TRIGRAMS:
            self.clear()
        return sum(map(self.__getitem__, _grams(t))) / (len(t) - 2)


_MODELS: dict[str, dict[str, Model]] = {}


def bits_per_char(docs: DataFrame, key: str, lang: str, text: str, trigram: DataFrame, unigram: DataFrame, probe: int | None = None) -> DataFrame:
    """``(key, lang, bits)`` of every document, or of its first ``probe`` characters; null for texts that are too short or
    whose language has no model.

    A model of up to BROADCAST_ROWS rows is sent to every worker and texts are scored where they are read; with a larger one
    each document's counted trigrams are joined by shuffle.
    """
    part = F.col(text) if probe is None else F.substring(text, 1, probe)
    d = docs.select(F.col(key).alias("key"), F.col(lang).alias("lang"), part.alias("text"))
    if trigram.count() > BROADCAST_ROWS:
        return _bits_by_join(d, trigram, unigram).withColumnRenamed("key", key)
    rows = (trigram.select("lang", "ctx", "nxt", "n").toArrow(), unigram.select("lang", "ch", "n").toArrow())
    held = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, *rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = _models(held)
        for batch in batches:
            pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            bits = [models[g].score(t) if t is not None and g in models else None for g, t in pairs]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.float64())], ["key", "lang", "bits"])

    return d.mapInArrow(run, f"key {dict(d.dtypes)['key']}, lang string, bits double").withColumnRenamed("key", key)


def _models(held) -> dict[str, Model]:
    mark, tri, uni = held.value
    if mark not in _MODELS:
        _MODELS.clear()
        by: dict[str, list] = {}
        ones: dict[str, dict[str, int]] = {}
        for g, c, x, n in zip(*(tri.column(i).to_pylist() for i in range(4)), strict=True):
            by.setdefault(g, []).append((c, x, n))
        for g, c, n in zip(*(uni.column(i).to_pylist() for i in range(3)), strict=True):
            ones.setdefault(g, {})[c] = n
        _MODELS[mark] = {g: Model(by.get(g, []), c) for g, c in ones.items()}
    return _MODELS[mark]


def _bits_by_join(d: DataFrame, trigram: DataFrame, unigram: DataFrame) -> DataFrame:
    """The same for models of any size."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, grams, ns = [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                t = padded(text)
                c = Counter(_grams(t)) if len(t) >= MIN_CHARS else {}
                at += [i] * len(c)
                grams += c.keys()
                ns += c.values()
            rows = batch.take(pa.array(at, pa.int64()))
            cut = lambda a, b: pa.array([g[a:b] for g in grams], pa.string())
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), cut(0, 2), cut(2, 3), pa.array(ns, pa.int64())], ["key", "lang", "ctx", "nxt", "k"])

    grams = d.where("lang is not null and text is not null").mapInArrow(split, f"key {dict(d.dtypes)['key']}, lang string, ctx string, nxt string, k long")
    uni = unigram.groupBy("lang").agg(F.sum("n").alias("all"), F.greatest(F.count("*"), F.lit(2)).alias("v"))
    ctx = trigram.groupBy("lang", "ctx").agg(F.sum("n").alias("t"))
    x = grams.join(F.broadcast(uni), "lang").join(ctx, ["lang", "ctx"], "left").join(trigram.withColumnRenamed("n", "c"), ["lang", "ctx", "nxt"], "left")
    x = x.join(unigram.select("lang", F.col("ch").alias("nxt"), F.col("n").alias("u")), ["lang", "nxt"], "left")
    k = F.lit(ADD_K)
    p = F.when(F.col("t").isNotNull(), (F.coalesce("c", F.lit(0)) + k) / (F.col("t") + k * F.col("v"))).otherwise((F.coalesce("u", F.lit(0)) + k) / (F.col("all") + k * F.col("v")))
    scored = x.groupBy("key").agg((F.sum(-F.log2(p) * F.col("k")) / F.sum("k")).alias("bits"))
    return d.select("key", "lang").join(scored, "key", "left")


def distribution(scored: DataFrame, group: str) -> DataFrame:
    """Count, mean, percentiles and maximum of the scores of each group; exact percentiles with interpolation."""
    d = scored.where("bits is not null")
    plain = d.groupBy(group).agg(F.count("*").alias("scored"), F.avg("bits").alias("mean"), F.max("bits").alias("max"))
    return _beside(plain, percentiles(d, group, "bits", {"p50": 0.5, "p90": 0.9, "p99": 0.99}), group).select(group, "scored", "mean", "p50", "p90", "p99", "max")


def _beside(left: DataFrame, right: DataFrame, group: str) -> DataFrame:
    """Rows of two tables with one row a group, null being a group."""
    other = right.withColumnRenamed(group, "_g")
    return left.join(other, left[group].eqNullSafe(other["_g"])).drop("_g")


def cutoffs(scored: DataFrame, group: str, at: float = 0.99, min_scored: int = MIN_SCORED) -> DataFrame:
    """Cutoff of each group with enough scored documents; null, and so no filter, for the others."""
    d = scored.where("bits is not null")
    both = _beside(d.groupBy(group).agg(F.count("*").alias("scored")), percentiles(d, group, "bits", {"p": at}), group)
    return both.select(group, "scored", F.when(F.col("scored") >= min_scored, F.col("p")).alias("cutoff"))
