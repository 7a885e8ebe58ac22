"""Screening of documents against evaluation items by shared word runs and contained items."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.binding import let
from tessera.functions.words import folded, normalize_words, words_of

# Words of a run, characters of an item that is looked for as a whole, and of an item that is kept.
GRAM, FULL_CHARS, ITEM_CHARS = 8, 40, 40
#: Items that a screening holds on every worker; more are screened in blocks.
MOST_ITEMS = 100_000


def grams(df: DataFrame, words: str, n: int = GRAM) -> DataFrame:
    """A row for every run of n words, with its position from 0; shorter texts give none."""
    runs = let(F.col(words), lambda ws: F.transform(F.sequence(F.lit(1), F.size(ws) - (n - 1)), lambda i: F.concat_ws(" ", F.slice(ws, i, n))))
    return df.where(F.size(words) >= n).select("*", F.posexplode(runs).alias("at", "gram"))


def normalised_items(items: DataFrame, key: str, text: str) -> DataFrame:
    """Words and joined words of the items; items with a null id or text are left out."""
    out = items.select(F.col(key).alias("eval_id"), F.col(text).alias("_t")).where("eval_id is not null and _t is not null").distinct()
    return out.withColumn("words", words_of(folded(F.col("_t")))).withColumn("full", F.concat_ws(" ", "words")).drop("_t")


class ItemIndex:
    """Runs of GRAM words of the items by their words, and whole items by one of their inner words."""

    def __init__(self, items: list[tuple[str, list[str]]]):
        self.runs: dict[tuple[str, ...], set[str]] = {}
        self.inner: dict[str, list[tuple[str, str]]] = {}
        self.anywhere: list[tuple[str, str]] = []
        for key, words in items:
            for i in range(len(words) - GRAM + 1):
                self.runs.setdefault(tuple(words[i : i + GRAM]), set()).add(key)
            full = " ".join(words)
            if len(full) >= FULL_CHARS:
                # where the item is contained, all but its outer words are words of the document
                if len(words) > 2:
                    self.inner.setdefault(max(words[1:-1], key=lambda w: (len(w), w)), []).append((key, full))
                else:
                    self.anywhere.append((key, full))
        self.words = frozenset(w for run in self.runs for w in run)

    def hits(self, words: list[str]) -> list[tuple[str, str, str | None]]:
        """``(eval_id, kind, gram)`` of one document's words."""
        seen, joined, out = set(words), None, {}
        for key, full in [*self.anywhere, *(x for w in seen.intersection(self.inner) for x in self.inner[w])]:
            joined = " ".join(words) if joined is None else joined
            if full in joined:
                out[key] = ("exact", None)
        if not self.words.isdisjoint(seen):
            lived = 0  # known words up to here without a gap
            for i, w in enumerate(words):
                lived = lived + 1 if w in self.words else 0
                if lived >= GRAM:
                    run = tuple(words[i - GRAM + 1 : i + 1])
                    for key in self.runs.get(run, ()):
                        out.setdefault(key, ("near", " ".join(run)))
        return [(key, *v) for key, v in sorted(out.items())]


def screen(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str) -> DataFrame:
    """``(key, eval_id, kind, gram)``: one hit for each document and item. ``exact``: the joined words of an item of
    FULL_CHARS or more lie in those of the document, not only at word boundaries; ``near``: a run of GRAM words is shared,
    ``gram`` being the first in the document. Exact goes before near. Texts are screened whole.

    The items of a block are sent to every worker as an index; documents are read once for each block and never shuffled.
    """
    spark, kind = docs.sparkSession, dict(docs.dtypes)[key]
    chosen = items.select(F.col(item_key).alias("id"), F.col(item_text).alias("text")).where("id is not null and text is not null").distinct()
    blocks = max(1, -(-chosen.count() // MOST_ITEMS))
    slim, out = docs.select(F.col(key).alias("key"), F.col(text).alias("text")), None
    for block in range(blocks):
        mine = chosen if blocks == 1 else chosen.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block)
        held = spark.sparkContext.broadcast(ItemIndex([(r["id"], normalize_words(r["text"])) for r in mine.collect()]))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = held.value
            for batch in batches:
                got = [(i, *h) for i, t in enumerate(batch.column(1).to_pylist()) if t for h in index.hits(normalize_words(t))]
                cols = [batch.column(0).take(pa.array([g[0] for g in got], pa.int64())), *(pa.array([g[n] for g in got], pa.string()) for n in (1, 2, 3))]
                yield pa.RecordBatch.from_arrays(cols, ["key", "eval_id", "kind", "gram"])

        some = slim.mapInArrow(run, f"key {kind}, eval_id string, kind string, gram string")
        out = some if out is None else out.unionByName(some)
    best = out.groupBy("key", "eval_id").agg(F.min(F.struct("kind", "gram")).alias("h"))
    return best.select("key", "eval_id", "h.kind", "h.gram").withColumnRenamed("key", key)


def first_hits(hits: DataFrame, key: str, n: int = 5, most: int = 100) -> DataFrame:
    """The first n hits of each document, ``most`` in all: a bounded report."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy("eval_id"))
    return hits.withColumn("nth", nth).where(F.col("nth") <= n).orderBy(key, "nth").limit(most).drop("nth")


def build_eval_set(items: DataFrame, source: str, text: str, min_chars: int = ITEM_CHARS) -> DataFrame:
    """Items with collapsed white space and at least ``min_chars`` characters, one of each text, named by source and content."""
    t = F.trim(F.regexp_replace(text, r"\s+", " "))
    out = items.select(F.coalesce(source, F.lit("unknown")).alias("source"), t.alias("text")).where(F.length("text") >= min_chars)
    one = out.groupBy("text").agg(F.min("source").alias("source"))
    return one.select(F.concat_ws(":", F.regexp_extract("source", r"([^/]*)$", 1), F.substring(F.sha2("text", 256), 1, 10)).alias("id"), "source", "text")
