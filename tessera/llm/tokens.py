"""Token counts under an existing byte-pair vocabulary, and budgets by source, language and domain (problem 1).

The vocabulary is compiled into an Aho-Corasick automaton over its tokens. The last token of the encoding of every
prefix is the longest matching token that is compatible with the last token before it, so one pass counts the
exact encoding without making it. Of the matches at an end, longest first, all that precede the fitting one are looked at,
so time is linear in the text for a vocabulary whose tokens have a bounded length.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.domain import classify_text

#: Folder of the public vocabularies (an environment variable or a parameter), and the file used unless told otherwise.
TOKENIZERS = os.environ.get("TESSERA_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern by which text is cut before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Distinct space-and-word chunks whose counts a worker remembers before it forgets them all.
REMEMBERED = 400_000


def vocabulary(path: str) -> bytes:
    """The rank file's content: a line for each token with its bytes in base64 and its rank."""
    with open(path, "rb") as f:
        return f.read()


class TokenCounter:
    """Counts tokens of texts under one vocabulary."""

    def __init__(self, ranks_file: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.splitlines() if line)}
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.parts = regex.compile(PATTERN)
        self.chunks = regex.compile(r"\s*\S+|\s+$")
        self._splits: dict[int, tuple[int, int]] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        outer = self

        class Remembered(dict):
            def __missing__(self, chunk: str) -> int:
                n = self[chunk] = sum(outer.count_piece(p.encode()) for p in outer.parts.findall(chunk))
                return n

        self.remembered = Remembered()

    def split(self, rank: int) -> tuple[int, int]:
        """The two tokens that merge into a token, itself twice for a single byte: the encoding of its bytes by earlier merges."""
        got = self._splits.get(rank)
        if got is None:
            token = self.bytes_of[rank]
            parts = [token[i : i + 1] for i in range(len(token))]
            while len(parts) > 2:
                best, at = min(((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)), default=(1 << 60, 0))
                if best >= rank:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            got = (rank, rank) if len(parts) == 1 else (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else (-1, -1)
            self._splits[rank] = got
        return got

    def _merged(self, a: int, b: int) -> int | None:
        r = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
        return r if r is not None and self.split(r) == (a, b) else None

    def compatible(self, a: int, b: int) -> bool:
        """Whether the encoding of the two tokens' bytes is just these two tokens.

        The seam is undone merge by merge, latest first; the pair is incompatible if at some state the two tokens at
        the seam would have merged with each other before the merges undone so far.
        """
        got = self._pairs.get((a, b))
        if got is None:
            got = self._pairs[a, b] = self._seam(a, b)
        return got

    def _seam(self, a: int, b: int) -> bool:
        limit = 1 << 60
        while True:
            m = self._merged(a, b)
            if m is not None and m < limit:
                return False
            if a > b:  # undo the later of the two merges
                limit, a = a, self.split(a)[1]
                if a == limit:
                    limit, b = b + 1, self.split(b)[0]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, self.split(b)[0]
                if b + 1 == limit:
                    limit, a = a, self.split(a)[1]
                    if a == limit:
                        return True

    def count_piece(self, data: bytes) -> int:
        """Tokens of one pre-cut piece."""
        if len(data) < 2 or data in self.ranks:
            return min(1, len(data))
        n = len(data)
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for end, (size, rank) in self.automaton.iter(data.decode("latin-1")):
            end += 1
            if last[end] < 0:  # matches at an end come longest first
                before = last[end - size]
                if end == size or (before >= 0 and self.compatible(before, rank)):
                    if self.split(rank)[0] >= 0:
                        last[end], count[end] = rank, count[end - size] + 1
        return count[n]

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; null and empty have none."""
        if not text:
            return 0
        if len(self.remembered) > REMEMBERED:
            self.remembered.clear()
            self._pairs.clear()
        return sum(map(self.remembered.__getitem__, self.chunks.findall(text)))


@lru_cache(2)
def _counter(ranks_file: bytes) -> TokenCounter:
    return TokenCounter(ranks_file)


def token_counts(df: DataFrame, text: str, keep: list[str], path: str | None = None, model: dict | None = None, tag: str | None = None) -> DataFrame:
    """``keep`` columns, ``n_tokens`` and ``n_bytes`` of every row's text, and with ``model`` its main ``language`` and its
    ``domain``: the kept column ``tag``, or where that is null or blank the classifier's.

    Null texts have 0 tokens and bytes and no language. Texts are counted and classified whole; repeated rows are counted again.
    """
    spark = df.sparkSession
    ranks = spark.sparkContext.broadcast(vocabulary(path or f"{TOKENIZERS}/{VOCABULARY}"))
    held = spark.sparkContext.broadcast(model)
    kinds = dict(df.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(ranks.value)
        classifier = None
        if held.value is not None:
            from tessera.llm.language import Classifier

            classifier = Classifier(held.value)
        for batch in batches:
            n = batch.num_columns - 1
            texts = batch.column(n).to_pylist()
            cols = [batch.column(i) for i in range(n)]
            cols += [pa.array([counter.count(t) for t in texts], pa.int64()), pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64())]
            names = [*batch.schema.names[:n], "n_tokens", "n_bytes"]
            if classifier:
                langs = [classifier.main(t) for t in texts]
                tags = batch.column(keep.index(tag)).to_pylist() if tag else [None] * len(texts)
                domains = [g if g and g.strip() else classify_text(t, lang) for g, t, lang in zip(tags, texts, langs, strict=True)]
                cols += [pa.array(langs, pa.string()), pa.array(domains, pa.string())]
                names += ["language", "domain"]
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keep), "n_tokens long, n_bytes long", *(["language string, domain string"] if model is not None else [])])
    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def budget(counted: DataFrame, dimensions: list[str]) -> DataFrame:
    """Documents, bytes and tokens by every combination of the dimensions, totals included.

    ``level`` has a bit for each dimension that is summed over (the last dimension is the lowest bit), which tells a
    total from a null value.
    """
    return counted.cube(*dimensions).agg(F.count("*").alias("docs"), F.sum("n_bytes").alias("doc_bytes"), F.sum("n_tokens").alias("tokens"), F.grouping_id().cast("long").alias("level"))


def latest_full_pass(stats: DataFrame, registry: DataFrame, language) -> DataFrame:
    """``(source, language, full_pass_bytes)``: the doc bytes of each shard's latest run, by registered source and language.

    Repeated and older rows of a shard do not count; sources are the registry's, whatever spelling a run recorded.
    """
    newest = stats.groupBy(F.col("shard.shard_id").alias("shard_id")).agg(F.max(F.struct("generated_utc", F.col("full_pass.doc_bytes").alias("bytes"), F.col("shard.language").alias("label"))).alias("s"))
    named = newest.join(F.broadcast(registry), "shard_id", "left").select("source", language(F.col("s.label")).alias("language"), F.col("s.bytes").alias("bytes"))
    return named.cube("source", "language").agg(F.sum("bytes").alias("full_pass_bytes"), F.grouping_id().cast("long").alias("stats_level"))


def registered_sources(registry: DataFrame) -> DataFrame:
    """One source for each registered shard: of shards listed twice, the first non-blank one in order."""
    return registry.where("shard_id is not null").groupBy("shard_id").agg(F.min(F.when(F.trim("source") != "", F.trim("source"))).alias("source"))
