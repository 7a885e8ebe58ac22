"""Tokenizer laboratory: byte-equal samples, bytes per token, and projections to whole corpora."""

from __future__ import annotations

import json
import os
import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import sampling

#: Folder of the public vocabularies and the one used unless told otherwise. Vocabularies are never trained here.
TOKENIZERS = os.environ.get("TESSERA_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.json"
#: Windows of a sample, and the share of a window that is read.
WINDOWS, READ_SHARE, PHASES = 64, 0.35, (0.10, 0.55)

#: White space by its Unicode property, as the vocabularies' patterns have it; Python's own class has four characters more.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNKS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: Normal forms and first cuts (without what does not change the number of tokens) that never reach across the start of white space.
FORMS = ({"type": "NFC"}, {"type": "Lowercase"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "})
CUTS = (
    {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True},
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
)
#: Chunks whose counts a worker remembers before it forgets them all, and the characters of the longest one remembered.
REMEMBERED, LONGEST = 200_000, 64
#: Texts of a batch that are Python strings at a time, and characters from which a text's chunks are not listed at once.
AT_ONCE, LONG = 64, 1 << 20

_LOADED: dict[str, TextCounter] = {}


def _steps(part, names: str) -> list[dict]:
    held = json.loads(part.__getstate__()) if part is not None else None
    return [] if held is None else held[names] if held["type"] == "Sequence" else [held]


def _additive(t) -> bool:
    """Whether the tokens of a text are surely those of its chunks, each white space and what follows up to the next."""
    cuts = [{k: v for k, v in c.items() if k != "trim_offsets"} for c in _steps(t.pre_tokenizer, "pretokenizers")[:1]]
    plain = t.truncation is None and t.padding is None and all(a.special for a in t.get_added_tokens_decoder().values())
    return plain and bool(cuts) and cuts[0] in CUTS and all(f in FORMS for f in _steps(t.normalizer, "normalizers"))


class TextCounter:
    """Counts tokens of texts under one public vocabulary.

    An encoding takes over a hundred bytes for each token, so encodings are made of one chunk at a time and only their
    sizes are kept. Vocabularies that may join tokens across white space are given whole texts, one at a time.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        self.additive = _additive(t)
        size = lambda x: len(t.encode(x, add_special_tokens=False))

        class Remembered(dict):
            def __missing__(self, chunk: str) -> int:
                n = size(chunk)
                if len(chunk) <= LONGEST:
                    if len(self) >= REMEMBERED:
                        self.clear()
                    self[chunk] = n
                return n

        self.size, self.remembered = size, Remembered()

    def count(self, text: str | None) -> int | None:
        """Tokens of a whole text; null for null."""
        if text is None:
            return None
        if not self.additive:
            return self.size(text)
        chunks = CHUNKS.findall(text) if len(text) < LONG else (m[0] for m in CHUNKS.finditer(text))
        return sum(map(self.remembered.__getitem__, chunks))


def _counter(path: str) -> TextCounter:
    if path not in _LOADED:
        _LOADED[path] = TextCounter(path)
    return _LOADED[path]


def token_lengths(df: DataFrame, text: str, path: str | None = None) -> DataFrame:
    """``n_tokens`` of every row under a public vocabulary; null for null texts."""
    where = path or f"{TOKENIZERS}/{VOCABULARY}"

    @F.arrow_udf(T.LongType())
    def count(texts: pa.Array) -> pa.Array:
        one = _counter(where).count
        return pa.array([one(t) for at in range(0, len(texts), AT_ONCE) for t in texts.slice(at, AT_ONCE).to_pylist()], pa.int64())

    return df.withColumn("n_tokens", count(F.col(text)))


def token_ratios(sample: DataFrame, group: str, text: str, path: str | None = None) -> DataFrame:
    """Documents, bytes, tokens and bytes per token of each group of a sample."""
    d = token_lengths(sample.where(F.col(text).isNotNull()), text, path).withColumn("n_bytes", F.octet_length(text))
    out = d.groupBy(group).agg(F.count("*").alias("measured_docs"), F.sum("n_bytes").alias("measured_bytes"), F.sum("n_tokens").alias("measured_tokens"))
    return out.withColumn("bytes_per_token", F.round(F.try_divide("measured_bytes", "measured_tokens"), 4))


def project(ratios: DataFrame, sizes: DataFrame, group: str, size: str) -> DataFrame:
    """Estimated tokens of whole groups: their bytes over the bytes per token of the sample."""
    return sizes.join(ratios.select(group, "bytes_per_token"), group).withColumn("estimated_tokens", F.floor(F.try_divide(size, "bytes_per_token")))


def windowed_sample(docs: DataFrame, group: str, position: str, size: str, phase: int = 0, windows: int = WINDOWS) -> DataFrame:
    """Documents that begin inside evenly spaced windows of their group's bytes; the two phases read disjoint parts.

    ``position`` is the byte at which a document begins in its group.
    """
    total = docs.groupBy(group).agg(F.max(F.col(position) + F.col(size)).alias("_total"))
    at = F.col(position) * windows / F.col("_total")
    inside = (at - F.floor(at)).between(PHASES[phase], PHASES[phase] + READ_SHARE)
    return docs.join(F.broadcast(total), group).where(inside).drop("_total")


def metered(docs: DataFrame, group: str, order: str, text: str, budget: int, path: str | None = None) -> DataFrame:
    """Bytes per token of each group, measured on its documents in order until the byte budget is reached."""
    sized = docs.withColumn("_size", F.octet_length(text))
    return token_ratios(sampling.byte_budget(sized, group, order, "_size", budget), group, text, path)


def placed(docs: DataFrame, group: str, order: str, text: str, slots: int = 4096) -> DataFrame:
    """``docs`` with ``position`` and ``n_bytes``: the byte of its group at which each document begins. Groups are cut into
    ranges of the order that are summed first, so no task sums a whole group."""
    d = docs.where(F.col(text).isNotNull()).withColumn("n_bytes", F.octet_length(text).cast("long"))
    slim = d.select(group, order, "n_bytes")
    edges = slim.groupBy(group).agg(F.max(order).alias("_high"))
    slim = slim.join(F.broadcast(edges), group).withColumn("_slot", F.floor(F.col(order) * slots / (F.col("_high") + 1))).drop("_high")
    sums = slim.groupBy(group, "_slot").agg(F.sum("n_bytes").alias("_sum"))
    before = Window.partitionBy(group).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(group, "_slot", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(group, "_slot").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    at = slim.withColumn("_in", F.coalesce(F.sum("n_bytes").over(within), F.lit(0))).join(sums, [group, "_slot"]).select(group, order, (F.col("_before") + F.col("_in")).alias("position"))
    return d.join(at, [group, order])


def balanced_sample(docs: DataFrame, group: str, order: str, text: str, budget: int, phase: int = 0) -> DataFrame:
    """About ``budget`` bytes of each group, from windows spread over it; the two phases share no document."""
    inside = windowed_sample(placed(docs, group, order, text), group, "position", "n_bytes", phase)
    return sampling.byte_budget(inside, group, order, "n_bytes", budget)


def compare(docs: DataFrame, group: str, text: str, paths: list[str], sizes: DataFrame | None = None, size: str = "doc_bytes") -> DataFrame:
    """Bytes per token of every vocabulary and group, with the projection to ``sizes`` (group, size) where it is given."""
    rows = [token_ratios(docs, group, text, p).withColumn("tokenizer", F.lit(os.path.basename(p))) for p in paths]
    out = reduce(DataFrame.unionByName, rows)
    return out if sizes is None else out.join(F.broadcast(sizes), group, "left").withColumn("projected_tokens", F.floor(F.try_divide(size, "bytes_per_token")))
