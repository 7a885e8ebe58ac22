"""Lexicon screening of words and word sequences."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.words import normalize_words

# Probe and thresholds of a flag.
PROBE_CHARS, MIN_DISTINCT, MIN_DENSITY = 6000, 2, 0.004
#: Terms that every worker may have to hold. A lexicon is written by people and does not grow with the documents.
MOST_TERMS = 2_000_000


@dataclass(frozen=True)
class Lexicon:
    """Terms of all languages together, reduced to the word normal form."""

    terms: tuple[str, ...]
    source: str = "given"
    single: tuple[str, ...] = field(init=False)
    multi: tuple[tuple[str, ...], ...] = field(init=False)

    def __post_init__(self) -> None:
        lowered = sorted({t.strip().lower() for t in self.terms if t and t.strip()})
        if len(lowered) > MOST_TERMS:
            raise ValueError(f"a lexicon of more than {MOST_TERMS} terms")
        forms = {tuple(normalize_words(t)) for t in lowered}
        object.__setattr__(self, "terms", tuple(lowered))
        object.__setattr__(self, "single", tuple(sorted(f[0] for f in forms if len(f) == 1)))
        object.__setattr__(self, "multi", tuple(sorted((f for f in forms if len(f) > 1), key=lambda f: (-len(f), f))))

    @property
    def sha256(self) -> str:
        """Identity: SHA-256 over the sorted lower-case terms as written, a line each."""
        return hashlib.sha256("\n".join(self.terms).encode()).hexdigest()

    def union(self, other: Lexicon) -> Lexicon:
        return Lexicon(self.terms + other.terms, f"{self.source}+{other.source}")


# Terms of our own choosing, for builds without a lexicon of their own; few and unmistakable.
BUILTIN = {
    "eng": ("idiot", "moron", "imbecile", "scumbag", "bastard", "bitch", "asshole", "dickhead", "motherfucker", "shithead", "go kill yourself"),
    "hin": ("कमीना", "कमीने", "हरामी", "हरामखोर", "कुत्ते की औलाद", "बेवकूफ", "निकम्मा"),
    "hin-latn": ("kamina", "kamine", "harami", "haramkhor", "bewakoof", "kutte ki aulad"),
}


def builtin() -> Lexicon:
    return Lexicon(tuple(t for terms in BUILTIN.values() for t in terms), "builtin")


class Matcher:
    """Hits of a lexicon in one text: one look-up a word, and sequences only where their first word stands."""

    def __init__(self, lexicon: Lexicon):
        self.single = frozenset(lexicon.single)
        self.first: dict[str, list[tuple[str, ...]]] = {}
        for m in lexicon.multi:  # longest first
            self.first.setdefault(m[0], []).append(m)

    def hits(self, words: list[str]) -> list[str]:
        """Every hit as its term: single words, and at each position the longest sequence that starts there."""
        seen = set(words)
        out = [w for w in words if w in self.single] if not self.single.isdisjoint(seen) else []
        if not seen.isdisjoint(self.first):
            for i, w in enumerate(words):
                longest = next((m for m in self.first.get(w, ()) if tuple(words[i : i + len(m)]) == m), None)
                if longest:
                    out.append(" ".join(longest))
        return out


def flag(df: DataFrame, text: Column, lexicon: Lexicon, into: str = "toxicity", chars: int | None = None) -> DataFrame:
    """``into`` = ``struct(hits, distinct, density, flagged)`` of a text, or of its first ``chars`` characters; a null text has
    no words and no flag. The lexicon is broadcast once; texts leave the JVM in Arrow batches."""
    held = df.sparkSession.sparkContext.broadcast(Matcher(lexicon))

    @F.pandas_udf(T.StructType([T.StructField("hits", T.IntegerType()), T.StructField("distinct", T.IntegerType()), T.StructField("density", T.DoubleType()), T.StructField("flagged", T.BooleanType())]))
    def score(texts: pd.Series) -> pd.DataFrame:
        matcher, rows = held.value, []
        for t in texts:
            words = normalize_words(t)
            hits = matcher.hits(words)
            distinct, density = len(set(hits)), len(hits) / max(1, len(words))
            rows.append((len(hits), distinct, density, distinct >= MIN_DISTINCT and density >= MIN_DENSITY))
        return pd.DataFrame(rows, columns=["hits", "distinct", "density", "flagged"])

    return df.withColumn(into, score(text if chars is None else F.substring(text, 1, chars)))
