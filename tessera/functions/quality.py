"""Heuristic quality of a document, as Catalyst expressions over its whole text or a probe of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.binding import let

# Probe sizes, thresholds and phrases that must equal the published definition.
PROBE_CHARS, PROBE_WORDS = 4000, 500
SHORT_CHARS, SHORT_CAP, LONG_CHARS = 200, 0.30, 500_000
SYMBOL_MAX, DIGIT_MAX, WORD_MAX, WORD_MIN, DUP_LINE_MAX, BIGRAM_MAX = 0.12, 0.15, 14.0, 1.5, 0.30, 0.08
HIGH, MEDIUM = 0.75, 0.50
BOILERPLATE = (
    "cookie", "subscribe", "newsletter", "all rights reserved", "copyright ©", "click here", "terms of service",
    "privacy policy", "advertisement", "read more", "download our app", "sign up", "log in to", "follow us",
    "whatsapp group", "telegram channel", "सब्सक्राइब", "विज्ञापन", "कॉपीराइट", "अस्वीकरण", "डाउनलोड करें",
)
#: White space as Python's regular expressions have it, and line ends as its strings do.
SPACE = r"\t\n\x0B\f\r\x1C-\x1F \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
LINE_END = r"\r\n|[\n\x0B\f\r\x1C-\x1E\x85\u2028\u2029]"
#: Characters that are no symbols: word characters, white space, the Indic and Arabic blocks, joiners.
NO_SYMBOL = rf"\p{{L}}\p{{N}}_{SPACE}\u0900-\u0DFF\u0600-\u06FF\u0750-\u077F\u200C\u200D"


def _prepared(df: DataFrame, text: str, chars: int | None, words: int | None) -> DataFrame:
    """Probe and words as columns of their own, so that each is made once."""
    out = df.withColumn("_probe", F.col(text) if chars is None else F.substring(text, 1, chars))
    trimmed = F.regexp_replace("_probe", rf"^[{SPACE}]+|[{SPACE}]+$", "")
    all_words = F.split(trimmed, rf"[{SPACE}]+")
    out = out.withColumn("_words", all_words if words is None else F.slice(all_words, 1, words))
    lines = F.filter(F.split("_probe", LINE_END), lambda x: F.regexp_replace(x, rf"[{SPACE}]+", "") != "")
    out = out.withColumn("_lines", lines).withColumn("_low", F.lower("_probe"))
    pairs = let(F.col("_words"), lambda ws: F.transform(F.sequence(F.lit(1), F.greatest(F.size(ws) - 1, F.lit(1))), lambda i: F.concat_ws(" ", F.slice(ws, i, 2))))
    return out.withColumn("_pairs", F.when(F.size("_words") >= 20, F.array_sort(pairs)))


def longest_run(sorted_values: Column) -> Column:
    """Length of the longest run of equal neighbours of a sorted array: the count of its commonest value in one pass."""
    zero = F.struct(F.lit(0).alias("best"), F.lit(0).alias("run"), F.lit("").alias("last"))

    def step(acc: Column, x: Column) -> Column:
        run = F.when(x == acc["last"], acc["run"] + 1).otherwise(1)
        return F.struct(F.greatest(acc["best"], run).alias("best"), run.alias("run"), x.alias("last"))

    return F.aggregate(sorted_values, zero, step)["best"]


def metrics(df: DataFrame, text: str = "text", chars: int | None = None, words: int | None = None) -> DataFrame:
    """All quality metrics, ``quality_score`` (4 digits) and ``quality_bucket`` beside the columns of ``df``.

    Texts are read whole; ``chars`` and ``words`` bound what is read (the published definition has PROBE_CHARS and
    PROBE_WORDS). Null texts have null metrics. An empty text has one empty word and is short, so its score is at most the short cap.
    """
    d = _prepared(df, text, chars, words)
    probe_len = F.greatest(F.length("_probe"), F.lit(1))
    # every character but the symbols is removed; what is left are the symbols
    symbols = F.length(F.regexp_replace("_probe", f"[{NO_SYMBOL}]+", ""))
    digits = F.length(F.regexp_replace("_probe", r"[^\p{Nd}]+", ""))
    total_len = F.aggregate("_words", F.lit(0), lambda a, w: a + F.length(w))
    n_lines = F.size("_lines")
    d = d.withColumns(
        {
            "n_text": F.length(text),
            "symbol_ratio": symbols / probe_len,
            "digit_ratio": digits / probe_len,
            "mean_word_len": total_len / F.greatest(F.size("_words"), F.lit(1)),
            "dup_line_frac": F.when(n_lines >= 5, 1.0 - F.size(F.array_distinct("_lines")) / n_lines).otherwise(0.0),
            "top_bigram_frac": F.when(F.size("_words") >= 20, longest_run(F.col("_pairs")) / (F.size("_words") - 1)).otherwise(0.0),
            "boilerplate_hits": sum((F.col("_low").contains(m).cast("int") for m in BOILERPLATE), F.lit(0)),
        }
    )
    cut = lambda c, top, by, most: F.when(F.col(c) > top, F.least(F.lit(most), (F.col(c) - top) * by)).otherwise(0.0)
    penalty = (
        cut("symbol_ratio", SYMBOL_MAX, 2.5, 0.3)
        + cut("digit_ratio", DIGIT_MAX, 2.0, 0.3)
        + F.when((F.col("mean_word_len") > WORD_MAX) | (F.col("mean_word_len") < WORD_MIN), 0.2).otherwise(0.0)
        + F.when(F.col("dup_line_frac") > DUP_LINE_MAX, F.least(F.lit(0.3), F.col("dup_line_frac") - DUP_LINE_MAX + 0.1)).otherwise(0.0)
        + cut("top_bigram_frac", BIGRAM_MAX, 2.0, 0.25)
        + F.least(F.lit(0.3), F.col("boilerplate_hits") * 0.08)
        + F.when(F.col("n_text") > LONG_CHARS, 0.1).otherwise(0.0)
    )
    raw = F.greatest(F.lit(0.0), 1.0 - penalty)
    d = d.withColumn("_score", F.when(F.col("n_text") < SHORT_CHARS, F.least(raw, F.lit(SHORT_CAP))).when(F.col("n_text").isNotNull(), raw))
    bucket = F.when(F.col("_score") >= HIGH, "high").when(F.col("_score") >= MEDIUM, "medium").when(F.col("_score").isNotNull(), "low")
    d = d.withColumn("quality_score", F.round("_score", 4)).withColumn("quality_bucket", bucket)
    return d.drop("_probe", "_words", "_lines", "_low", "_pairs", "_score")


def histogram_bin(score: Column) -> Column:
    """One of ten bins, the last closed."""
    return F.least(F.lit(9), F.floor(score * 10)).cast("int")
