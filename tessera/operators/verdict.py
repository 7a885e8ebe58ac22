"""The ordered filter chain: every document is kept or dropped for the first reason that applies."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import hashing, pii, quality, toxicity
from tessera.functions.words import NORMAL_FORM
from tessera.operators import contamination, dedup, lm
from tessera.plugins import Plugin, apply_plugins, identities
from tessera.session import materialize

# Reasons in the order in which they are tried.
REASONS = ("exact_dup", "near_dup", "quality", "perplexity", "toxicity", "contamination", "plugin", "pii")


#: Characters, and words of quality, that the published definition reads of a text; here texts are read whole unless these are given.
PUBLISHED_PROBES = {"quality_chars": quality.PROBE_CHARS, "quality_words": quality.PROBE_WORDS, "toxicity_chars": toxicity.PROBE_CHARS, "pii_chars": pii.PROBE_CHARS, "perplexity_chars": lm.PROBE_CHARS}


@dataclass(frozen=True)
class FilterConfig:
    """Everything that decides what is dropped; its canonical JSON is its identity. Probes that are not named are whole texts."""

    min_quality: str = "medium"
    ppx_percentile: float | None = None
    min_scored: int = lm.MIN_SCORED
    pii_policy: str = "redact"
    lexicon_sha256: str | None = None
    eval_sha256: str | None = None
    droplist_sha256: str | None = None
    near: dict | None = None
    cutoffs: dict[str, float] = field(default_factory=dict)
    plugins: list[dict] = field(default_factory=list)
    probes: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if unknown := set(self.probes) - set(PUBLISHED_PROBES):
            raise ValueError(f"no such probe: {', '.join(sorted(unknown))}")

    def content(self) -> dict:
        return asdict(self) | {"probes": {k: self.probes.get(k) for k in PUBLISHED_PROBES}, "word_normal_form": NORMAL_FORM}

    def canonical(self) -> str:
        """Sorted keys, default separators, escaped: stable for a digest."""
        return json.dumps(self.content(), sort_keys=True)

    def sha256(self) -> str:
        return hashlib.sha256(self.canonical().encode()).hexdigest()


def verdicts(
    docs: DataFrame, key: str, text: str, lang: str, order: list[str], *, config: FilterConfig | None = None, near_drop: DataFrame | None = None, bits: DataFrame | None = None,
    cutoffs: DataFrame | None = None, lexicon: toxicity.Lexicon | None = None, items: DataFrame | None = None, plugins: list[Plugin] | None = None, preview: int = 280,
) -> DataFrame:
    """A row for each of ``docs``: its columns but the text, ``chars`` and ``preview`` of the text, and ``drop_reason`` (null for
    kept ones); columns of ``docs`` with these names are replaced.

    The first copy of a text claims it before any other filter, so later copies are exact duplicates even where the first
    is dropped. ``near_drop`` holds keys; ``bits`` and ``cutoffs`` are those of :mod:`tessera.operators.lm`, a document
    without score or cutoff is kept; items are (id, text). Null texts are dropped for quality.

    Texts are judged where they are read and left there: what is written, shuffled and joined are identities and findings.
    """
    c = config or FilterConfig()
    probe = c.probes.get
    made = ("chars", "preview", "drop_reason")
    keep = [x for x in docs.columns if x != text and x not in made]
    d = quality.metrics(docs.select(*keep, F.col(text).alias("_text")), "_text", probe("quality_chars"), probe("quality_words"))
    worst = {"high": ("medium", "low"), "medium": ("low",), "low": ()}[c.min_quality]
    poor = F.coalesce("quality_bucket", F.lit("low")).isin(*worst) if worst else F.col("_text").isNull()
    none = F.lit(None).cast("string")
    d = toxicity.flag(d, F.col("_text"), lexicon, "_tox", probe("toxicity_chars")) if lexicon is not None else d
    d = apply_plugins(d, "_text", plugins or [], "_plugin")
    slim = d.select(
        *keep, hashing.identity(F.col("_text")).alias("_id"), F.length("_text").cast("long").alias("chars"), F.substring("_text", 1, preview).alias("preview"), F.when(poor, F.lit("quality")).alias("_quality"),
        (F.when(F.col("_tox.flagged"), F.lit("toxicity")) if lexicon is not None else none).alias("_toxic"), F.col("_plugin"),
        (F.when(F.size(pii.scan(F.col("_text"), probe("pii_chars"))) > 0, F.lit("pii")) if c.pii_policy == "drop" else none).alias("_pii"),
    )
    found = materialize(slim, "findings")
    d = dedup.keep_first(found, "_id", order)
    reasons = [F.when(~F.col("is_first"), F.lit("exact_dup"))]
    if near_drop is not None:
        d = d.join(near_drop.select(key).distinct().withColumn("_near", F.lit("near_dup")), key, "left")
        reasons.append(F.col("_near"))
    reasons.append(F.col("_quality"))
    if bits is not None and cutoffs is not None:
        d = d.join(bits.select(key, "bits"), key, "left").join(F.broadcast(cutoffs.select(F.col("lang").alias(lang), "cutoff")), lang, "left")
        reasons.append(F.when(F.col("bits") > F.col("cutoff"), F.lit("perplexity")))
    reasons.append(F.col("_toxic"))
    if items is not None:
        id_col, text_col = items.columns[:2]
        hit = contamination.screen(docs, key, text, items, id_col, text_col).select(key).distinct().withColumn("_leak", F.lit("contamination"))
        d = d.join(hit, key, "left")
        reasons.append(F.col("_leak"))
    reasons += [F.col("_plugin"), F.col("_pii")]
    return d.select(*keep, "chars", "preview", F.coalesce(*reasons).alias("drop_reason"))


def reason_counts(judged: DataFrame, plugins: list[Plugin] | None = None) -> DataFrame:
    """Documents by reason, zeros included; ``kept`` for those that stay."""
    names = ["kept", *(r for r in REASONS if r != "plugin"), *(f"plugin:{p.name}" for p in plugins or [])]
    every = judged.sparkSession.createDataFrame([(n,) for n in names], "reason string")
    got = judged.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))
    return every.join(got, "reason", "full").select("reason", F.coalesce("n", F.lit(0)).alias("docs"))


def drops_log(judged: DataFrame, keep: list[str]) -> DataFrame:
    """A row for each dropped document with its reason, length and the beginning of its text."""
    return judged.where("drop_reason is not null").select(*keep, F.col("drop_reason").alias("reason"), "chars", "preview")


def with_plugins(config: FilterConfig, plugins: list[Plugin]) -> FilterConfig:
    return replace(config, plugins=identities(plugins))
