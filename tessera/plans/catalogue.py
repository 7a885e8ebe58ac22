"""All queries of the core, each over whole tables. Their SQL is in :mod:`tessera.plans.oracle`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import domain, hashing, html, lid, pii, quality, toxicity, words
from tessera.operators import contamination, dedup, gate, lm, manifest, neardup, sampling, verdict
from tessera.plans import oracle
from tessera.plugins import min_words
from tessera.session import materialize, spread, table

#: Parameters of the queries, shared with the SQL.
STRIDE, NESTED, BUDGET = 50, 4, 20_000


def _identified(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    """Columns of documents and the identity of their text: what is shuffled where texts are compared."""
    return table(spark, folder, "documents").select(*keep, hashing.identity(F.col("text")).alias("identity"))


def exact_dedup_stats(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.stats(_identified(spark, folder, "source"), "source", "identity")


def exact_dedup_intra_cross(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.intra_cross(_identified(spark, folder, "shard_id"), "shard_id", "identity")


def keep_first(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.keep_first(_identified(spark, folder, "doc_id"), "identity", ["doc_id"]).select("doc_id", "is_first")


def stride_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.stride(table(spark, folder, "documents"), STRIDE).select("doc_id", "ordinal")


def nested_stride(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.nested(sampling.stride(table(spark, folder, "documents"), STRIDE), NESTED).select("doc_id", "ordinal")


def byte_budget_sample(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "shard_id", "doc_index", F.octet_length("text").alias("n_bytes"))
    return sampling.byte_budget(docs, "shard_id", "doc_index", "n_bytes", BUDGET).select("doc_id", "shard_id", "n_bytes")


def provenance_gate(spark: SparkSession, folder: str) -> DataFrame:
    return gate.gate(table(spark, folder, "registry_shards")).select("shard_id", "path", "reason")


def admitted_docs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "shard_id", F.octet_length("text").alias("n_bytes"))
    return gate.admit(docs, gate.gate(table(spark, folder, "registry_shards"))).groupBy("shard_id").agg(F.count("*").alias("docs"), F.sum("n_bytes").alias("doc_bytes"))


def licence_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return gate.licence_rollup(gate.gate(table(spark, folder, "registry_shards")))


def quality_metrics(spark: SparkSession, folder: str) -> DataFrame:
    q = quality.metrics(spread(table(spark, folder, "documents").select("doc_id", "text")))
    r = [F.round(c, 6).alias(c) for c in ("symbol_ratio", "digit_ratio", "mean_word_len", "dup_line_frac", "top_bigram_frac")]
    return q.select("doc_id", *r, F.col("boilerplate_hits").cast("long").alias("boilerplate_hits"), "quality_score", "quality_bucket")


def quality_buckets(spark: SparkSession, folder: str) -> DataFrame:
    q = quality.metrics(spread(table(spark, folder, "documents").select("shard_id", "text")))
    return q.groupBy("shard_id", "quality_bucket").agg(F.count("*").alias("docs"), F.round(F.avg("digit_ratio"), 6).alias("mean_digit_ratio"))


def quality_histogram(spark: SparkSession, folder: str) -> DataFrame:
    q = quality.metrics(spread(table(spark, folder, "documents").select("text")))
    return q.groupBy(quality.histogram_bin(F.col("quality_score")).alias("bin")).agg(F.count("*").alias("docs"))


def script_lid(spark: SparkSession, folder: str) -> DataFrame:
    d = spread(table(spark, folder, "documents")).withColumn("s", lid.dominant(lid.script_counts(F.col("text"))))
    return d.select("doc_id", F.col("s.script").alias("script"), F.round("s.share", 6).alias("share"), lid.language_of(F.col("s.script")).alias("language"))


def lid_purity(spark: SparkSession, folder: str) -> DataFrame:
    registry = table(spark, folder, "registry_shards").where("shard_id is not null").groupBy("shard_id").agg(F.max("language").alias("declared"))
    d = spread(table(spark, folder, "documents")).join(F.broadcast(registry), "shard_id").withColumn("s", lid.dominant(lid.script_counts(F.col("text"))))
    own = lid.consistent(F.col("s.script"), F.lower("declared"))
    return d.groupBy("shard_id", "declared").agg(F.count("*").alias("docs"), F.round(F.avg(own.cast("double")), 6).alias("purity"), F.round(F.avg("s.share"), 6).alias("mean_share"))


def top_languages(spark: SparkSession, folder: str) -> DataFrame:
    d = spread(table(spark, folder, "documents")).select(lid.effective_language(lid.dominant(lid.script_counts(F.col("text")))["script"], F.lower(F.trim("lang"))).alias("l"))
    return d.groupBy(F.coalesce("l", F.lit("und")).alias("language")).agg(F.count("*").alias("docs")).orderBy(F.desc("docs"), "language").limit(25)


def domain_mix(spark: SparkSession, folder: str) -> DataFrame:
    d = spread(table(spark, folder, "documents")).select("shard_id", domain.classify(F.col("text"), F.lower(F.trim("lang"))).alias("domain"))
    return d.groupBy("shard_id", "domain").agg(F.count("*").alias("docs"))


def word_counts(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents")).select("doc_id", F.size(words.words_of(words.folded(F.col("text")))).alias("words"))


def _lexicon(spark: SparkSession, folder: str) -> toxicity.Lexicon:
    terms = table(spark, folder, "abuse_terms").select("term").where("term is not null").distinct().collect()
    return toxicity.Lexicon(tuple(r[0] for r in terms), "abuse_terms")


def lexicon_terms(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "abuse_terms")
    extra = spark.createDataFrame([("eng", "idiot"), ("eng", "Dolt ")], "lang string, term string")
    return t.select("lang", "term").unionByName(extra).select(F.lower(F.trim("term")).alias("term")).distinct()


def toxicity_flags(spark: SparkSession, folder: str) -> DataFrame:
    d = toxicity.flag(spread(table(spark, folder, "drops")), F.col("preview"), _lexicon(spark, folder), "s").select("drop_id", "s").where("s.hits > 0")
    return d.select("drop_id", F.col("s.hits").alias("hits"), F.col("s.distinct").alias("distinct_terms"), F.round("s.density", 6).alias("density"), F.col("s.flagged").alias("flagged"))


def contamination_hits(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.screen(spread(table(spark, folder, "documents")), "doc_id", "text", table(spark, folder, "eval_set"), "id", "text")


def eval_grams(spark: SparkSession, folder: str) -> DataFrame:
    items = contamination.normalised_items(table(spark, folder, "eval_set"), "id", "text")
    return contamination.grams(items, "words").groupBy("gram").agg(F.min("eval_id").alias("first_id"), F.max("eval_id").alias("last_id"), F.count("*").alias("n"))


def eval_set_build(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.build_eval_set(table(spark, folder, "eval_set"), "source", "text")


def pii_scan(spark: SparkSession, folder: str) -> DataFrame:
    d = spread(table(spark, folder, "drops")).select("drop_id", F.explode(pii.scan(F.col("preview"))).alias("kind", "n"))
    return d.groupBy("kind").agg(F.sum("n").alias("spans"), F.countDistinct("drop_id").alias("drops"))


def pii_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """Kinds of identifiers without a checksum in each preview, which SQL can look for too."""
    d = spread(table(spark, folder, "drops")).select("drop_id", F.explode(F.map_keys(pii.scan(F.col("preview")))).alias("kind"))
    return d.where(F.col("kind").isin(*pii.PATTERNS)).distinct()


def pii_redact(spark: SparkSession, folder: str) -> DataFrame:
    d = spread(table(spark, folder, "drops")).where(F.size(pii.scan(F.col("preview"))) > 0)
    return d.select("drop_id", pii.redact(F.col("preview"))["text"].alias("redacted")).distinct()


def pii_pan(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "drops").select("drop_id", F.regexp_count("preview", F.lit(pii.PATTERNS["pan"])).cast("long").alias("n")).where("n > 0").distinct()


def _language(c: str = "lang"):
    return F.nullif(F.lower(F.regexp_extract(F.trim(c), "^([^-_]*)", 1)), F.lit(""))


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents")).withColumn("language", _language())


def char_trigram_train(spark: SparkSession, folder: str) -> DataFrame:
    return lm.train(_docs(spark, folder), "language", "text")[0].select("lang", "ctx", "nxt", "n")


def _bits(spark: SparkSession, folder: str) -> DataFrame:
    docs = _docs(spark, folder)
    return lm.bits_per_char(docs, "doc_id", "language", "text", *lm.train(docs, "language", "text"))


def bits_per_char(spark: SparkSession, folder: str) -> DataFrame:
    return _bits(spark, folder).select("doc_id", F.round("bits", 3).alias("bits"))


def _rounded(digits: int) -> list:
    """Rounded above a ten-millionth more, so that engines whose sums differ in the last bit agree on halves."""
    return [F.round(F.col(c) + 1e-7, digits).alias(c) for c in ("mean", "p50", "p90", "p99", "max")]


def ppx_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    d = lm.distribution(_bits(spark, folder), "lang")
    return d.select("lang", "scored", *_rounded(3))


def ppx_cutoffs(spark: SparkSession, folder: str) -> DataFrame:
    return lm.cutoffs(_bits(spark, folder), "lang").select("lang", "scored", F.round(F.col("cutoff") + 1e-7, 3).alias("cutoff"))


def score_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "doc_scores").select("shard_id", F.col("bits_per_char").alias("bits"))
    return lm.distribution(d, "shard_id").select("shard_id", "scored", *_rounded(4))


def minhash_sql(spark: SparkSession, folder: str) -> DataFrame:
    d = spread(table(spark, folder, "documents")).select("doc_id", neardup.sql_signature(neardup.shingles(neardup.words_for_shingles(F.col("text"))), 8).alias("sig"))
    return d.where("sig is not null").select("doc_id", *[F.get("sig", F.lit(i)).alias(f"h{i}") for i in range(8)])


def lsh_bands(spark: SparkSession, folder: str) -> DataFrame:
    d = spread(table(spark, folder, "documents")).select("doc_id", neardup.sql_signature(neardup.shingles(neardup.words_for_shingles(F.col("text"))), 8).alias("sig")).where("sig is not null")
    bands = d.select("doc_id", F.posexplode(F.array(*[F.slice("sig", 4 * i + 1, 4) for i in range(2)])).alias("band", "key"))
    return bands.groupBy("band", F.array_join(F.transform("key", lambda x: x.cast("string")), "-").alias("key")).agg(F.count("*").alias("docs"), F.min("doc_id").alias("representative"))


def _clusters(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.clusters(spread(table(spark, folder, "documents").select("doc_id", "text")), "doc_id", "text")


def neardup_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return _clusters(spark, folder)


def neardup_stats(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread(table(spark, folder, "documents").select("doc_id", "text"))
    clustered, signed, linked = neardup.sweep(docs, "doc_id", "text")
    return neardup.sweep_stats(clustered.join(docs.select("doc_id", hashing.identity(F.col("text")).alias("identity")), "doc_id"), signed, linked, "identity")


def neardup_drop_list(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents").select("doc_id", hashing.doc_hash(F.col("text")).alias("doc_hash"))
    return neardup.drop_list(_clusters(spark, folder).join(d, "doc_id"), "doc_hash").select(F.hex("doc_hash").alias("doc_hash"))


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    docs = _docs(spark, folder)
    near = materialize(_clusters(spark, folder).where("doc_id <> cluster").select("doc_id"), "near")
    bits = materialize(lm.bits_per_char(docs, "doc_id", "language", "text", *lm.train(docs, "language", "text")), "bits")
    return verdict.verdicts(
        docs, "doc_id", "text", "language", ["doc_id"], near_drop=near, bits=bits, cutoffs=lm.cutoffs(bits, "lang"), lexicon=_lexicon(spark, folder),
        items=table(spark, folder, "eval_set").select("id", "text"), plugins=[min_words(10)], config=verdict.FilterConfig(pii_policy="drop"),
    )


def verdict_counts(spark: SparkSession, folder: str) -> DataFrame:
    return verdict.reason_counts(_judged(spark, folder), [min_words(10)])


def verdict_drops(spark: SparkSession, folder: str) -> DataFrame:
    return verdict.drops_log(_judged(spark, folder), ["shard_id", "language", "doc_index"])


def drops_by_reason(spark: SparkSession, folder: str) -> DataFrame:
    once = table(spark, folder, "drops").select("drop_id", "reason").distinct()
    every = spark.createDataFrame([(r,) for r in verdict.REASONS if r != "plugin"], "reason string")
    got = once.groupBy(F.coalesce("reason", F.lit("unknown")).alias("reason")).agg(F.count("*").alias("n"))
    return every.join(got, "reason", "full").select("reason", F.coalesce("n", F.lit(0)).alias("drops"))


def attest_files(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.attest(table(spark, folder, "documents"), "shard_id", "text")


def manifest_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.rollup(manifest.latest_runs(table(spark, folder, "shard_stats")))


def build_union(spark: SparkSession, folder: str) -> DataFrame:
    parts = [_identified(spark, folder, "shard_id").where(F.substring("shard_id", 1, 1).isin(*x)).select("identity").distinct() for x in (("v", "k"), ("l", "s", "c", "p"))]
    return manifest.union_builds(parts, "identity")


def measured_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Records of documents that no measurement with a score covers: a build on scores would have to measure them first."""
    docs, measured = table(spark, folder, "documents"), table(spark, folder, "doc_scores").where("bits_per_char is not null")
    key = F.concat_ws(":", "shard_id", "doc_index").alias("record")
    return dedup.missing_from(docs.select(key), measured.select(key), "record")


def doc_hashes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.hex(hashing.doc_hash(F.col("text"))).alias("doc_hash"))


def corpus_hash(spark: SparkSession, folder: str) -> DataFrame:
    ids = materialize(table(spark, folder, "documents").select(hashing.doc_hash(F.col("text")).alias("doc_hash")), "ids")
    return spark.createDataFrame([(hashing.ids_digest(ids), hashing.ids_digest(ids, distinct=False))], "corpus_build_hash string, attestation_hash string")


def html_strip(spark: SparkSession, folder: str) -> DataFrame:
    page = F.concat(F.lit("<html><style>p {color: red}</style><!-- a <b> comment --><SCRIPT type='x'>var a = 1 < 2;</SCRIPT><p class='y'>"), F.regexp_replace("text", "[<>&]", " "), F.lit("</p>\n\n<br/>Tom &amp; Co&nbsp;end</html>"))
    return table(spark, folder, "documents").select("doc_id", html.strip_tags(page).alias("text"))


def token_ratio(spark: SparkSession, folder: str) -> DataFrame:
    from tessera.operators.tokenizer_lab import token_ratios

    return token_ratios(table(spark, folder, "documents"), "lang", "text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every public function of this module that takes a session and a folder."""
    return {k: f for k, f in globals().items() if callable(f) and getattr(f, "__module__", "") == __name__ and k[0] != "_" and k not in ("queries", "oracle_sql")}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
