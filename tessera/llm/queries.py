"""The pN_ queries, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import table

#: Fixed value: the number of equal signature rows from which a compared pair counts as a match.
VERIFY_MIN_AGREE = 21
#: Fixed value: characters of a preview.
PREVIEW_CHARS = 280


def p1_budget(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens by registered source, true language and domain, with the bytes of the full passes beside them."""
    from tessera.llm import language as L
    from tessera.llm import tokens as K

    names = L.code_names(table(spark, folder, "lang_codes"))
    registry = K.registered_sources(table(spark, folder, "registry_shards"))
    counted = p1_doc_tokens(spark, folder).join(F.broadcast(registry), "shard_id", "left")
    cube = K.budget(counted, ["source", "language", "domain"])
    passes = K.latest_full_pass(table(spark, folder, "shard_stats"), registry, lambda c: L.label_code(c, names))
    # full passes are not known by domain, so they stand beside the totals over domains
    joined = cube.alias("c").join(F.broadcast(passes).alias("p"), F.expr("c.source <=> p.source and c.language <=> p.language and c.level = p.stats_level * 2 + 1"), "left")
    ratio = F.col("c.doc_bytes") / F.nullif(F.col("c.tokens"), F.lit(0))
    return joined.select("c.source", "c.language", "c.domain", "c.level", "c.docs", "c.doc_bytes", "c.tokens", F.round(ratio, 4).alias("bytes_per_token"), "p.full_pass_bytes", F.floor(F.col("p.full_pass_bytes") / ratio).alias("full_pass_tokens"))


def p1_doc_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens, bytes, main language and domain of every document."""
    from tessera.llm import tokens as K

    docs = table(spark, folder, "documents")
    return K.token_counts(docs, "text", ["doc_id", "shard_id", "domain_tag"], model=_language_model(spark, folder), tag="domain_tag").select("doc_id", "shard_id", "language", "domain", "n_tokens", "n_bytes")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Group of every linked document hash."""
    from tessera.llm.components import connected_components

    pairs = table(spark, folder, "neardup_pairs").where((F.col("agree") >= VERIFY_MIN_AGREE) & (F.col("left_hash") != F.col("right_hash")))
    found = connected_components(pairs, "left_hash", "right_hash")
    return found.select(F.col("component").alias("group_hash"), F.col("node").alias("doc_hash"))


def p2_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """The figures that unfinished sweeps leave open: clusters, documents in them, the largest, hashes to drop."""
    sizes = p2_found(spark, folder).groupBy("group_hash").agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("clusters"), F.coalesce(F.sum("n"), F.lit(0)).alias("hashes_in_clusters"), F.coalesce(F.max("n"), F.lit(0)).alias("largest_cluster"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("dropped_unique_hashes"))


def _personal(spark: SparkSession, folder: str) -> DataFrame:
    from tessera.llm.pii import detect

    drops = table(spark, folder, "drops").select(F.lit("drops").alias("tab"), F.col("drop_id").cast("string").alias("rec"), F.col("preview").alias("text"))
    items = table(spark, folder, "eval_set").select(F.lit("eval_set").alias("tab"), F.col("id").alias("rec"), "text")
    return detect(drops.unionByName(items), "text", ["tab", "rec"])


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Kinds of personal information in each preview and evaluation item."""
    return _personal(spark, folder).select("tab", "rec", F.explode(F.array_distinct("spans.kind")).alias("kind")).distinct()


def p3_redacted(spark: SparkSession, folder: str) -> DataFrame:
    """Every text that holds personal information, with typed placeholders in its place."""
    return _personal(spark, folder).where("size(spans) > 0").select("tab", "rec", "redacted", F.size("spans").alias("n_spans")).distinct()


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Records above their shard's cutoff."""
    from tessera.llm.cutoffs import keep_fraction

    return keep_fraction(table(spark, folder, "doc_scores"), table(spark, folder, "keep_targets"))[1]


def p4_report(spark: SparkSession, folder: str) -> DataFrame:
    """Cutoff and kept size of each shard."""
    from tessera.llm.cutoffs import keep_fraction

    return keep_fraction(table(spark, folder, "doc_scores"), table(spark, folder, "keep_targets"))[0]


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Drops whose preview is abusive, hateful or sexually explicit."""
    from tessera.llm.abuse import CASE

    return p5_scores(spark, folder).where(F.col("score") >= CASE).select("drop_id").distinct()


def p5_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Score and evidence of every row of the drops log."""
    from tessera.llm import abuse as A

    drops = table(spark, folder, "drops")
    sample = A.labelled_sample(drops, "drop_id", "preview", table(spark, folder, "labels"), "toxic")
    return A.scores(drops, "preview", ["drop_id", "shard"], sample)


def p5_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Share of abusive previews by source and shard, with totals; a drop logged twice counts once."""
    from tessera.llm.abuse import CASE
    from tessera.llm.tokens import registered_sources

    sources = registered_sources(table(spark, folder, "registry_shards"))
    once = p5_scores(spark, folder).groupBy("drop_id", "shard").agg(F.max("score").alias("score"))
    named = once.join(F.broadcast(sources.withColumnRenamed("shard_id", "shard")), "shard", "left")
    return named.rollup("source", "shard").agg(F.count("*").alias("drops"), F.sum((F.col("score") >= CASE).cast("long")).alias("abusive"), F.round(F.avg((F.col("score") >= CASE).cast("double")), 6).alias("rate"), F.grouping_id().cast("long").alias("level"))


def _language_model(spark: SparkSession, folder: str) -> dict:
    """Dictionaries from a bounded sample of the labelled documents and previews."""
    from tessera.llm import language as L

    names = L.code_names(table(spark, folder, "lang_codes"))
    docs, drops = table(spark, folder, "documents"), table(spark, folder, "drops")
    sample = L.training_sample(docs, L.label_code(F.col("lang"), names), "text", "doc_id")
    return L.train(sample + L.training_sample(drops, L.label_code(F.col("language"), names), "preview", "drop_id"))


def _language_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Segments of every document and preview, written once: ``tab, rec, shard_id, label, segments``."""
    from tessera.llm import language as L
    from tessera.session import materialize

    names = L.code_names(table(spark, folder, "lang_codes"))
    model = _language_model(spark, folder)
    docs = table(spark, folder, "documents").select(F.lit("documents").alias("tab"), F.col("doc_id").cast("string").alias("rec"), "shard_id", L.label_code(F.col("lang"), names).alias("label"), "text")
    drops = table(spark, folder, "drops").select(F.lit("drops").alias("tab"), F.col("drop_id").cast("string").alias("rec"), F.col("shard").alias("shard_id"), L.label_code(F.col("language"), names).alias("label"), "preview")
    keep = ["tab", "rec", "shard_id", "label"]
    return materialize(L.identify(docs, "text", "label", model, keep).unionByName(L.identify(drops, "preview", "label", model, keep, cut_at=PREVIEW_CHARS)), "languages")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Languages that labels do not name."""
    from tessera.llm import language as L

    profile = _language_profile(spark, folder)
    sure = F.expr("filter(segments, s -> s.lang is not null and (s.sentences > 0 or s.confidence >= 0.5 or label is null or label <> s.lang)).lang")
    texts = profile.select("tab", "rec", "label", F.explode(F.array_distinct(sure)).alias("lang")).where("label is null or label <> lang").select("tab", "rec", "lang").distinct()
    # a document's main language is the one with most characters; a shard's the one of most of its documents
    size = "aggregate(filter(segments, s -> s.lang = l), 0L, (n, s) -> n + s.chars)"
    main = F.expr(f"try_element_at(array_sort(transform(array_distinct(filter(segments.lang, l -> l is not null)), l -> struct(-{size} as n, l as lang))), 1).lang")
    of_shard = profile.where("tab = 'documents'").select("shard_id", main.alias("lang")).where("lang is not null and shard_id is not null").groupBy("shard_id", "lang").count()
    most = of_shard.groupBy("shard_id").agg(F.max(F.struct("count", "lang")).alias("m")).select("shard_id", F.col("m.lang").alias("lang"))
    names = L.code_names(table(spark, folder, "lang_codes"))
    labels = table(spark, folder, "registry_shards").select("shard_id", L.label_code(F.col("language"), names).alias("label")).groupBy("shard_id").agg(F.collect_set("label").alias("labels"))
    shards = most.join(F.broadcast(labels), "shard_id").where("not array_contains(labels, lang)")
    return texts.unionByName(shards.select(F.lit("registry_shards").alias("tab"), F.col("shard_id").alias("rec"), "lang"))


def p6_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Every segment of every document and preview with its language and confidence, in order."""
    return _language_profile(spark, folder).select("tab", "rec", "label", F.posexplode("segments").alias("segment", "s")).select("tab", "rec", "label", "segment", F.col("s.lang").alias("lang"), F.round("s.confidence", 4).alias("confidence"), F.col("s.chars").alias("chars"))


def p7_packed(spark: SparkSession, folder: str) -> DataFrame:
    """Container, window, context size and training step of every document for every capacity."""
    from tessera.llm.packing import pack
    from tessera.llm.tokens import token_counts

    return pack(token_counts(table(spark, folder, "documents"), "text", ["doc_id"]), "doc_id", "n_tokens", table(spark, folder, "pack_sizes"))


def p7_report(spark: SparkSession, folder: str) -> DataFrame:
    """Containers, context sizes, tokens and unused space of each capacity, and the tokens of its lightest and heaviest full step."""
    placed = p7_packed(spark, folder).groupBy("pack_id", "container", "context", "step").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("pieces"))
    steps = placed.groupBy("pack_id", "step").agg(F.sum("tokens").alias("t"), F.sum("pieces").alias("pieces"), F.count("*").alias("containers"), F.collect_set("context").alias("contexts"))
    by = steps.groupBy("pack_id").agg(
        F.sum("containers").alias("containers"), F.sum("t").alias("tokens"), F.sum("pieces").alias("pieces"), F.size(F.array_distinct(F.flatten(F.collect_set("contexts")))).cast("long").alias("context_sizes"),
        F.count("*").alias("steps"), F.min("t").alias("least_step_tokens"), F.max("t").alias("most_step_tokens"),
    )
    sizes = table(spark, folder, "pack_sizes").groupBy("pack_id").agg(F.max("capacity_tokens").cast("long").alias("capacity_tokens"))
    return by.join(F.broadcast(sizes), "pack_id").withColumn("unused_share", F.round(1 - F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6))


def _leaks(spark: SparkSession, folder: str) -> DataFrame:
    from tessera.llm.leaks import leaks

    return leaks(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_set"), "id", "text")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Items of which at least eight consecutive words occur in a document."""
    return _leaks(spark, folder).where("kind = 'run'").select("doc_id", "eval_id")


def p8_paraphrases(spark: SparkSession, folder: str) -> DataFrame:
    """Items of which a sentence recurs in a document, word for word or with gaps and changes."""
    return _leaks(spark, folder).where("kind = 'paraphrase'").select("doc_id", "eval_id", "words", F.round("cosine", 4).alias("cosine"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents any part of which was wrongly decoded."""
    return p9_restored(spark, folder).select("doc_id")


def p9_restored(spark: SparkSession, folder: str) -> DataFrame:
    """The restored text of every such document, with the spans replaced and the characters lost."""
    from tessera.llm.encodings import restore_garbled

    return restore_garbled(table(spark, folder, "documents"), "doc_id", "text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in sorted(globals().items()) if k[0] == "p" and k[1:2].isdigit()}
