"""Near duplicates: word shingles, MinHash, banding, verification, clusters and the drop list."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.binding import let
from tessera.functions.quality import SPACE
from tessera.session import materialize

# Parameters of the published signatures.
SHINGLE_WORDS, NUM_PERM, BANDS, ROWS, VERIFY_MIN_AGREE, SEED = 5, 32, 8, 4, 21, 7
#: What decides which documents are near duplicates; part of a build's configuration.
PARAMETERS = {"shingle_words": SHINGLE_WORDS, "num_perm": NUM_PERM, "bands": BANDS, "lsh_rows": ROWS, "verify_min_agree": VERIFY_MIN_AGREE, "seed": SEED, "exemplar_rule": "least identity"}
#: Modulus of the variant that SQL can compute, and its multipliers' seed.
SQL_PRIME = 2147483647
#: Members of a bucket that one worker compares among themselves; larger buckets are divided.
MOST_HELD = 4096


def words_for_shingles(text: Column, max_words: int | None = None) -> Column:
    """Lower-case words between white space."""
    trimmed = F.regexp_replace(F.lower(text), rf"^[{SPACE}]+|[{SPACE}]+$", "")
    words = F.split(trimmed, rf"[{SPACE}]+")
    return F.slice(words, 1, max_words) if max_words else words


def shingles(words: Column, n: int = SHINGLE_WORDS) -> Column:
    """Runs of n words, joined by blanks; null for fewer than n words. Repeated shingles are kept."""
    return let(words, lambda ws: F.when(F.size(ws) >= n, F.transform(F.sequence(F.lit(1), F.size(ws) - (n - 1)), lambda i: F.concat_ws(" ", F.slice(ws, i, n)))))


@lru_cache(1)
def _constants() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.RandomState(SEED)
    return rng.randint(1, 2**61 - 1, NUM_PERM, dtype=np.uint64), rng.randint(0, 2**61 - 1, NUM_PERM, dtype=np.uint64)


_BLANKS = re.compile(f"[{SPACE}]+".replace(r"\x0B", "\x0b"))


def signature_of(text: str | None, max_words: int | None = None) -> list[int] | None:
    """MinHash of the CRC-32 of the shingles: (a x + b mod 2^64) mod 2^61-1, least over the shingles; null for fewer than five words."""
    if text is None:
        return None
    words = text.lower().split()
    words = words[:max_words] if max_words else words
    if len(words) < SHINGLE_WORDS:
        return None
    crc = {zlib.crc32(" ".join(words[i : i + SHINGLE_WORDS]).encode()) for i in range(len(words) - SHINGLE_WORDS + 1)}
    x = np.fromiter(crc, np.uint64, len(crc))
    a, b = _constants()
    least = np.full(NUM_PERM, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(x), 4096):
            h = (a[:, None] * x[None, at : at + 4096] + b[:, None]) % np.uint64(2**61 - 1)
            least = np.minimum(least, h.min(axis=1))
    return least.astype(np.int64).tolist()


def signatures(df: DataFrame, text: str, max_words: int | None = None) -> DataFrame:
    """``sig`` beside every row; null for null texts and texts of fewer than five words."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def sign(texts):
        return texts.map(lambda t: signature_of(t, max_words))

    return df.withColumn("sig", sign(F.col(text)))


def sql_multipliers(n: int = NUM_PERM) -> list[tuple[int, int]]:
    """Multipliers below 2^31 for the variant in which no product overflows."""
    rng = np.random.RandomState(SEED)
    a, b = rng.randint(1, SQL_PRIME, n, dtype=np.int64), rng.randint(0, SQL_PRIME, n, dtype=np.int64)
    return list(zip(a.tolist(), b.tolist(), strict=True))


def sql_signature(shingle_array: Column, n: int = NUM_PERM) -> Column:
    """MinHash inside the JVM: shingles hashed by the first eight digits of their MD5."""
    hashes = F.transform(shingle_array, lambda s: F.conv(F.substring(F.md5(s.cast("binary")), 1, 8), 16, 10).cast("long"))

    def least(h: Column, a: int, b: int) -> Column:
        return F.array_min(F.transform(h, lambda x: (x * a + b) % SQL_PRIME))

    return F.when(shingle_array.isNotNull(), let(hashes, lambda h: F.array(*[least(h, a, b) for a, b in sql_multipliers(n)])))


def agree(a: Column, b: Column) -> Column:
    """Equal positions of two signatures."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)


def _part(sig: Column, mask: int, *within: Column) -> Column:
    """Identity of a bucket: the rows of the mask and their values, and what buckets are kept within."""
    return F.struct(F.lit(mask).cast("long").alias("mask"), F.xxhash64(F.array(*[F.get(sig, F.lit(i)) for i in range(NUM_PERM) if mask >> i & 1]), *within).alias("code"))


def _finer(mask: int, min_agree: int) -> list[int]:
    """Masks that divide a bucket without loss. Members that agree in ``min_agree`` rows differ in at most NUM_PERM - min_agree,
    so of one block more than that, cut from the rows outside the mask, at least one is equal."""
    free = [i for i in range(NUM_PERM) if not mask >> i & 1]
    blocks = NUM_PERM - min_agree + 1
    return [mask | sum(1 << i for i in free[at::blocks]) for at in range(blocks)] if len(free) >= blocks else []


def _link_buckets(min_agree: int):
    """Links between members of whole buckets, which come sorted: every member is compared with all later ones not connected to it yet."""

    def of_bucket(keys: list, sigs: np.ndarray, known: list) -> Iterator[tuple]:
        ids = {}
        group = np.array([ids.setdefault(x, len(ids)) for x in known])
        for i in range(len(keys) - 1):
            other = i + 1 + np.flatnonzero(group[i + 1 :] != group[i])
            hits = other[(sigs[other] == sigs[i]).sum(axis=1) >= min_agree] if len(other) else other
            for g in np.unique(group[hits]).tolist():
                yield keys[hits[group[hits] == g][0]], keys[i]
                group[group == g] = group[i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, ([], [], [])
        kind = None
        for batch in batches:
            kind = batch.column(2).type
            out = []
            for mask, code, k, sig, label in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if (mask, code) != at:
                    out += of_bucket(held[0], np.array(held[1], np.int64), held[2])
                    at, held = (mask, code), ([], [], [])
                for column, value in zip(held, (k, sig, label), strict=True):
                    column.append(value)
            yield _pairs(out, kind)
        if held[0]:
            yield _pairs(list(of_bucket(held[0], np.array(held[1], np.int64), held[2])), kind)

    return run


def _pairs(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], kind) for i in range(2)], ["left", "right"])


def links(signed: DataFrame, key: str, min_agree: int = VERIFY_MIN_AGREE, bands: int = BANDS, rows: int = ROWS, most_held: int = MOST_HELD, within: str | None = None) -> DataFrame:
    """``(left, right)``: verified links that connect all members of a band's bucket which agree, directly or over others of it.

    Buckets are aggregated to their least key and joined back, so a bucket that holds a third of all rows is never
    collected, and links grow with its members, not with their pairs. Where that key rejects members, those and the
    accepted ones are compared among themselves: in one worker up to ``most_held`` members, larger buckets after they
    are divided by further rows, which separates no members that agree. Signatures that are equal are linked once before
    the banding, so copies do not pass through every band. Bands hold keys only; signatures are fetched for members of
    buckets of two or more. ``within``: a column whose values no link crosses.
    """
    own = F.col(within) if within else F.lit(0)
    have = signed.where(F.col("sig").isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("k"), "sig", own.alias("w"))
    kind = have.schema["k"].dataType.simpleString()
    same = materialize(have.groupBy("w", "sig").agg(F.min("k").alias("rep")), "kinds")
    found = have.join(same, ["w", "sig"]).where("k <> rep").select(F.col("k").alias("left"), F.col("rep").alias("right")).distinct()
    sigs = same.select(F.col("rep").alias("k"), "sig", "w")
    first = F.array(*[_part(F.col("sig"), (1 << rows) - 1 << rows * i, F.col("w")) for i in range(bands)])
    # members that have the same label are connected already
    at = sigs.select("k", F.col("k").alias("label"), F.explode(first).alias("b")).select("b.mask", "b.code", "k", "label")
    while True:
        members = materialize(at, "bands")
        reps = members.groupBy("mask", "code").agg(F.min(F.struct("k", "label")).alias("r"), F.count("*").alias("n"), F.min("label").alias("a"), F.max("label").alias("z")).where("n > 1 and a <> z")
        # one row for each bucket fetches the representative's signature, so no key is hot there
        reps = materialize(reps.select("mask", "code", "n", F.col("r.k").alias("rep"), F.col("r.label").alias("rep_label")).join(sigs.select(F.col("k").alias("rep"), F.col("sig").alias("rep_sig")), "rep"), "reps")
        both = members.join(reps, ["mask", "code"]).join(sigs.select("k", "sig"), "k")
        near = F.col("k").eqNullSafe(F.col("rep")) | (agree(F.col("sig"), F.col("rep_sig")) >= min_agree)
        met = materialize(both.select("mask", "code", "k", "n", "rep", near.alias("near"), F.when(near, F.col("rep_label")).otherwise(F.col("label")).alias("label")), "met")
        found = found.unionByName(met.where("near and k <> rep").select(F.col("k").alias("left"), F.col("rep").alias("right")))
        unlike = met.where("n > 2").groupBy("mask", "code").agg(F.min("label").alias("a"), F.max("label").alias("z")).where("a <> z").select("mask", "code")
        # the representative has been compared with all
        open_ = materialize(met.where("n > 2 and k <> rep").join(unlike, ["mask", "code"]).select("mask", "code", "k", "label", "n"), "open")
        held = open_.where(F.col("n") <= most_held).drop("n").join(sigs.select("k", "sig"), "k").select("mask", "code", "k", "sig", "label")
        held = held.repartition("mask", "code").sortWithinPartitions("mask", "code", "k")
        found = found.unionByName(held.mapInArrow(_link_buckets(min_agree), f"left {kind}, right {kind}"))
        large = open_.where(F.col("n") > most_held)
        masks = [r[0] for r in large.select("mask").distinct().collect()]
        if not masks:
            return found.distinct()
        pieces = F.lit(None).cast("array<struct<mask: bigint, code: bigint>>")
        for mask in masks:
            if finer := _finer(mask, min_agree):
                pieces = F.when(F.col("mask") == mask, F.array(*[_part(F.col("sig"), m, F.col("w")) for m in finer])).otherwise(pieces)
        # one division may be reached over several others
        at = large.join(sigs, "k").select("k", "label", F.explode(pieces).alias("b")).groupBy("b", "k").agg(F.min("label").alias("label")).select("b.mask", "b.code", "k", "label")


def components(edges: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """``(node, component)`` of an edge list, the component being its least node, by alternating large and small stars.

    Every round points neighbours to the least one they know; each round's edges are written, and the edges stop changing
    after a number of rounds that grows with the logarithm of the longest chain; only then is the result returned. Minima
    are aggregated before the shuffle, and a node in very many edges is one row on the other side of the join, whose hot
    partition AQE splits.
    """
    e = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u > v").distinct()
    e = materialize(e, "edges")
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").unionByName(small_least.select("u", F.col("m").alias("v"))).distinct()
        e = materialize(small, "edges")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct()).distinct()


def clusters(docs: DataFrame, key: str, text: str, min_agree: int = VERIFY_MIN_AGREE, max_words: int | None = None) -> DataFrame:
    """``(key, cluster)`` of every document: the least key of its near-duplicate cluster, itself if it has none."""
    return sweep(docs, key, text, min_agree, max_words)[0]


def sweep(docs: DataFrame, key: str, text: str, min_agree: int = VERIFY_MIN_AGREE, max_words: int | None = None, within: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(clusters, signatures, links)`` of all documents, both latter written tables. Every document has one signature row,
    null for too few words; a different number of rows raises."""
    own = [within] if within else []
    signed = materialize(signatures(docs.select(key, text, *own), text, max_words).select(key, "sig", *own), "signatures")
    if signed.count() != docs.count():
        raise ValueError("signatures are not those of these documents")
    linked = materialize(links(signed, key, min_agree, within=within), "links")
    found = components(linked).select(F.col("node").alias(key), "component")
    return signed.select(key).join(found, key, "left").select(key, F.coalesce("component", key).alias("cluster")), signed, linked


def sweep_stats(clustered: DataFrame, signed: DataFrame, linked: DataFrame, identity: str) -> DataFrame:
    """One row: the cluster figures, documents with a signature, verified links, and identities to drop. ``clustered`` has
    ``identity`` beside key and cluster."""
    rows = [cluster_stats(clustered), signed.agg(F.count("sig").alias("shingleable")), linked.agg(F.count("*").alias("verified_pairs")), drop_list(clustered, identity).agg(F.count("*").alias("dropped_unique_hashes"))]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return every.agg(*[F.max(c).alias(c) for c in every.columns])


def within_shards(docs: DataFrame, key: str, text: str, shard: str) -> DataFrame:
    """``(shard, near_dup_rate)``: the share of a shard's documents that is not the first of its cluster in the shard."""
    clustered = sweep(docs, key, text, within=shard)[0].join(docs.select(key, shard), key)
    per = clustered.groupBy(shard, "cluster").agg(F.count("*").alias("n"))
    return per.groupBy(shard).agg(F.round((F.sum("n") - F.count("*")) / F.sum("n"), 6).alias("near_dup_rate"))


def drop_list(clustered: DataFrame, identity: str) -> DataFrame:
    """Identities to drop: of each cluster all but the least identity; clusters of exact copies drop nothing."""
    kept = clustered.groupBy("cluster").agg(F.min(identity).alias("_kept"))
    return clustered.join(kept, "cluster").where(F.col(identity) != F.col("_kept")).select(identity).distinct()


def cluster_stats(clustered: DataFrame) -> DataFrame:
    """Documents, clusters of two or more, documents in them and the largest."""
    sizes = clustered.groupBy("cluster").agg(F.count("*").alias("n"))
    many = F.col("n") > 1
    z = lambda c: F.coalesce(c, F.lit(0))
    return sizes.agg(z(F.sum("n")).alias("docs"), F.count(F.when(many, 1)).alias("clusters"), z(F.sum(F.when(many, F.col("n")))).alias("docs_in_clusters"), z(F.max(F.when(many, F.col("n")))).alias("largest_cluster"))
