"""Content identities: 8-byte document ids and digests over sets of them."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space that is stripped off a document before it is hashed.
ASCII_SPACE = " \t\n\r\x0b\x0c"


def doc_hash_bytes(data: bytes) -> bytes:
    """Eight bytes of BLAKE2b over the stripped bytes; read big-endian they are the unsigned id."""
    return hashlib.blake2b(data.strip(), digest_size=8).digest()


@F.pandas_udf(T.BinaryType())
def _doc_hash(texts):
    return texts.map(lambda t: None if t is None else doc_hash_bytes(t.encode()))


def doc_hash(text: Column) -> Column:
    """The document id as BINARY(8), whose byte order is the unsigned order. Null text gives null."""
    return _doc_hash(text)


def identity(text: Column) -> Column:
    """Sixteen bytes that stand for a text wherever equal texts are grouped or joined, made inside the JVM, so that ids are
    shuffled and not texts. Null text gives null. Published ids are :func:`doc_hash`."""
    return F.unhex(F.md5(text))


def ids_digest(ids: DataFrame, column: str = "doc_hash", distinct: bool = True) -> str:
    """BLAKE2b-256 over the ascending ids, each as 8 little-endian bytes.

    The ids are sorted in Spark and streamed to the driver partition by partition, so it holds one partition at a time.
    ``distinct=False`` keeps repeated ids, as attestations of foreign corpora do. Null ids are left out.
    """
    chosen = ids.select(F.col(column).alias("h")).where("h is not null")
    chosen = (chosen.distinct() if distinct else chosen).orderBy("h")
    digest = hashlib.blake2b(digest_size=32)
    for row in chosen.toLocalIterator(prefetchPartitions=True):
        digest.update(bytes(row[0])[::-1])
    return digest.hexdigest()


def ids_tree_digest(ids: DataFrame, column: str = "doc_hash", distinct: bool = True) -> str:
    """BLAKE2b-256 over the digests of the ids' 65,536 classes by their first two bytes, in order; a class without ids is left
    out, one with ids is its two bytes and the digest of its ascending ids.

    The same for any partitioning, and made by the workers: the driver gets one digest a class. Null ids are left out.
    """
    chosen = ids.select(F.col(column).alias("h")).where("h is not null").withColumn("p", F.substring("h", 1, 2))
    chosen = chosen.distinct() if distinct else chosen

    def run(batches):
        import pyarrow as pa

        at, digest, done = None, None, []
        for batch in batches:
            for h in batch.column(0).to_pylist():
                if h[:2] != at:
                    if at is not None:
                        done.append((at, digest.digest()))
                    at, digest = h[:2], hashlib.blake2b(digest_size=32)
                digest.update(h)
        if at is not None:
            done.append((at, digest.digest()))
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.binary()) for i in (0, 1)], ["p", "digest"])

    root = hashlib.blake2b(digest_size=32)
    for row in chosen.repartition("p").sortWithinPartitions("h").select("h").mapInArrow(run, "p binary, digest binary").orderBy("p").collect():
        root.update(bytes(row["p"]) + bytes(row["digest"]))
    return root.hexdigest()


def droplist_sha256(ids: DataFrame, column: str = "doc_hash") -> str:
    """SHA-256 of the sorted drop list as little-endian bytes."""
    digest = hashlib.sha256()
    for row in ids.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).toLocalIterator(prefetchPartitions=True):
        digest.update(bytes(row[0])[::-1])
    return digest.hexdigest()


def rows_sha256(rows: DataFrame) -> str:
    """SHA-256 over the distinct rows of a small table, whatever their order and repetition."""
    each = rows.select(F.sha2(F.to_json(F.struct(*rows.columns)), 256).alias("h")).distinct().orderBy("h")
    digest = hashlib.sha256()
    for row in each.toLocalIterator():
        digest.update(bytes.fromhex(row[0]))
    return digest.hexdigest()
