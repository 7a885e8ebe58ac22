"""Continuous ingest: new documents are identified, scored and deduplicated as they land.

The reference data model has no streams; this runs the same operators on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import hashing, lid, quality
from tessera.session import shared_dir


def landing(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 64) -> DataFrame:
    """Parquet files of a landing folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def scored(stream: DataFrame, text: str = "text", at: str = "acquired_at", late: str = "1 day") -> DataFrame:
    """The stream with content identity, script and quality, each identity once within the watermark.

    State is bounded by the watermark: a copy that comes later than ``late`` is caught by the keep-first of the batch build.
    """
    d = stream.where(F.col(text).isNotNull() & F.col(at).isNotNull()).withColumn("doc_hash", hashing.doc_hash(F.col(text)))
    d = d.withWatermark(at, late).dropDuplicatesWithinWatermark(["doc_hash"])
    d = d.withColumn("script", lid.dominant(lid.script_counts(F.col(text)))["script"])
    return quality.metrics(d, text)


def hourly(stream: DataFrame, at: str = "acquired_at", late: str = "2 hours") -> DataFrame:
    """Documents and bytes by hour and shard; an hour is final when the watermark has passed it."""
    return stream.withWatermark(at, late).groupBy(F.window(at, "1 hour").alias("hour"), "shard_id").agg(F.count("*").alias("docs"), F.sum(F.octet_length("text")).alias("bytes"))


def start(df: DataFrame, path: str, name: str):
    """Append to a table; the checkpoint lies in the shared folder, so a restart goes on where the last batch ended."""
    where = f"{shared_dir(df.sparkSession)}/stream-{name}"
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", where).outputMode("append").trigger(availableNow=True).start()
