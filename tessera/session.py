"""Session settings and durable cuts of lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "tessera", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the session is given from outside."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one only where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        folder = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(folder)
        return shared_dir(spark)
    return folder


def materialize(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The written files survive lost executors, so everything downstream restarts from here. The folder is
    removed when the driver ends. Empty inputs give an empty table with the same schema.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001  the session may be gone already
        pass


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores: few files with large row groups give few tasks, too few for
    work that costs more than a shuffle of its input. Inputs of many files stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
