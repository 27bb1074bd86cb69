"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# All of these may be changed on a running session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when that costs one more shuffle further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Join by hashing instead of sorting where the measured partitions of one side are this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Rows that are dealt by some of the keys of a join are where it needs them (skew.dealt; salted joins deal by all of theirs).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to an existing session (sizing is left to the cluster)."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("closebook")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="closebook-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only where that is unset, and then
    only in a local session, a temporary folder takes its place.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for an intermediate table below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/closebook/{name}-{uuid.uuid4().hex}"


# For tables that hold hashes as text, which other codecs leave as long as they are.
COMPACT = "zstd"


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write a shared intermediate result once and read it back, which also cuts its lineage."""
    path = scratch_path(df.sparkSession, name)
    return _write_and_read(df, path, compression)


def _write_and_read(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, folder: str, name: str | None = None) -> tuple:
    """The file system of a folder, and the folder (or a file of it) as that file system's path."""
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    path = paths(folder) if name is None else paths(paths(folder), name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all it holds, if there is one."""
    fs, location = hadoop_path(spark, path)
    fs.delete(location, True)


class Scratch:
    """Intermediate tables that are deleted at the end of a ``with`` block."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        return _write_and_read(df, path, COMPACT)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for path in self.paths:
            delete(self.spark, path)
