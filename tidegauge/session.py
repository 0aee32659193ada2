"""Session settings and size-checked broadcast."""

from __future__ import annotations

import tempfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table, in bytes, that operators ship to every executor on purpose.
BROADCAST_BYTES = 64 * 1024 * 1024

# Adaptive execution re-plans joins from real sizes and splits skewed partitions.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int = 8, app: str = "tidegauge", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in ADAPTIVE.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def findable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from any working directory.

    A cluster gets it as any Python dependency, for example by ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[1])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{paths}".rstrip(":")


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="tidegauge-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared folder, for small reused tables."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a parquet table in the shared folder, read back: for large reused tables."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int = 64) -> DataFrame:
    """Broadcast ``df`` when ``rows``, a bound known before the join, is small enough.

    Otherwise no hint: Spark joins by shuffle and splits skewed partitions.
    """
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df
