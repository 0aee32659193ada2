"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.words import UPPER
from tidegauge.session import checkpointed, findable, shared_folder

__all__ = ["checkpointed", "cleaned", "dropped", "findable", "folder", "lowered", "released", "written"]

#: Spark's setting by which the shuffle files of a query go as soon as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/corpus/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a parquet table in the shared folder, read back.

    It cuts the lineage as ``checkpoint()`` does, but columnar and compressed, which counts
    for tables that hold texts. The shuffles of the write go at its end, not only when the
    driver happens to collect their garbage; that is collected here too, so that what
    finished plans leave never fills a driver with room for far more than is alive.
    """
    path = folder(df.sparkSession, name)
    with cleaned(df.sparkSession):
        df.write.parquet(path)
    released(df.sparkSession)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _folders[table] = path
    return table


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run inside go when each of them ends."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def dropped(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made, once all that is read from them is stored itself."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_folders.pop(table))
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    if tables:
        released(tables[0].sparkSession)


def released(spark: SparkSession) -> None:
    """Let go of what finished steps leave behind.

    Spark deletes shuffle files, checkpoints and compiled plans when the driver collects the
    objects that stand for them, which a driver with room to spare may not do for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def lowered(text):
    """Text with A-Z in lower case and nothing else changed; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
