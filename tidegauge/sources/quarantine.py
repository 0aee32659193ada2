"""CSV with malformed records: good rows to one folder, raw lines of bad ones to another."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATE, FILE, RECORD = "_state", "_file", "_record"


@dataclass(frozen=True)
class Quarantine:
    """What ``quarantined`` stored.

    ``good``: rows that fit the schema. ``bad``: (file, record), the raw text of the others.
    ``counts``: (file, good, bad) of every file that holds a record.
    """

    good: DataFrame
    bad: DataFrame
    counts: DataFrame


def quarantined(
    spark: SparkSession, path: str, schema: T.StructType, out: str, header: bool = True, multi_line: bool = False, mode: str = "error"
) -> Quarantine:
    """Read CSV and store its rows under ``out``, well-formed and malformed ones apart.

    A record is malformed if it has too few or too many fields, a quote that never closes, or
    a value that is not of its column's type. None is lost: good and bad rows are all records
    (blank lines are none). One scan of the text writes both folders; the rest reads what was
    stored. ``multi_line`` allows line breaks inside quotes; files are not split then, and a
    quote that never closes takes the rest of its file into one bad record. With ``header``, a
    header that does not fit the schema is an error. ``mode`` is that of the write.
    """
    taken = {STATE, FILE, RECORD} & {f.name.lower() for f in schema}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are needed for the quarantine")
    # Values may be absent whatever the schema says.
    fields = [T.StructField(f.name, f.dataType, True) for f in schema]
    reader = spark.read.schema(T.StructType([*fields, T.StructField(RECORD, T.StringType())]))
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD)
    # A pruned column would not be parsed, and its faults not be seen.
    reader = reader.option("columnPruning", False).option("escape", '"').option("multiLine", multi_line)
    try:
        raw = reader.option("header", header).option("enforceSchema", not header).csv(path)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no table at {path}") from error
        raise
    state = F.when(F.col(RECORD).isNull(), "good").otherwise("bad")
    marked = raw.withColumns({FILE: F.col("_metadata.file_path"), STATE: state})
    marked.write.mode(mode).partitionBy(STATE).parquet(out)
    stored = T.StructType([*fields, *(T.StructField(c, T.StringType()) for c in (RECORD, FILE, STATE))])
    held = spark.read.schema(stored).parquet(out)
    counts = held.groupBy(F.col(FILE).alias("file")).agg(
        F.count_if(F.col(STATE) == "good").alias("good"), F.count_if(F.col(STATE) == "bad").alias("bad")
    )
    good = held.filter(F.col(STATE) == "good").drop(RECORD, FILE, STATE)
    bad = held.filter(F.col(STATE) == "bad").select(F.col(FILE).alias("file"), F.col(RECORD).alias("record"))
    return Quarantine(good, bad, counts)
