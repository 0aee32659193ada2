"""Table sources and sinks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.names import column, numeric_columns, require
from tidegauge.functions.values import to_number

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def text_schema(columns: Iterable[str]) -> T.StructType:
    """All columns as text: dirty values survive the read and are coerced later."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    required: Sequence[str] = (),
    multi_line: bool = False,
) -> DataFrame:
    """Read a table and check that ``required`` columns are there.

    ``multi_line`` reads CSV fields with line breaks inside quotes; such files cannot be
    split among tasks.

    A missing path raises ``FileNotFoundError``; a missing column ``ValueError``. Text
    formats never infer types: without a schema their columns are read as strings.
    """
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", schema is None)
        reader = reader.option("multiLine", multi_line).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.format(fmt).load(path)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no table at {path}") from error
        raise
    return require(df, required)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> None:
    """Write a table, partitioned and sorted within files when asked.

    With ``partition_by`` rows are rebalanced on those columns: adaptive execution joins
    small pieces and splits the rows of a hot partition by their size. With ``sort_by``
    alone files hold consecutive ranges, so that they are in order as a whole.
    """
    writer = df
    if partition_by:
        writer = writer.hint("rebalance", *[column(c) for c in partition_by])
    elif sort_by:
        writer = writer.repartitionByRange(*[column(c) for c in sort_by])
    if sort_by:
        writer = writer.sortWithinPartitions(*[column(c) for c in (*partition_by, *sort_by)])
    out = writer.write.mode(mode).format(fmt)
    if fmt == "csv":
        out = out.option("header", True).option("escape", '"')
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.save(path)


def metric_rows(
    spark: SparkSession, run: str, model: str, metrics: Mapping[str, Mapping[str, float]]
) -> DataFrame:
    """``{split: {metric: value}}`` as rows of the metrics table."""
    rows = [
        (run, model, split, name, float(value))
        for split, values in metrics.items()
        for name, value in values.items()
    ]
    return spark.createDataFrame(rows, METRIC_SCHEMA)


def append_metrics(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Append rows ``(run, model, split, metric, value)`` to a metrics table."""
    require(df, METRIC_SCHEMA.fieldNames())
    df.select(METRIC_SCHEMA.fieldNames()).write.mode("append").format(fmt).save(path)


def feature_table(df: DataFrame, target: str) -> DataFrame:
    """Numeric columns of a stored feature table, without rows that lack a target."""
    require(df, [target])
    typed = df.withColumn(target, to_number(column(target)))
    features = numeric_columns(typed, exclude=[target])
    if not features:
        raise ValueError("no numeric feature column is left")
    kept = typed.select(*[column(c) for c in features], column(target))
    return kept.filter(column(target).isNotNull())
