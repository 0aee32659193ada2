"""Quality of predictions: one aggregate gives every regression metric."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.names import column, require

METRICS = ("rmse", "mae", "r2", "mape")


def metric_columns(actual: Column, predicted: Column) -> dict[str, Column]:
    """Mergeable aggregates: rmse, mae, r2 and mape (over actual <> 0), plus n."""
    known = actual.isNotNull() & predicted.isNotNull()
    y, p = F.when(known, actual.cast("double")), F.when(known, predicted.cast("double"))
    error = y - p
    squares = F.sum(error * error)
    spread = F.var_pop(y) * F.count(y)
    return {
        "n": F.count(y),
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "r2": 1 - F.try_divide(squares, spread),
        "mape": F.avg(F.abs(error / F.nullif(y, F.lit(0.0)))) * 100,
    }


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    """n, rmse, mae, r2 and mape per group in a single pass."""
    require(df, [actual, predicted, *by])
    named = [c.alias(n) for n, c in metric_columns(column(actual), column(predicted)).items()]
    return df.groupBy(*[column(c) for c in by]).agg(*named)


def split_metrics(df: DataFrame, actual: str, predicted: str, split: str = "split") -> DataFrame:
    """One row: RMSE and MAE of the test part, R2 of both, in one aggregate."""
    require(df, [actual, predicted, split])
    part = column(split)
    sides = {}
    for side in ("train", "test"):
        here = part == side
        sides[side] = metric_columns(
            F.when(here, column(actual)), F.when(here, column(predicted))
        )
    return df.agg(
        sides["train"]["rmse"].alias("rmse_train"),
        sides["test"]["rmse"].alias("rmse_test"),
        sides["test"]["mae"].alias("mae_test"),
        sides["train"]["r2"].alias("r2_train"),
        sides["test"]["r2"].alias("r2_test"),
    )


def long_metrics(metrics: DataFrame, keys: Sequence[str], names: Sequence[str] = METRICS) -> DataFrame:
    """Metric columns to rows ``(keys, metric, value)``."""
    entries = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in names]
    return metrics.select(*[column(c) for c in keys], F.inline(F.array(*entries)))


def performance(
    df: DataFrame, target: str, prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Model quality of scored data; both columns must exist."""
    return regression_metrics(df, target, prediction, by)


def degradation(
    datasets: Mapping[str, DataFrame], target: str, prediction: str = "prediction"
) -> DataFrame:
    """rmse and r2 of several scored datasets side by side, one row per label."""
    labelled = None
    for label, df in datasets.items():
        require(df, [target, prediction])
        part = df.select(F.lit(label).alias("dataset"), column(target), column(prediction))
        labelled = part if labelled is None else labelled.unionByName(part)
    return regression_metrics(labelled, target, prediction, ["dataset"]).select(
        "dataset", "n", "rmse", "r2"
    )


def residuals(df: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    """Add ``residual`` = target - prediction."""
    require(df, [target, prediction])
    return df.withColumn("residual", column(target) - column(prediction))
