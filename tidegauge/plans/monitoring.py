"""Monitoring jobs: a monitor keeps a reference and reports on current tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.names import require
from tidegauge.operators.drift import (
    ALPHA,
    Profile,
    build_profile,
    column_drift,
    drift_history,
    drift_summary,
    monitored_columns,
    psi_against,
)
from tidegauge.operators.quality import long_metrics, performance
from tidegauge.session import checkpointed
from tidegauge.sources.tables import read_table


@dataclass(frozen=True)
class Monitor:
    """A reference table with the columns to watch."""

    reference: DataFrame
    target: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    prediction: str = "prediction"
    alpha: float = ALPHA

    @staticmethod
    def of(
        reference: DataFrame,
        target: str,
        prediction: str = "prediction",
        time: str = "date",
        numeric: Sequence[str] | None = None,
        categorical: Sequence[str] | None = None,
        alpha: float = ALPHA,
    ) -> "Monitor":
        """Watch the given columns, or all by type but target, prediction and time."""
        found = monitored_columns(reference, target, prediction, time)
        chosen = (found[0] if numeric is None else numeric, found[1] if categorical is None else categorical)
        return Monitor(reference, target, tuple(chosen[0]), tuple(chosen[1]), prediction, alpha)

    @staticmethod
    def from_table(
        spark: SparkSession, path: str, target: str, fmt: str = "parquet", **options
    ) -> "Monitor":
        return Monitor.of(read_table(spark, path, fmt, required=[target]), target, **options)

    def profile(self, buckets: int = 10) -> Profile:
        """Bucket edges and counts of the reference: what a stream or a later job needs."""
        return build_profile(self.reference, self.numeric, buckets)

    def columns(self, current: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
        """Drift per watched column; a watched column that the current table lacks is an error.

        The rows are stored: reports read them more than once.
        """
        numeric, categorical = ([c for c in own if only is None or c in only] for own in (self.numeric, self.categorical))
        return checkpointed(column_drift(self.reference, current, numeric, categorical, alpha=self.alpha))

    def drift_report(self, current: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Summary row with its time, and the rows per column."""
        rows = self.columns(current)
        return drift_summary(rows).withColumn("checked_at", F.current_timestamp()), rows

    def stability(self, current: DataFrame) -> DataFrame:
        return psi_against(self.profile(), current)

    def performance_report(self, current: DataFrame) -> DataFrame:
        """mae, rmse, r2, mape of the current table; both columns must be there."""
        require(current, [self.target, self.prediction])
        return performance(current, self.target, self.prediction)

    def full_report(self, current: DataFrame, key_columns: Sequence[str] | None = None) -> DataFrame:
        """Rows ``(section, item, metric, value)``: drift, its summary, and quality.

        The quality rows are there when target and prediction are.
        """
        rows = self.columns(current, key_columns)
        entry = lambda section, item, names: F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(section).alias("section"),
                        item.alias("item"),
                        F.lit(n).alias("metric"),
                        F.col(n).cast("double").alias("value"),
                    )
                    for n in names
                ]
            )
        )
        drift = rows.select(entry("drift", F.col("column"), ["statistic", "p_value", "drifted"]))
        summary = drift_summary(rows).select(
            entry(
                "summary",
                F.lit("dataset"),
                ["dataset_drift_detected", "number_of_drifted_columns", "share_of_drifted_columns"],
            )
        )
        report = drift.unionByName(summary)
        if {self.target, self.prediction} <= set(current.columns):
            quality = long_metrics(self.performance_report(current), []).select(
                F.lit("performance").alias("section"), F.lit("dataset").alias("item"), "metric", "value"
            )
            report = report.unionByName(quality)
        return report

    def history(self, current: DataFrame, period) -> DataFrame:
        return drift_history(
            self.reference, current, period, self.numeric, self.categorical, self.alpha
        )
