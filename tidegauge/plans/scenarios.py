"""What-if jobs: change rows by a rule, re-score, compare totals and power factor."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.names import column
from tidegauge.operators.clean import update_where
from tidegauge.operators.profile import power_factor, totals_change


def what_if(
    df: DataFrame,
    condition: Column,
    updates: Mapping[str, Column],
    rescore: Callable[[DataFrame], DataFrame],
    target: str,
    prediction: str = "prediction",
) -> DataFrame:
    """Both versions side by side: ``baseline`` is the target as it was, ``scenario`` the
    prediction on the changed rows. The input columns hold the scenario's values."""
    kept = df.withColumn("baseline", column(target))
    scored = rescore(update_where(kept, condition, updates))
    return scored.withColumn("scenario", column(prediction))


def scenario_totals(scenario: DataFrame) -> DataFrame:
    return totals_change(scenario, "baseline", "scenario")


def scenario_power_factor(
    before: DataFrame,
    after: DataFrame,
    time: str,
    active: str,
    lagging: str,
    leading: str,
    new_active: str = "scenario",
) -> DataFrame:
    """Daily power factor before and after, joined by day (one row per day each)."""
    old = power_factor(before, time, active, lagging, leading)
    new = power_factor(after, time, new_active, lagging, leading)
    return old.select("date", F.col("power_factor").alias("pf_baseline")).join(
        new.select("date", F.col("power_factor").alias("pf_scenario")), "date", "left"
    )
