"""Exploratory job: clean, cap, profile, correlate, compare with a second dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidegauge.functions.names import resolve
from tidegauge.operators.clean import threshold
from tidegauge.operators.profile import cap, compare_quantile, correlation, describe
from tidegauge.plans.cleaning import clean
from tidegauge.roles import Roles
from tidegauge.session import stored

# Plausible upper limits of an energy reading.
TARGET_CAP = 157.0
SECOND_CAP = 0.070
SECOND_PERCENTILES = (0.05, 0.25, 0.5, 0.75, 0.96, 0.99, 0.995)


def explore(
    df: DataFrame,
    roles: Roles,
    profiled: str,
    capped: str,
    target_cap: float | None = TARGET_CAP,
    second_cap: float = SECOND_CAP,
    other: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Tables of an exploration, by name.

    ``profiled`` is described after the target cap, ``capped`` is described and cut at
    ``second_cap``. With ``other`` the target's 99th percentile is compared. The cleaned
    tables are stored once; all others are made from them.
    """
    tidy = stored(clean(df, roles), "clean")
    target = resolve(tidy, [roles.target])
    within, _ = cap(tidy, target, target_cap)
    second = resolve(within, [capped])
    final = threshold(within, second, upper=second_cap)
    tables = {
        "clean": tidy,
        "within_target_cap": within,
        "final": final,
        "target_before": describe(tidy, [target]),
        "target_after": describe(within, [target]),
        "profile": describe(within, [resolve(within, [profiled])]),
        "second_profile": describe(within, [second], SECOND_PERCENTILES),
        "correlation": correlation(final),
    }
    if other is not None:
        original = stored(clean(other, roles), "original")
        tables["other_correlation"] = correlation(original)
        tables["percentile_comparison"] = compare_quantile(
            {"original": original, "modified": final}, target
        )
    return tables
