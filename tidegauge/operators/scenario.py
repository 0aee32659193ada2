"""What-if scenarios: deterministic changes of columns, with given factors."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.names import column, require
from tidegauge.operators.clean import hash_fraction


def shift_scale(
    df: DataFrame, factors: Mapping[str, tuple[float, float]]
) -> DataFrame:
    """``value * scale + shift`` for each column of ``{column: (scale, shift)}``."""
    require(df, factors)
    return df.withColumns({c: column(c) * scale + shift for c, (scale, shift) in factors.items()})


def mask_share(df: DataFrame, name: str, key: str, share: float, seed: int = 42) -> DataFrame:
    """Column to NULL on about ``share`` of the keys, chosen by hash."""
    require(df, [name, key])
    return df.withColumn(name, F.when(~hash_fraction(key, share, seed), column(name)))
