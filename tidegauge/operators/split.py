"""Train/test split and folds, decided row by row from a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.names import column, require
from tidegauge.functions.values import hash_number
from tidegauge.operators.order_stats import build_grid, keys_at_ranks


def test_share(key: str, share: float, seed: int) -> Column:
    """True on the test rows: the hash of the key falls in the first ``share``."""
    return hash_number(column(key), seed) < int(share * 2**32)


def hash_split(
    df: DataFrame, key: str, share: float = 0.2, seed: int = 42, name: str = "split"
) -> DataFrame:
    """Mark each row ``train`` or ``test``.

    Membership depends on the key alone: the same in every run, on any partitioning. Sizes
    match the share in expectation. Rows without a key are ``train``.
    """
    require(df, [key])
    if not 0.0 < share < 1.0:
        raise ValueError("share must lie between 0 and 1")
    return df.withColumn(name, F.when(test_share(key, share, seed), "test").otherwise("train"))


def train_test(
    df: DataFrame, key: str, share: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """The two parts as separate tables."""
    marked = hash_split(df, key, share, seed, "__split")
    return tuple(
        marked.filter(F.col("__split") == side).drop("__split") for side in ("train", "test")
    )


def folds(
    df: DataFrame, key: str, k: int = 5, shuffled: bool = False, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Number each row 0..k-1: runs of the key order, or hash folds when ``shuffled``.

    Runs have equal length, the first ones a row more when it does not divide. They are cut
    at the keys found at their first ranks, so no global numbering is needed. Rows without a
    key are in fold 0.
    """
    require(df, [key])
    if k < 2:
        raise ValueError("at least two folds are needed")
    if shuffled:
        return df.withColumn(name, (hash_number(column(key), seed) % k).cast("int"))
    grid = build_grid(df, [key])
    if grid.rows < k:
        raise ValueError(f"{grid.rows} rows cannot fill {k} folds")
    size, extra = divmod(grid.rows, k)
    number = F.lit(0)
    for own, start in keys_at_ranks(df, key, [i * size + min(i, extra) for i in range(1, k)], grid):
        number = number + F.when(own >= start, 1).otherwise(0)
    return df.withColumn(name, number.cast("int"))
