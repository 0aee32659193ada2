from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegauge.operators.order_stats import (
    build_grid,
    nth_row,
    quantile_values,
    quantiles,
    values_at_ranks,
    with_rank,
)

SHARES = {"lo": 0.01, "q1": 0.25, "mid": 0.5, "q3": 0.75, "hi": 0.995}


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    n = 3000
    return pd.DataFrame(
        {
            "id": np.arange(n),
            "g": rng.choice(["a", "b", "c"], n, p=[0.7, 0.2, 0.1]),
            "skewed": np.exp(rng.normal(0, 2, n)),
            "hot": np.where(rng.random(n) < 0.4, 5.0, rng.normal(0, 10, n)),
            "few": rng.integers(0, 4, n).astype(float),
            "gaps": np.where(rng.random(n) < 0.2, np.nan, rng.normal(0, 1, n)),
        }
    )


@pytest.fixture(scope="module")
def table(spark, frame):
    return spark.createDataFrame(frame).repartition(7).persist()


COLUMNS = ["skewed", "hot", "few", "gaps"]


@pytest.mark.parametrize("rows_per_cell,intervals", [(2_000_000, 512), (20, 16), (1, 8)])
def test_quantiles_match_pandas_whatever_the_cells(table, frame, rows_per_cell, intervals):
    grid = build_grid(table, COLUMNS, rows_per_cell=rows_per_cell, intervals=intervals)
    found = quantile_values(table, COLUMNS, SHARES, grid)
    for name in COLUMNS:
        for label, share in SHARES.items():
            assert found[name][label] == pytest.approx(frame[name].quantile(share), rel=1e-12)


def test_quantiles_by_group(table, frame):
    rows = quantiles(table, ["skewed", "hot"], SHARES, by=["g"]).collect()
    assert len(rows) == 6
    for row in rows:
        part = frame[frame.g == row["g"]][row["column"]]
        assert row["n"] == len(part)
        for label, share in SHARES.items():
            assert row[label] == pytest.approx(part.quantile(share), rel=1e-12)


def test_partitioning_and_order_do_not_matter(table):
    shuffled = table.orderBy(F.rand(5)).repartition(3)
    assert quantile_values(table, COLUMNS, SHARES) == quantile_values(shuffled, COLUMNS, SHARES)


def test_all_missing_and_single_values(spark):
    df = spark.createDataFrame([(None, 4.0), (None, 4.0)], "x double, y double")
    found = quantile_values(df, ["x", "y"], {"m": 0.5})
    assert found == {"x": {"m": None}, "y": {"m": 4.0}}


def test_shares_are_checked(table):
    with pytest.raises(ValueError):
        quantiles(table, ["few"], {"bad": 1.5})


@pytest.mark.parametrize("key", ["skewed", "hot", "few", "gaps", "id"])
def test_rank_matches_pandas(table, frame, key):
    ranked = with_rank(table, key).select("id", "rank", "rank_rows").toPandas()
    merged = frame.merge(ranked, on="id")
    assert len(merged) == len(frame)
    expected = merged[key].rank(method="min") - 1
    known = merged[key].notna()
    assert (merged["rank"][known] == expected[known]).all()
    assert merged["rank"][~known].isna().all()
    assert set(merged["rank_rows"][known]) == {known.sum()}


def test_rank_with_split_cells(table, frame):
    grid = build_grid(table, ["hot"], rows_per_cell=5, intervals=8)
    assert grid.splits > 1
    merged = frame.merge(with_rank(table, "hot", grid=grid).select("id", "rank").toPandas(), on="id")
    assert (merged["rank"] == merged["hot"].rank(method="min") - 1).all()


def test_nth_row_and_ranks(table, frame):
    ordered = frame.sort_values("skewed").reset_index(drop=True)
    assert nth_row(table, "skewed", 1234).first()["id"] == ordered.loc[1234, "id"]
    assert nth_row(table, "skewed", 99999).count() == 0
    assert values_at_ranks(table, "skewed", [0, 2999]) == [frame.skewed.min(), frame.skewed.max()]


def test_rows_of_one_hot_value_spread_over_window_partitions(spark):
    df = spark.range(5000).withColumn("x", F.when(F.col("id") < 4000, 7.0).otherwise(F.col("id").cast("double")))
    grid = build_grid(df, ["x"])
    assert 7.0 in grid.frequent[0]
    ranked = with_rank(df, "x", grid=grid)
    assert {r["rank"] for r in ranked.filter("x = 7.0").select("rank").distinct().collect()} == {0}
    assert ranked.agg(F.max("rank")).first()[0] == 4999


def test_wide_keys_are_told_apart(spark):
    from tidegauge.operators.order_stats import nth_row
    from tidegauge.operators.split import folds

    df = spark.range(8).select((F.col("id") + (1 << 60)).alias("key"))
    assert [r["key"] for r in nth_row(df, "key", 3).collect()] == [(1 << 60) + 3]
    marked = folds(df, "key", 4).orderBy("key").collect()
    assert [r["fold"] for r in marked] == [0, 0, 1, 1, 2, 2, 3, 3]


def test_an_outlier_does_not_stretch_the_parts(spark):
    """Log-normal values with one at 1e15: no part holds many times its share."""
    from tidegauge.operators.order_stats import long_cells, quantile_values, with_rank

    rng = np.random.default_rng(8)
    values = np.append(rng.lognormal(size=60_000), 1e15)
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    grid = build_grid(df, ["x"], rows_per_cell=3, intervals=64)
    assert grid.splits > 1
    sizes = [r["count"] for r in long_cells(df, grid).groupBy("cell", "part").count().collect()]
    assert max(sizes) <= 12 * len(values) / (64 * grid.splits)
    found = quantile_values(df, ["x"], {"p": 0.995, "m": 0.5}, grid)["x"]
    assert found["p"] == np.quantile(values, 0.995) and found["m"] == np.quantile(values, 0.5)
    ranked = with_rank(df, "x", grid=grid).toPandas()
    assert (ranked["rank"].to_numpy() == pd.Series(ranked["x"]).rank(method="min").to_numpy() - 1).all()
