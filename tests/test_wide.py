"""Correlation of many columns by matrix products."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from tidegauge.operators.profile import WIDE, correlation
from tidegauge.operators.wide import wide_correlation


def _frame(n, rows=300):
    rng = np.random.default_rng(n)
    base = rng.normal(size=(rows, n)) + rng.normal(size=(rows, 1))
    data = pd.DataFrame(base * 10.0 ** (np.arange(n) % 5) + 1e7, columns=[f"x.{i}" for i in range(n)])
    data[rng.random((rows, n)) < 0.2] = np.nan
    return data


def _same(found, want):
    got = {(r.a, r.b): r.r for r in found.collect()}
    assert len(got) == len(want) ** 2
    for a in want.columns:
        for b in want.columns:
            w, g = want.loc[a, b], got[a, b]
            assert (g is None and np.isnan(w)) or g == pytest.approx(w, abs=1e-8), (a, b)


def test_wide_equals_pairwise_complete(spark):
    data = _frame(WIDE + 5)
    df = spark.createDataFrame(data).repartition(5)
    _same(correlation(df), data.corr())


@pytest.mark.parametrize("block", [3, 4, 100])
def test_blocks_of_columns_and_flat_ones(spark, block):
    data = _frame(7)
    data["flat"] = 123456.789
    data["absent"] = np.nan
    # Constant where it meets the first column, not as a whole.
    data["half"] = np.where(data["x.0"].isna(), np.arange(len(data)), 5.0)
    want = data.corr()
    assert np.isnan(want.loc["x.0", "half"])
    _same(wide_correlation(spark.createDataFrame(data).repartition(3), list(data.columns), block), want)


def test_empty_and_infinite(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert [r.r for r in wide_correlation(empty, ["a", "b"]).collect()] == [None] * 4
    df = spark.createDataFrame([(1.0, 1.0, 3.0), (2.0, float("inf"), 1.0), (3.0, 0.0, 2.0)], "a double, b double, c double")
    got = {(r.a, r.b): r.r for r in wide_correlation(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] is None and got["b", "b"] is None
    assert got["a", "c"] == pytest.approx(-0.5)


def test_three_hundred_columns(spark):
    data = _frame(300, 60)
    got = correlation(spark.createDataFrame(data)).filter("a = 'x.7' and b = 'x.250'").first()
    assert got.r == pytest.approx(data["x.7"].corr(data["x.250"]))
