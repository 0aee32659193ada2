from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import column
from tidegauge.functions.calendar import DAY_NAMES
from tidegauge.operators import profile as P
from tidegauge.plans.exploring import explore
from tidegauge.roles import ENERGY_ROLES


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(5)
    n = 800
    x = rng.normal(50, 10, n)
    x[::97] = np.nan
    return pd.DataFrame(
        {
            "ts": pd.date_range("2024-01-01", periods=n, freq="15min"),
            "x": x,
            "y": x * 0.5 + rng.normal(0, 3, n),
            "c": rng.choice(["u", "v"], n),
        }
    )


@pytest.fixture(scope="module")
def table(spark, frame):
    return spark.createDataFrame(frame).withColumn("ts", F.col("ts").cast("timestamp_ntz")).persist()


def test_describe(table, frame):
    row = P.describe(table, ["x"], (0.05, 0.5, 0.995)).first()
    expected = frame.x.describe(percentiles=[0.05, 0.5, 0.995])
    for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("p5", "5%"), ("p99_5", "99.5%"), ("max", "max")):
        assert row[ours] == pytest.approx(expected[theirs])
    near = P.describe(table, ["x"], (0.5,), approx=True).first()["p50"]
    assert near == pytest.approx(frame.x.quantile(0.5), abs=1.0)


def test_describe_categorical_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "t string")
    row = P.describe_categorical(df).first()
    assert (row["count"], row["unique"], row["top"], row["freq"]) == (4, 2, "a", 2)
    both = P.describe_all(df.withColumn("n", F.lit(1.0)))
    assert {r["column"] for r in both.collect()} == {"t", "n"}


def test_rollups(table, frame):
    day = P.rollup(table, "ts", "day", ["x"], ["y"], [])
    expected = frame.groupby(frame.ts.dt.date).agg({"x": "sum", "y": "mean"})
    for row in day.collect():
        assert row["x"] == pytest.approx(expected.loc[row["date"], "x"])
        assert row["y"] == pytest.approx(expected.loc[row["date"], "y"])
    assert P.rollup(table, "ts", "hour", ["x"]).count() == 200
    hours = {r["hour"]: r["mean"] for r in P.hour_pattern(table, "ts", "x").collect()}
    sums = frame.groupby([frame.ts.dt.date.rename("d"), frame.ts.dt.hour.rename("h")]).x.sum()
    assert hours[3] == pytest.approx(sums.groupby("h").mean()[3])
    with pytest.raises(ValueError):
        P.rollup(table, "ts", "minute")


def test_weekdays_in_order_with_gaps(spark):
    df = spark.createDataFrame([("2024-01-02 00:00:00", 4.0)], "t string, v double")
    df = df.withColumn("t", F.col("t").cast("timestamp_ntz"))
    rows = P.calendar_profile(df, "t", "v", "weekday").collect()
    assert [r["weekday"] for r in rows] == list(DAY_NAMES)
    assert [r["mean"] for r in rows] == [None, 4.0, None, None, None, None, None]


def test_correlation_is_pairwise_complete(table, frame):
    rows = {(r["a"], r["b"]): r["r"] for r in P.correlation(table, ["x", "y"]).collect()}
    assert rows["x", "y"] == pytest.approx(frame.x.corr(frame.y))
    assert rows["x", "y"] == rows["y", "x"]
    assert rows["x", "x"] == pytest.approx(1.0)


def test_histogram_counts_every_value_once(table, frame):
    rows = P.histogram(table, "x", 15).orderBy("bin").collect()
    counts, edges = np.histogram(frame.x.dropna(), bins=15)
    assert [r["n"] for r in rows] == counts.tolist()
    assert [r["from"] for r in rows] == pytest.approx(edges[:-1])
    grouped = P.histogram(table, "x", 15, by=["c"])
    assert grouped.count() == 30
    assert grouped.agg(F.sum("n")).first()[0] == frame.x.count()


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r["n"] for r in P.histogram(df, "x", 3).orderBy("bin").collect()] == [2, 0, 0]


def test_box_stats(table, frame):
    for row in P.box_stats(table, ["x"], ["c"]).collect():
        part = frame[frame.c == row["c"]].x.dropna()
        q1, q3 = part.quantile([0.25, 0.75])
        inside = part[(part >= q1 - 1.5 * (q3 - q1)) & (part <= q3 + 1.5 * (q3 - q1))]
        assert row["whisker_low"] == pytest.approx(inside.min())
        assert row["whisker_high"] == pytest.approx(inside.max())
        assert row["outliers"] == len(part) - len(inside)


def test_cap(table, frame):
    capped, found = P.cap(table, "x")
    assert found == pytest.approx(frame.x.quantile(0.99))
    assert capped.count() == (frame.x <= frame.x.quantile(0.99)).sum()
    assert {r["stage"] for r in P.cap_and_describe(table, "x", 40.0).collect()} == {"before", "after"}


def test_compare_keeps_columns_of_the_first(spark):
    a = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "p double, q double")
    b = spark.createDataFrame([(5.0,), (7.0,)], "p double")
    rows = {r["column"]: r for r in P.compare(a, b).collect()}
    assert rows["p"]["mean_left"] == 2.0 and rows["p"]["mean_right"] == 6.0
    assert rows["q"]["mean_right"] is None


def test_counts_and_schema(table):
    assert column(P.category_counts(table, "c"), "n") == sorted(column(P.category_counts(table, "c"), "n"), reverse=True)
    assert {r["column"]: r["n"] for r in P.distinct_counts(table, ["c"]).collect()} == {"c": 2}
    missing = {r["column"]: r["missing"] for r in P.null_profile(table).collect()}
    assert missing["x"] == 9 and missing["c"] == 0


def test_power_factor(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", 3.0, 5.0, 1.0)], "t string, p double, a double, b double"
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert P.power_factor(df, "t", "p", "a", "b").first()["power_factor"] == pytest.approx(0.6)


def test_explore(readings):
    text = readings.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in readings.columns])
    tables = explore(text, ENERGY_ROLES, "lagging.current.reactive.power.kvarh", "CO2(tCO2)", 18.0, 12.0, other=text)
    assert tables["within_target_cap"].count() == 3
    assert tables["final"].count() == 2
    assert tables["percentile_comparison"].count() == 2
