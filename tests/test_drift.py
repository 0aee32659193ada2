from __future__ import annotations

import json
from math import erfc, exp, sqrt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import column
from tidegauge.functions.significance import chi_squared_p, kolmogorov_p
from tidegauge.operators import drift as D
from tidegauge.operators import scenario as S
from tidegauge.operators.order_stats import build_grid
from tidegauge.plans.monitoring import Monitor
from tidegauge.plans.scenarios import scenario_totals, what_if
from tidegauge.streaming.live import monitor_batch, monitor_stream, stream_rollup


def numpy_ks(a, b):
    a, b = np.sort(a), np.sort(b)
    both = np.concatenate([a, b])
    gap = np.searchsorted(a, both, "right") / len(a) - np.searchsorted(b, both, "right") / len(b)
    return np.abs(gap).max()


def numpy_psi(expected, actual, buckets=10):
    edges = np.unique(np.quantile(expected, np.linspace(0, 1, buckets + 1)))
    e, a = np.histogram(expected, edges)[0], np.histogram(actual, edges)[0]
    x, y = np.where(e == 0, 1e-6, e) / e.sum(), np.where(a == 0, 1e-6, a) / a.sum()
    return np.sum((x - y) * np.log(x / y))


@pytest.fixture(scope="module")
def frames():
    rng = np.random.default_rng(11)

    def make(n, shift, hot):
        x = rng.normal(shift, 1, n)
        x[rng.random(n) < hot] = 0.5
        y = np.round(rng.exponential(2, n), 1)
        y[::50] = np.nan
        return pd.DataFrame(
            {"x": x, "y": y, "c": rng.choice(["a", "b", "c"], n), "w": rng.choice(["w1", "w2", "w3"], n, p=[0.8, 0.15, 0.05])}
        )

    return make(2500, 0.0, 0.35), make(1800, 0.2, 0.3)


@pytest.fixture(scope="module")
def tables(spark, frames):
    return tuple(spark.createDataFrame(f).repartition(5).persist() for f in frames)


@pytest.mark.parametrize("cells", [None, (10, 8), (1, 4)])
def test_ks_matches_numpy_whatever_the_cells(tables, frames, cells):
    grid = None
    if cells:
        both = tables[0].unionByName(tables[1])
        grid = build_grid(both, ["x", "y"], rows_per_cell=cells[0], intervals=cells[1])
    for row in D.ks(*tables, ["x", "y"], grid=grid).collect():
        a, b = (f[row["column"]].dropna() for f in frames)
        assert row["statistic"] == pytest.approx(numpy_ks(a, b), abs=1e-12)
        assert (row["n_reference"], row["n_current"]) == (len(a), len(b))


def test_ks_by_group_is_one_job_per_group_key(tables, frames):
    rows = D.ks(*tables, ["x", "y"], by=["w"]).collect()
    assert len(rows) == 6
    for row in rows:
        a = frames[0][row["column"]].dropna()
        b = frames[1][frames[1].w == row["w"]][row["column"]].dropna()
        assert row["statistic"] == pytest.approx(numpy_ks(a, b), abs=1e-12)


def test_ks_of_disjoint_and_equal_samples(spark):
    low = spark.range(100).select(F.col("id").cast("double").alias("x"))
    high = low.select((F.col("x") + 1000).alias("x"))
    assert D.ks(low, high, ["x"]).first()["statistic"] == 1.0
    same = D.ks(low, low, ["x"]).first()
    assert same["statistic"] == 0.0 and same["p_value"] == 1.0


def test_psi_matches_numpy(tables, frames):
    for row in D.psi(*tables, ["x", "y"]).collect():
        a, b = (f[row["column"]].dropna() for f in frames)
        assert row["psi"] == pytest.approx(numpy_psi(a, b), rel=1e-9)


def test_psi_by_group_and_stored_profile(tables, frames):
    profile = D.build_profile(tables[0], ["x"])
    stored = D.Profile.from_dict(json.loads(json.dumps(profile.as_dict())))
    assert stored == profile
    for row in D.psi_against(stored, tables[1], ["w"]).collect():
        b = frames[1][frames[1].w == row["w"]].x
        assert row["psi"] == pytest.approx(numpy_psi(frames[0].x, b), rel=1e-9)


def test_chi_squared(tables, frames):
    row = D.chi_squared(*tables, ["c"]).first()
    table = np.array([[(f.c == v).sum() for v in "abc"] for f in frames], float)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    statistic = ((table - expected) ** 2 / expected).sum()
    assert row["statistic"] == pytest.approx(statistic)
    assert row["p_value"] == pytest.approx(exp(-statistic / 2))


def test_chi_squared_with_new_and_lost_values(spark):
    a = spark.createDataFrame([("p",)] * 30 + [("q",)] * 10, "c string")
    b = spark.createDataFrame([("p",)] * 20 + [("r",)] * 20, "c string")
    table = np.array([[30, 10, 0], [20, 0, 20]], float)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    row = D.chi_squared(a, b, ["c"]).first()
    assert row["statistic"] == pytest.approx(((table - expected) ** 2 / expected).sum())


@pytest.mark.parametrize(
    "statistic,freedom,p",
    [(3.841459, 1, 0.05), (18.30704, 10, 0.05), (19.67514, 11, 0.05), (124.3421, 100, 0.05), (0.0, 4, 1.0), (1e5, 3, 0.0)],
)
def test_chi_squared_tail(spark, statistic, freedom, p):
    df = spark.createDataFrame([(statistic, freedom)], "s double, f int")
    assert df.select(chi_squared_p(F.col("s"), F.col("f"))).first()[0] == pytest.approx(p, rel=1e-5, abs=1e-12)


def test_tails_of_one_degree_follow_erfc(spark):
    rows = [(float(x),) for x in (0.1, 1, 10, 49, 51, 90)]
    df = spark.createDataFrame(rows, "s double").select("s", chi_squared_p(F.col("s"), F.lit(1)).alias("p"))
    for row in df.collect():
        assert row["p"] == pytest.approx(erfc(sqrt(row["s"] / 2)), rel=2e-4)


def test_kolmogorov_tail(spark):
    df = spark.createDataFrame([(0.136,)], "d double")
    p = df.select(kolmogorov_p(F.col("d"), F.lit(200), F.lit(200))).first()[0]
    x = 0.136 * sqrt(100)
    assert p == pytest.approx(2 * sum((-1) ** (j - 1) * exp(-2 * j * j * x * x) for j in range(1, 50)))


def test_summary_and_tiers(spark):
    rows = spark.createDataFrame([(True,), (False,), (False,), (False,), (False,)], "drifted boolean")
    row = D.drift_summary(rows).first()
    assert row["dataset_drift_detected"] and row["number_of_drifted_columns"] == 1 and row["tier"] == "warning"
    shares = spark.createDataFrame([(0.1,), (0.2,), (0.5,)], "s double")
    assert [r[0] for r in shares.select(D.alert_tier(F.col("s"))).collect()] == ["ok", "warning", "critical"]


def test_monitor(tables):
    reference, current = tables
    scored = current.withColumn("prediction", F.col("x") * 0.5)
    monitor = Monitor.of(reference, target="x", time="w")
    assert monitor.numeric == ("y",) and monitor.categorical == ("c",)
    summary, rows = monitor.drift_report(scored)
    assert summary.first()["number_of_columns"] == 2 == rows.count()
    assert {r["section"] for r in monitor.full_report(scored).collect()} == {"drift", "summary", "performance"}
    assert {r["section"] for r in monitor.full_report(current).collect()} == {"drift", "summary"}
    with pytest.raises(ValueError):
        monitor.performance_report(current)
    assert monitor.history(current, "w").count() == 3
    assert monitor.stability(current).count() == 1


def test_scenarios(spark):
    df = spark.range(1000).withColumn("v", F.lit(1.0))
    assert set(column(S.shift_scale(df, {"v": (2.0, 3.0)}), "v")) == {5.0}
    masked = S.mask_share(df, "v", "id", 0.15).filter("v IS NULL").count()
    assert 100 < masked < 200


def test_what_if(spark):
    df = spark.createDataFrame([(1, 10.0), (6, 20.0)], "day int, v double")
    made = what_if(df, F.col("day") < 5, {"v": F.col("v") + 5}, lambda d: d.withColumn("prediction", F.col("v")), "v")
    row = scenario_totals(made).first()
    assert (row["baseline_total"], row["scenario_total"]) == (30.0, 35.0)
    assert row["change_pct"] == pytest.approx(100 / 6)


def test_stream_rollup_gives_closed_hours(spark, folder, tmp_path):
    stream = spark.readStream.schema(spark.read.parquet(f"{folder}/events.parquet").schema).parquet(f"{folder}/event[s].parquet")
    rolled = stream_rollup(stream, "ts", sums=["value"])
    query = (
        rolled.writeStream.format("parquet").option("path", str(tmp_path / "o"))
        .option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "o"))
    batch = spark.read.parquet(f"{folder}/events.parquet")
    hours = batch.select(F.date_trunc("hour", "ts")).distinct().count()
    assert hours - 4 <= got.count() < hours


def test_monitor_stream_writes_each_batch_once(spark, folder, tmp_path):
    batch = spark.read.parquet(f"{folder}/events.parquet")
    profile = D.build_profile(batch, ["value"])
    assert column(monitor_batch(batch, profile), "tier") == ["ok"]
    stream = spark.readStream.schema(batch.schema).parquet(f"{folder}/event[s].parquet")
    for _ in range(2):
        writer = monitor_stream(stream, profile, str(tmp_path / "o"))
        writer.option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 1


# --- reports are complete -------------------------------------------------------------------


@pytest.fixture(scope="module")
def halves(spark):
    """A reference and a current table with columns that vanish, appear, stand still or move."""
    ids = spark.range(200)
    null = F.lit(None).cast("double")
    ref = ids.select((F.col("id") * 1.0).alias("same"), (F.col("id") * 1.0).alias("far"), F.lit(3.0).alias("still"),
                     (F.col("id") * 1.0).alias("gone"), null.alias("late"), F.lit("a").alias("text"))
    cur = ids.select((F.col("id") * 1.0).alias("same"), (F.col("id") + 5000.0).alias("far"), F.lit(9.0).alias("still"),
                     null.alias("gone"), (F.col("id") * 1.0).alias("late"), F.lit(None).cast("string").alias("text"))
    return ref, cur


def test_psi_has_a_row_for_every_column(halves):
    ref, cur = halves
    rows = {r["column"]: r for r in D.psi(ref, cur, ["same", "far", "still", "gone", "late"]).collect()}
    assert rows["same"]["psi"] == pytest.approx(0.0)
    for name in ("far", "still"):
        assert rows[name]["psi"] == float("inf") and rows[name]["n_current"] == 0 and rows[name]["n_outside"] == 200
    assert rows["gone"]["psi"] is None and rows["late"]["psi"] is None and rows["late"]["n_outside"] == 200
    grouped = D.psi(ref, cur.withColumn("g", F.lit(1)), ["far", "gone"], by=["g"])
    assert grouped.count() == 2


def test_monitor_batch_sees_total_drift(halves):
    ref, cur = halves
    profile = D.build_profile(ref, ["same", "far", "still", "gone"])
    rows = {r["column"]: r for r in monitor_batch(cur, profile).collect()}
    assert not rows["same"]["drifted"] and all(rows[c]["drifted"] for c in ("far", "still", "gone"))
    assert {r["tier"] for r in rows.values()} == {"critical"} and rows["same"]["share"] == 0.75


def test_column_drift_with_empty_sides(halves):
    ref, cur = halves
    for by in ((), ("g",)):
        rows = D.column_drift(ref, cur.withColumn("g", F.lit("w")), ["same", "gone", "late"], ["text"], by=by)
        found = {r["column"]: r for r in rows.collect()}
        assert len(found) == 4 and not found["same"]["drifted"]
        assert all(found[c]["drifted"] and found[c]["statistic"] is None for c in ("gone", "late", "text"))
        assert found["gone"]["status"] == found["text"]["status"] == "no current values"
        assert found["late"]["status"] == "no reference values"
        assert D.drift_summary(rows).first()["number_of_columns"] == 4


def test_monitor_raises_on_an_absent_column(halves):
    ref, cur = halves
    with pytest.raises(ValueError, match="far"):
        Monitor.of(ref, "same").drift_report(cur.drop("far"))


def test_chi_squared_of_very_large_counts(spark, monkeypatch):
    """Counts above 4e9 neither overflow nor cancel."""
    counts = {"ref": [("p", 5 * 10**9), ("q", 4 * 10**9)], "cur": [("p", 5 * 10**9), ("q", 4 * 10**9 + 10**6)]}

    def texts(df, columns, by=()):
        side = df.first()["side"]
        return spark.createDataFrame([("c", v, n) for v, n in counts[side]], "column string, value string, n bigint")

    monkeypatch.setattr(D, "_texts", texts)
    sides = [spark.createDataFrame([(s, "x")], "side string, c string") for s in ("ref", "cur")]
    row = D.chi_squared(*sides, ["c"]).first()
    table = np.array([[n for _, n in counts[s]] for s in ("ref", "cur")], dtype=float)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    assert row["statistic"] == pytest.approx(((table - expected) ** 2 / expected).sum(), rel=1e-6)


@pytest.mark.parametrize("freedom", [2002, 5000, 100_000])
def test_chi_squared_tail_for_many_degrees(spark, freedom):
    """The expansion agrees with the finite sum in logs (even degrees)."""
    from math import lgamma, log

    for z in (-3, -0.5, 0, 0.1, 2, 5):
        x = freedom + z * sqrt(2 * freedom)
        logs = [i * log(x / 2) - x / 2 - lgamma(i + 1) for i in range(freedom // 2)]
        want = sum(exp(v) for v in logs if v > -700)
        got = spark.range(1).select(chi_squared_p(F.lit(float(x)), F.lit(freedom)).alias("p")).first()["p"]
        assert got == pytest.approx(want, rel=1e-4, abs=1e-9)


def test_grouped_ks_grows_with_the_current_table_only(spark):
    """Many groups: what is shuffled does not hold a copy of the reference per group."""
    rng = np.random.default_rng(5)
    ref = spark.createDataFrame(pd.DataFrame({"x": rng.normal(size=2000)}))
    frame = pd.DataFrame({"g": np.repeat(np.arange(500), 4), "x": rng.normal(size=2000)})
    rows = D.ks(ref, spark.createDataFrame(frame), ["x"], ["g"]).collect()
    assert len(rows) == 500
    base = ref.toPandas().x.to_numpy()
    for r in rows[:60]:
        assert r["statistic"] == pytest.approx(numpy_ks(base, frame[frame.g == r["g"]].x.to_numpy()))
