"""Stored references and grown histories against the direct tests."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import drift as D
from tidegauge.operators import order_stats
from tidegauge.operators.reference import History, drift_against, keep_reference, ks_against, stored_reference


def rows_of(df):
    out = []
    for r in df.collect():
        out.append(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


def sample(spark, n, shift, seed, periods=3):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        x = rng.gauss(shift, 1)
        made.append(
            (
                f"p{rng.randrange(periods)}" if rng.random() < 0.97 else None,
                x if rng.random() < 0.9 else None,
                float("nan") if rng.random() < 0.05 else float(rng.choice([1, 1, 1, 2, 5 + shift])),
                None,
                rng.choice(["a", "b", "c" if shift else "d", None]),
            )
        )
    return spark.createDataFrame(made, "period string, `x y` double, hot double, none double, kind string").repartition(4)


NUMBERS = ["x y", "hot", "none"]


@pytest.fixture(scope="module")
def sides(spark):
    return sample(spark, 900, 0.0, 1), sample(spark, 500, 0.2, 2)


@pytest.mark.parametrize("by", [[], ["period"]])
def test_stored_reference_answers_as_ks(spark, sides, tmp_path, by):
    before, after = sides
    keep_reference(before, str(tmp_path), NUMBERS)
    kept = stored_reference(spark, str(tmp_path))
    assert rows_of(ks_against(kept, after, by)) == rows_of(D.ks(before, after, NUMBERS, by))


def test_stored_reference_with_parts(spark, sides, tmp_path, monkeypatch):
    """Large cells are cut into parts; far outliers and values between those of the reference."""
    before, after = sides
    plain = order_stats.build_grid
    monkeypatch.setattr("tidegauge.operators.reference.build_grid", lambda df, names: plain(df, names, rows_per_cell=4, intervals=8))
    kept = keep_reference(before, str(tmp_path), ["x y", "hot"])
    assert kept.grid.splits > 1 and kept.grid.fine
    far = after.unionByName(after.limit(20).withColumn("x y", F.col("x y") * 1e6))
    assert rows_of(ks_against(kept, far)) == rows_of(D.ks(before, far, ["x y", "hot"]))
    assert rows_of(ks_against(kept, before)) == rows_of(D.ks(before, before, ["x y", "hot"]))


def test_no_row_of_the_reference_is_read(spark, sides, tmp_path):
    before, after = sides
    before.write.parquet(str(tmp_path / "before"))
    after.write.parquet(str(tmp_path / "after"))
    kept = keep_reference(spark.read.parquet(str(tmp_path / "before")), str(tmp_path / "kept"), NUMBERS, ["kind"])
    read = drift_against(stored_reference(spark, kept.path), spark.read.parquet(str(tmp_path / "after"))).inputFiles()
    assert read and not any("/before/" in f for f in read)


@pytest.mark.parametrize("empty", ["reference", "both"])
def test_empty_sides(spark, sides, tmp_path, empty):
    before, after = (df.filter(F.lit(empty not in (side, "both"))) for df, side in zip(sides, ("reference", "current"), strict=True))
    if empty == "both":
        before, after = (df.filter(F.lit(False)) for df in sides)
    kept = keep_reference(before, str(tmp_path), NUMBERS, ["kind"])
    assert rows_of(drift_against(kept, after)) == rows_of(D.column_drift(before, after, NUMBERS, ["kind"]))


def test_history_grows(spark, sides, tmp_path):
    before, after = sides
    kept = keep_reference(before, str(tmp_path / "kept"), NUMBERS, ["kind"])
    history = History(kept, str(tmp_path / "history"))
    first, second = after.randomSplit([0.5, 0.5], 3)
    first, second = first.cache(), second.cache()
    history.add(first, "period", "a")
    history.add(second, "period", "b")
    want = rows_of(D.column_drift(before, first.unionByName(second), NUMBERS, ["kind"], ["period"]))
    assert rows_of(history.rows()) == want
    # An increment that is run again replaces itself; a new period leaves the others as they are.
    history.add(second, "period", "b")
    history.add(first.withColumn("period", F.lit("p9")), "period", "c")
    assert [r for r in rows_of(history.rows()) if r[0] != "p9"] == want
    assert rows_of(history.rows(["p1"])) == [r for r in want if r[0] == "p1"]
    assert {r["period"] for r in history.summary().collect()} == {"p0", "p1", "p2", "p9"}


def test_only_asked_periods_are_read(spark, sides, tmp_path):
    before, after = sides
    history = History(keep_reference(before, str(tmp_path / "kept"), ["x y"]), str(tmp_path / "history"))
    history.add(after, "period", "a")
    table = history._read("values", ["p1"], "ix int, cell int, part int, value double, n bigint")
    files = table.filter("period = 'p1'")
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "period" in plan.split("PartitionFilters")[1].split("]")[0]
