"""Shared scans and the fused fit against stage-by-stage fits."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog.inputs import EVENT_ROLES, events
from tidegauge.operators import scans
from tidegauge.operators.fused import FusedPipeline
from tidegauge.operators.models import feature_stages, preprocessor_stages
from tidegauge.operators.stages import Dummies, MedianImputer, ModeImputer, QuantileClipper, Standardizer
from tidegauge.roles import Roles

ROLES = Roles(target="y", numeric=("a b", "c", "empty", "flat"), categorical=("kind", "none"), interactions=("a b", "c"), time="at", key="id")


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)

    def some(value, share=0.9):
        return value if rng.random() < share else None

    made = [
        (
            i,
            some(rng.gauss(0, 1)),
            some(float(rng.choice([1, 1, 1, 2, 900, float("nan")]))),
            None,
            2.5,
            some(rng.choice(["u", "v", "é", "v "]), 0.7),
            None,
            some(f"2024-0{1 + i % 9}-11 0{i % 10}:00:00"),
            float(i),
        )
        for i in range(400)
    ]
    names = "id int, `a b` double, c double, empty double, flat double, kind string, none string, at string, y double"
    return spark.createDataFrame(made, names).repartition(5)


def params(model):
    out = []
    for stage in model.stages:
        if hasattr(stage, "labelsArray") or hasattr(stage, "stages"):
            inner = getattr(stage, "stages", [stage])
            out.append(("labels", {"labels": [list(x) for m in inner for x in m.labelsArray], "invalid": inner[0].getHandleInvalid()}))
            continue
        own = {p.name: v for p, v in stage.extractParamMap().items()}
        if hasattr(stage, "categorySizes"):
            own["sizes"] = list(stage.categorySizes)
        for name in ("inputCols", "outputCols", "outputCol", "stringOrderType"):
            own.pop(name, None)
        out.append((type(stage).__name__, own))
    return out


def same(a, b):
    for (kind, x), (other, y) in zip(params(a), params(b), strict=True):
        assert kind == other and x.keys() == y.keys()
        for name in x:
            if isinstance(x[name], list) and x[name] and isinstance(x[name][0], float):
                assert x[name] == pytest.approx(y[name], rel=1e-9, abs=1e-12), (kind, name)
            else:
                assert x[name] == y[name], (kind, name)


def stages_of(roles):
    return [*feature_stages(roles), *preprocessor_stages(roles, carry=[roles.key])]


def test_fused_fit_is_the_plain_fit(rows):
    roles = Roles(target="y", numeric=ROLES.numeric, categorical=("kind",), interactions=ROLES.interactions, time="at", key="id")
    fused, plain = FusedPipeline(stages=stages_of(roles)).fit(rows), Pipeline(stages=stages_of(roles)).fit(rows)
    same(fused, plain)


def test_categories_of_several_columns(rows):
    """Columns with different numbers of categories."""
    df = rows.withColumns({"few": F.expr("if(id % 2 = 0, 'x', 'y')"), "one": F.lit("z"), "many": F.expr("concat('m', id % 9)")})
    roles = Roles(target="y", numeric=("a b", "c"), categorical=("few", "kind", "one", "many"), interactions=("a b", "c"), time="at", key="id")
    fused, plain = FusedPipeline(stages=stages_of(roles)).fit(df), Pipeline(stages=stages_of(roles)).fit(df)
    same(fused, plain)
    vectors = [sorted(map(str, (r["features"] for r in m.transform(df.filter("id < 30")).collect()))) for m in (fused, plain)]
    assert len(vectors[0]) == len(vectors[1]) == 30


def test_fused_fit_of_events(spark, folder):
    df = events(spark, folder)
    fused, plain = FusedPipeline(stages=stages_of(EVENT_ROLES)).fit(df), Pipeline(stages=stages_of(EVENT_ROLES)).fit(df)
    same(fused, plain)
    first = [m.transform(df).orderBy("event_id").select(vector_to_array("features")).limit(50).collect() for m in (fused, plain)]
    assert np.allclose([r[0] for r in first[0]], [r[0] for r in first[1]])


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7])
def test_fused_fit_of_few_rows(rows, n):
    """A clipped median of few values is not the clip of the median."""
    few = rows.orderBy("id").limit(n)
    made = [QuantileClipper(columns=["a b", "c", "y"], lower=0.2, upper=0.7), MedianImputer(columns=["a b", "c", "y"]), Standardizer(columns=["a b", "y"])]
    same(FusedPipeline(stages=made).fit(few), Pipeline(stages=made).fit(few))


def test_stages_in_other_orders(rows):
    made = [
        MedianImputer(columns=["a b", "c"]),
        QuantileClipper(columns=["a b", "y"]),
        ModeImputer(columns=["kind", "none"]),
        Standardizer(columns=["a b", "y"]),
        QuantileClipper(columns=["a b"], lower=0.1, upper=0.9),
        MedianImputer(columns=["flat", "empty"]),
    ]
    same(FusedPipeline(stages=made).fit(rows), Pipeline(stages=made).fit(rows))


def test_fewer_scans(spark, rows, monkeypatch):
    seen = []
    plain = scans.answer
    monkeypatch.setattr("tidegauge.operators.fused.answer", lambda df, asked: seen.append(asked) or plain(df, asked))
    FusedPipeline(stages=stages_of(Roles(target="y", numeric=("a b", "c"), categorical=("kind",), interactions=("a b", "c"), time="at", key="id"))).fit(rows)
    assert len(seen) == 2


@pytest.mark.parametrize("limit, reach", [(100_000, 2), (40, 2), (100_000, -300)])
def test_scans_by_hand(rows, monkeypatch, limit, reach):
    """The answers do not depend on what fits the driver nor on where the windows lie."""
    monkeypatch.setattr(scans, "DRIVER_ROWS", limit)
    monkeypatch.setattr(scans, "REACH", reach)
    shares = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]
    asked = scans.Asked()
    for name in ("a b", "c", "y", "empty", "flat"):
        asked.share(name, *shares)
    asked.moments.update(["a b", "c", "empty"])
    asked.categories.add("kind")
    found = scans.answer(rows, asked)
    held = rows.toPandas()
    for name in ("a b", "c", "y", "flat"):
        assert [found.quantile(name, q) for q in shares] == pytest.approx(list(held[name].quantile(shares)))
    assert found.quantile("empty", 0.5) is None and found.moments["empty"] == (0, 0.0, 0.0)
    n, mean, var = found.moments["a b"]
    assert (n, mean, var) == (held["a b"].count(), pytest.approx(held["a b"].mean()), pytest.approx(held["a b"].var(ddof=0)))
    assert found.categories["kind"] == held["kind"].value_counts().to_dict()


def test_hot_value_and_skew(spark, monkeypatch):
    """One value in most rows, infinities, and values that only differ far down."""
    values = [1.0] * 3000 + [float("inf"), float("-inf")] + [1 + i * 1e-12 for i in range(500)] + [None] * 20
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(6)
    shares = [0.0001, 0.3, 0.9, 0.95, 0.9999]
    got = scans.quantiles_of(df, ["v"], *shares)["v"]
    held = sorted(v for v in values if v is not None)
    assert got[1] == 1.0 and got[2] == pytest.approx(np.quantile(held[1:-1], 0.9), abs=1e-9)
    monkeypatch.setattr(scans, "DRIVER_ROWS", 0)
    assert repr(scans.quantiles_of(df, ["v"], *shares)["v"]) == repr(got)


def test_nothing_asked(rows):
    assert scans.answer(rows.filter(F.lit(False)), scans.Asked()).around == {}


def test_dummies_are_bounded(spark, monkeypatch):
    df = spark.createDataFrame([(i, float(i % 3), i % 2 == 0, None if i == 4 else f"v{i % 11}") for i in range(40)], "i int, x double, b boolean, s string")
    made = Dummies(columns=["x", "b", "s"]).fit(df).transform(df)
    assert made.columns == ["i", "x_1.0", "x_2.0", "b_true", "s_v1", "s_v10", *[f"s_v{i}" for i in range(2, 10)]]
    assert made.agg(F.sum("`x_1.0`")).first()[0] == 13
    numbers = Dummies(columns=["i"]).fit(df).transform(df).columns
    assert numbers == ["x", "b", "s", *[f"i_{i}" for i in range(1, 40)]]
    monkeypatch.setattr("tidegauge.operators.stages.MOST_DUMMIES", 39)
    with pytest.raises(ValueError, match="SparseDummies"):
        Dummies(columns=["i"]).fit(df)
