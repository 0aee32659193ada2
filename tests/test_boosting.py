"""Boosting with a share of columns and rows per tree, errors along the path."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor

from tidegauge.operators.boosting import ShareBoostedTrees, path_rmse
from tidegauge.operators.models import grid_search


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 3, (240, 4)).astype(float)
    y = x[:, 0] * 3 - x[:, 1] * x[:, 2] + x[:, 3] + rng.normal(0, 0.2, 240)
    return x, y


@pytest.fixture(scope="module")
def frame(spark, rows):
    x, y = rows
    data = [(i, *map(float, x[i]), float(y[i])) for i in range(len(y))]
    df = spark.createDataFrame(data, "id long, a double, b double, c double, d double, y double")
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df).cache()


def _booster(**settings):
    return ShareBoostedTrees(labelCol="y", maxDepth=8, **settings)


def test_each_tree_fits_the_means_of_its_columns(frame, rows):
    """Trees that may grow to single values predict the mean rest of each combination."""
    x, y = rows
    booster = _booster(maxIter=4, columnShare=0.5, rowShare=1.0, stepSize=0.3, checkpointInterval=2)
    model = booster.fit(frame)
    want = np.full(len(y), y.mean())
    for turn in range(1, 5):
        seen = x[:, booster.columns_of(turn, 4)]
        assert seen.shape[1] == 2
        _, group = np.unique(seen, axis=0, return_inverse=True)
        group = group.ravel()
        mean = np.bincount(group, weights=y - want) / np.bincount(group)
        want = want + 0.3 * mean[group]
    got = [r.prediction for r in model.transform(frame).orderBy("id").collect()]
    assert got == pytest.approx(want.tolist())
    assert len({tuple(booster.columns_of(t, 4)) for t in range(1, 20)}) > 2


def test_rows_by_key_are_the_same_in_every_run(frame, tmp_path):
    booster = _booster(maxIter=3, rowShare=0.5, keyCol="id")
    first = booster.fit(frame)
    again = booster.fit(frame.repartition(7))
    a, b = ([round(r.prediction, 9) for r in m.transform(frame).orderBy("id").collect()] for m in (first, again))
    assert a == b
    path = str(tmp_path / "model")
    first.save(path)
    loaded = GBTRegressionModel.load(path).transform(frame).orderBy("id").collect()
    assert [round(r.prediction, 9) for r in loaded] == a
    with pytest.raises(ValueError, match="keyCol"):
        _booster(rowShare=0.5).fit(frame)


def test_rows_without_labels_are_left_out(spark, frame):
    short = frame.limit(0)
    with pytest.raises(ValueError, match="label"):
        _booster(maxIter=1, rowShare=1.0).fit(short)
    some = frame.selectExpr("features", "if(id < 40, y, null) as y")
    whole = frame.filter("id < 40")
    settings = {"maxIter": 2, "rowShare": 1.0}
    a, b = (_booster(**settings).fit(df).transform(frame).orderBy("id").collect() for df in (some, whole))
    assert [r.prediction for r in a] == pytest.approx([r.prediction for r in b])


def test_path_errors_equal_those_of_separate_fits(frame):
    for lead, booster in ((0, GBTRegressor(labelCol="y", seed=1, subsamplingRate=0.7, maxDepth=3)), (1, _booster(rowShare=0.7, keyCol="id"))):
        path = path_rmse(booster.fit(frame, {booster.maxIter: 5}), frame, [2, 5, 9], lead)
        for n in (2, 5):
            scored = booster.fit(frame, {booster.maxIter: n}).transform(frame)
            rest = [r.y - r.prediction for r in scored.collect()]
            assert path[n] == pytest.approx(np.sqrt(np.mean(np.square(rest))))
        assert path[9] == path[5]


def test_search_shares_fits_of_settings_that_differ_in_rounds(frame, monkeypatch):
    asked = []
    real = GBTRegressor._fit
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, df: (asked.append(self.getMaxIter()), real(self, df))[1])
    pipeline = Pipeline(stages=[GBTRegressor(labelCol="y", seed=1)])
    grid = {"maxIter": [2, 4], "maxDepth": [2, 3]}
    found = grid_search(pipeline, frame.select("id", "features", "y"), "y", "id", grid, k=2)
    # Two folds by two depths, and the refit of the best.
    assert len(asked) == 5 and asked[:4] == [4] * 4
    monkeypatch.undo()
    best = {}
    for n in (2, 4):
        alone = grid_search(pipeline, frame.select("id", "features", "y"), "y", "id", {"maxIter": [n], "maxDepth": [2, 3]}, k=2)
        best.update({(r.params["maxIter"], r.params["maxDepth"]): r.rmse for r in alone.table.collect()})
    got = {(r.params["maxIter"], r.params["maxDepth"]): r.rmse for r in found.table.collect()}
    assert got == pytest.approx(best)
