from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from tidegauge.operators import models as M


def _slots(spark, n):
    """A full set of category slots, a constant and a number on another scale."""
    rows = []
    for i in range(n):
        x = (i * 7919 % 1000) * 1e3 + 1e6
        kind = 0 if i % 9 else 1 + i % 4
        rows.append((kind, Vectors.dense([float(kind == k) for k in range(5)] + [3.0, x]), float(i * 104729 % 997) + kind + 1e-4 * x))
    return spark.createDataFrame(rows, ["kind", "features", "y"])


def test_singular_lines_are_exact(spark, tmp_path):
    """Spark's iteration leaves a mean residual of about 1e-8 of the spread."""
    df = _slots(spark, 9000).repartition(5)
    model = M.build_model("linear_regression", "y").fit(df)
    assert isinstance(model, LinearRegressionModel)
    left = model.transform(df).groupBy("kind").agg(F.sum(F.col("y") - F.col("prediction")).alias("left")).collect()
    assert max(abs(r["left"]) for r in left) < 1e-6
    # The shortest of the exact solutions, as numpy finds it.
    rows = df.select("features", "y").collect()
    x, y = np.array([r[0].toArray() for r in rows]), np.array([r[1] for r in rows])
    want = np.linalg.lstsq(x - x.mean(axis=0), y - y.mean(), rcond=1e-12)[0]
    assert model.coefficients.toArray() == pytest.approx(want, abs=1e-6)
    model.write().save(str(tmp_path / "line"))
    assert LinearRegressionModel.load(str(tmp_path / "line")).coefficients == model.coefficients


def test_lines_without_intercept(spark):
    df = _slots(spark, 500)
    model = M.build_model("linear_regression", "y", {"fitIntercept": False}).fit(df)
    rows = df.select("features", "y").collect()
    x, y = np.array([r[0].toArray() for r in rows]), np.array([r[1] for r in rows])
    error = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
    found = y - x @ model.coefficients.toArray() - model.intercept
    assert found == pytest.approx(error, abs=1e-6)


def test_missing_labels_are_an_error(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0]), 1.0), (Vectors.dense([2.0]), None)], ["features", "y"])
    with pytest.raises(ValueError, match="null"):
        M.build_model("linear_regression", "y").fit(df)
