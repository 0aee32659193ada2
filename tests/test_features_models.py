from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tests.conftest import column
from tidegauge.operators import models as M
from tidegauge.operators.quality import degradation, regression_metrics, residuals, split_metrics
from tidegauge.operators.split import folds, hash_split, train_test
from tidegauge.operators.stages import (
    DateFeatures,
    Dummies,
    Interactions,
    MedianImputer,
    ModeImputer,
    QuantileClipper,
    SparseDummies,
    Standardizer,
    clip_batch,
)
from tidegauge.operators.models import number_slots
from tidegauge.plans.features import engineer, feature_frame
from tidegauge.plans.training import compare_models, train_suite
from tidegauge.roles import ENERGY_FEATURE_SUBSETS, ENERGY_ROLES

RATIO = "lagging_current_reactive.power_kvarh__div__leading_current_power_factor"


def test_roles():
    assert len(number_slots(ENERGY_ROLES)) == 6 + 6 + 1
    assert number_slots(ENERGY_ROLES)[-1] == RATIO
    assert "co2(tco2)" not in ENERGY_FEATURE_SUBSETS["no_co2"].numeric
    assert "day_of_week" not in ENERGY_FEATURE_SUBSETS["no_co2_no_weekday"].categorical
    with pytest.raises(ValueError):
        ENERGY_ROLES.without("usage_kwh")


def test_date_features(spark):
    df = spark.createDataFrame([("2024-01-01 06:00:00",), ("2024-01-02 12:30:00",), ("bad",)], "date string")
    stage = DateFeatures()
    made = stage.transform(df)
    assert made.columns == stage.feature_names()
    rows = made.collect()
    assert rows[0]["date_sin_hour"] == pytest.approx(1.0)
    assert rows[1]["date_cos_hour"] == pytest.approx(-1.0)
    assert list(rows[2]) == [-1.0, -1.0, -1.0, -1.0, 0.0, 0.0]
    assert {t for _, t in made.dtypes} == {"float"}
    with pytest.raises(Exception, match="unreadable"):
        DateFeatures(dropNa=True).transform(df).collect()
    assert DateFeatures(generate=False).transform(df.withColumn("x", F.lit(1))).columns == ["x"]
    with pytest.raises(ValueError):
        DateFeatures(timeCol="other").transform(df)


def test_interactions(spark):
    df = spark.createDataFrame([(1.0, 0.0, 5.0), (2.0, 4.0, 6.0)], ["a", "b", "c"])
    made = Interactions(columns=["a", "b"], ratios=True, products=True).transform(df)
    assert column(made, "a__x__b") == [0.0, 8.0]
    assert column(made, "a__div__b") == [0.0, 0.5]
    assert "b__div__c" in Interactions().transform(df).columns
    with pytest.raises(ValueError):
        Interactions(columns=["a", "z"]).transform(df)


def test_clipper(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (100.0, 5.0), (3.0, 5.0), (None, 5.0)], "x double, y double")
    model = QuantileClipper(columns=["x", "y"], lower=0.25, upper=0.75).fit(df)
    assert model.getOrDefault("first")[0] == 1.75 and model.getOrDefault("second")[0] == 27.25
    made = model.transform(df)
    assert column(made, "x") == [1.75, 2.0, 27.25, 3.0, None]
    assert column(made, "y") == [5.0] * 5
    assert model.transform(df.select("y")).columns == ["y"]
    assert column(clip_batch(df, ["x"], 0.25, 0.75), "x") == column(made, "x")
    with pytest.raises(ValueError):
        QuantileClipper(lower=0.9, upper=0.1)


def test_imputers_scaler_dummies(spark):
    df = spark.createDataFrame(
        [(1.0, "b", 3.0), (None, None, 3.0), (4.0, "a", 3.0)], "x double, t string, k double"
    )
    assert column(MedianImputer(columns=["x"]).fit(df).transform(df), "x") == [1.0, 2.5, 4.0]
    assert column(ModeImputer(columns=["t"]).fit(df).transform(df), "t") == ["b", "a", "a"]
    scaled = Standardizer(columns=["x", "k"]).fit(df.dropna()).transform(df.dropna())
    assert column(scaled, "x") == [-1.0, 1.0] and column(scaled, "k") == [0.0, 0.0]
    made = Dummies(columns=["t"]).fit(df).transform(df)
    assert made.columns == ["x", "k", "t_b"] and column(made, "t_b") == [1, 0, 0]


def test_feature_frame_order(readings):
    df = feature_frame(readings, ENERGY_ROLES)
    assert df.columns == [*ENERGY_ROLES.categorical, *ENERGY_ROLES.numeric, "date", "usage_kwh"]
    with pytest.raises(ValueError):
        feature_frame(readings.drop("nsm"), ENERGY_ROLES)


def test_preprocessor_width_and_unseen_category(readings):
    stages = [*M.feature_stages(ENERGY_ROLES), *M.preprocessor_stages(ENERGY_ROLES)]
    features = Pipeline(stages=M.feature_stages(ENERGY_ROLES)).fit(readings).transform(readings)
    assert "date" not in features.columns and {"date_hour", RATIO} <= set(features.columns)
    fitted = Pipeline(stages=stages).fit(readings)
    vectors = [r["features"] for r in fitted.transform(readings).collect()]
    assert {v.size for v in vectors} == {2 + 3 + 3 + 13}
    odd = readings.withColumn("load_type", F.lit("never seen"))
    assert all(sum(v.toArray()[5:8]) == 0 for v in (r["features"] for r in fitted.transform(odd).collect()))


def test_full_pipeline_is_stored_and_loaded(readings, tmp_path):
    model = M.model_pipeline(ENERGY_ROLES, "linear_regression").fit(readings)
    before = column(model.transform(readings), "prediction")
    path = M.save_model(model, str(tmp_path / "m"), "v1")
    assert path.endswith("version=v1")
    assert column(PipelineModel.load(path).transform(readings), "prediction") == pytest.approx(before)
    catalog = M.ModelCatalog.from_dict({"default_model": "line", "models": {"line": {"path": path, "version": "v1"}}})
    scored = M.score(readings, catalog)
    assert scored.first()["model_version"] == "v1"
    with pytest.raises(ValueError):
        M.score(readings, catalog, "other")


def test_linear_matches_least_squares(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(0, 0.1, 200)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], ["a", "b", "c", "y"])
    model = M.build_model("linear", "y").fit(M.assembled(df, ["a", "b", "c"], carry=["y"]))
    solved = np.linalg.lstsq(np.c_[x, np.ones(200)], y, rcond=None)[0]
    assert list(model.coefficients) == pytest.approx(solved[:3])
    assert column(M.coefficients(spark, model, ["a", "b", "c"]), "feature") == ["a", "c", "b"]


def test_collinear_columns_fit(spark):
    rows = [(float(i), 2.0 * i, 2.0 * i + 0.5 * 2 * i) for i in range(1, 9)]
    df = spark.createDataFrame(rows, ["x1", "x2", "y"])
    data = M.assembled(df, ["x1", "x2"], carry=["y"])
    train, test = data.filter("y <= 18"), data.filter("y > 18")
    for kind, params in (("linear_regression", {}), ("random_forest", {"numTrees": 10, "seed": 0, "maxDepth": 5}), ("xgboost", {"maxIter": 5})):
        model = M.build_model(kind, "y", params).fit(train)
        row = M.evaluate(model, train, test, "y").first().asDict()
        assert np.isfinite(list(row.values())).all()
    with pytest.raises(ValueError):
        M.build_model("unknown", "y")


@pytest.fixture(scope="module")
def line(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=403)
    rows = [(i, float(v), float(3 * v + 1 + e)) for i, (v, e) in enumerate(zip(x, rng.normal(0, 0.5, 403)))]
    return spark.createDataFrame(rows, "id long, x double, y double").persist()


def pipeline():
    return Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), M.build_model("linear", "y")])


def test_split_depends_on_the_key_only(line):
    train, test = train_test(line, "id")
    assert train.count() + test.count() == 403 and 50 < test.count() < 110
    assert train.join(test, "id").count() == 0
    again = hash_split(line.repartition(11), "id").filter("split = 'test'")
    assert set(column(again, "id")) == set(column(test, "id"))
    with pytest.raises(ValueError):
        hash_split(line, "id", 1.5)


def test_folds_are_runs_of_equal_length(line):
    rows = folds(line, "id", 5).orderBy("id").collect()
    sizes = [sum(r["fold"] == i for r in rows) for i in range(5)]
    assert sizes == [81, 81, 81, 80, 80]
    assert [r["fold"] for r in rows] == sorted(r["fold"] for r in rows)
    assert folds(line, "id", 3, shuffled=True).select("fold").distinct().count() == 3


def test_metrics(line):
    scored = line.withColumn("prediction", F.col("x") * 3 + 1)
    row = regression_metrics(scored, "y", "prediction").first()
    pdf = scored.toPandas()
    error = pdf.y - pdf.prediction
    assert row["rmse"] == pytest.approx(np.sqrt((error**2).mean()))
    assert row["mae"] == pytest.approx(error.abs().mean())
    assert row["r2"] == pytest.approx(1 - (error**2).sum() / ((pdf.y - pdf.y.mean()) ** 2).sum())
    assert row["mape"] == pytest.approx((error / pdf.y).abs().mean() * 100)
    assert residuals(scored, "y").agg(F.sum("residual")).first()[0] == pytest.approx(error.sum())
    split = split_metrics(hash_split(scored, "id"), "y", "prediction").first()
    assert split["rmse_train"] != split["rmse_test"]
    two = degradation({"a": scored, "b": scored.withColumn("prediction", F.lit(0.0))}, "y").collect()
    assert {r["dataset"]: r["rmse"] for r in two}["b"] > row["rmse"]


def test_cross_validation(line):
    rows = M.cross_validate(pipeline(), line, "y", "id", 4)
    assert rows.count() == 8
    summary = {r["metric"]: r for r in M.summarize_folds(rows).collect()}
    assert set(summary) == {"rmse", "mae", "r2"} and summary["r2"]["test_mean"] > 0.9
    assert M.fold_scores(rows).count() == 4


def test_grid_search(line):
    from pyspark.ml.feature import VectorAssembler as VA

    gbt = Pipeline(stages=[VA(inputCols=["x"], outputCol="features"), M.build_model("boosted_trees", "y", {"maxIter": 2, "maxDepth": 2})])
    found = M.grid_search(gbt, line, "y", "id", {"maxIter": [1, 4], "maxDepth": [2]}, k=2)
    assert found.table.count() == 2 and found.best_params["maxIter"] == 4
    assert len(list(M.SEARCH_GRID.values())) == 5


def test_suite_stores_metrics_and_models(spark, line, tmp_path):
    rows = train_suite(
        line, "y", "id", ["linear_regression", "boosted_trees"], {"boosted_trees": {"maxIter": 2}},
        metrics_path=str(tmp_path / "metrics"), model_path=str(tmp_path / "models"),
    )
    assert rows.count() == 10
    assert spark.read.json(str(tmp_path / "metrics")).count() == 10
    assert (tmp_path / "models" / "linear_regression").exists()


def test_compare_models_rejects_unknown_kinds(readings):
    keyed = readings.withColumn("id", F.col("nsm"))
    with pytest.raises(ValueError):
        compare_models(keyed, ENERGY_ROLES, "id", ["nonsense"])


def test_requests(spark):
    maps = spark.createDataFrame([({"a": 1.0, "b": 2.0},)], "features map<string,double>")
    assert M.vectorize(maps, ["b", "a"]).first()[:] == (2.0, 1.0)
    lists = spark.createDataFrame([([1.0, 2.0],)], "values array<double>")
    assert M.vectorize(lists, ["a", "b"]).first()[:] == (1.0, 2.0)
    with pytest.raises(Exception, match="missing"):
        M.vectorize(maps, ["a", "c"]).collect()
    with pytest.raises(Exception, match="missing"):
        M.vectorize(lists, ["a"]).collect()
    with pytest.raises(ValueError):
        M.vectorize(maps.select(F.lit(1).alias("x")), ["a"])


def test_engineer(spark, tmp_path):
    df = spark.createDataFrame([(i, i * 2, i % 3, 9) for i in range(40)], ["f1", "f2", "target", "drop_me"])
    train, test = engineer(df, ["f1", "f2"], "target", "f1", ["drop_me"], str(tmp_path / "f"), share=0.5)
    assert train.count() + test.count() == 40 and "drop_me" not in train.columns
    assert spark.read.parquet(str(tmp_path / "f")).columns == ["f1", "f2", "target"]
    with pytest.raises(ValueError):
        engineer(df, ["f1"], "target", "f1", ["target"])


def test_clipping_keeps_nan_missing(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(float("nan"),), (None,)], "x double")
    made = QuantileClipper(columns=["x"]).fit(df).transform(df)
    assert made.filter("x is null").count() == 2 and made.filter("isnan(x)").count() == 0


def test_dummies_of_other_types(spark):
    df = spark.createDataFrame([(True, 2), (False, 10), (True, 30)], "b boolean, n int")
    made = Dummies(columns=["b", "n"]).fit(df).transform(df)
    assert made.columns == ["b_true", "n_10", "n_30"]
    assert column(made, "b_true") == [1, 0, 1] and column(made, "n_10") == [0, 1, 0]


def test_many_categories(spark):
    df = spark.range(1500).select(F.concat(F.lit("v"), "id").alias("c"))
    model = Dummies(columns=["c"]).fit(df)
    assert sum(model.getOrDefault("sizes")) == 1500
    wide = SparseDummies(columns=["c"]).fit(df).transform(df)
    sizes = wide.select("c_dummies").collect()
    assert all(r[0].size == 1500 and r[0].numNonzeros() == 1 for r in sizes)
    assert len({int(r[0].indices[0]) for r in sizes}) == 1500


def test_missing_features_are_never_skipped(spark):
    df = spark.createDataFrame([(i, float(i), None if i == 3 else 1.0, 2.0 * i) for i in range(30)], "id long, a double, b double, y double")
    with pytest.raises(Exception, match="(?i)null|nan|invalid"):
        train_suite(df, "y", "id", kinds=["linear_regression"])
    row = train_suite(df.fillna(1.0), "y", "id", kinds=["linear_regression"]).filter("metric = 'r2' and split = 'test'").first()
    assert row["value"] == pytest.approx(1.0)


def test_sparse_dummies_are_never_made_dense(spark, tmp_path):
    from catalog.features import sparse_dummies

    spark.range(6000).selectExpr("id % 2000 AS l_partkey").write.parquet(str(tmp_path / "lineitem.parquet"))
    found = sparse_dummies(spark, str(tmp_path))
    assert found.collect() == [(6000, 6000.0, 2000)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "unwrap_udt" in plan.lower() or "unwrapudt" in plan.lower()


def test_feature_subsets_read_the_events_once(spark, folder):
    from catalog.modelling import feature_subsets

    found = feature_subsets(spark, folder)
    assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString()
    assert [r["features"] for r in found.collect()] == ["all", "no_k", "no_k_no_type"]
    assert all(r["explains"] for r in found.collect())
