"""Training jobs: fit and evaluate several kinds of model on one split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model, Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.names import column, numeric_columns
from tidegauge.operators.fused import FusedPipeline
from tidegauge.operators.models import (
    FEATURES,
    assembled,
    build_model,
    feature_stages,
    preprocessor_stages,
    save_model,
)
from tidegauge.operators.quality import split_metrics
from tidegauge.operators.split import hash_split
from tidegauge.roles import Roles
from tidegauge.sources.tables import METRIC_SCHEMA, append_metrics, feature_table

# The kinds of a full comparison.
ALL_KINDS = ("random_forest", "linear_regression", "boosted_trees")


def scored_split(
    pipeline: Pipeline, marked: DataFrame, target: str, prediction: str = "prediction"
) -> tuple[Model, DataFrame]:
    """Fit on the train rows of a marked table and score all rows once."""
    model = pipeline.fit(marked.filter(F.col("split") == "train"))
    return model, model.transform(marked).select("split", column(target), column(prediction))


def as_metric_rows(metrics: DataFrame, run: str, model: str) -> DataFrame:
    """The one-row split metrics as rows ``(run, model, split, metric, value)``."""
    names = [("train", "rmse"), ("test", "rmse"), ("test", "mae"), ("train", "r2"), ("test", "r2")]
    entries = [
        F.struct(
            F.lit(run).alias("run"),
            F.lit(model).alias("model"),
            F.lit(split).alias("split"),
            F.lit(metric).alias("metric"),
            F.col(f"{metric}_{split}").alias("value"),
        )
        for split, metric in names
    ]
    return metrics.select(F.inline(F.array(*entries)))


def compare_models(
    df: DataFrame,
    roles: Roles,
    key: str,
    kinds: Sequence[str] = ALL_KINDS,
    params: Mapping[str, Mapping] | None = None,
    run: str = "run",
    share: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Metric rows of full pipelines, one per kind, on the same hash split.

    The kinds share their features, which are fitted once on the train rows.
    """
    marked = hash_split(df, key, share, seed)
    stages = [*feature_stages(roles), *preprocessor_stages(roles, carry=["split", roles.target])]
    prepared = FusedPipeline(stages=stages).fit(marked.filter(F.col("split") == "train"))
    vectors = prepared.transform(marked).select("split", column(roles.target), FEATURES).persist()
    try:
        rows, _ = _fit_kinds(vectors, roles.target, kinds, params, run, roles.prediction)
    finally:
        vectors.unpersist()
    return rows


def _fit_kinds(
    vectors: DataFrame,
    target: str,
    kinds: Sequence[str],
    params: Mapping[str, Mapping] | None,
    run: str,
    prediction: str = "prediction",
) -> tuple[DataFrame, dict[str, Model]]:
    """Fit each kind on the train vectors; metric rows of all, and the models.

    The metrics are computed here, while the vectors are at hand: a few rows per kind.
    """
    estimators = {k: build_model(k, target, (params or {}).get(k), prediction=prediction) for k in kinds}
    models, found = {}, []
    for kind, estimator in estimators.items():
        models[kind], scored = scored_split(Pipeline(stages=[estimator]), vectors, target, prediction)
        metrics = split_metrics(scored, target, prediction)
        found += [tuple(r) for r in as_metric_rows(metrics, run, kind).collect()]
    return vectors.sparkSession.createDataFrame(found, METRIC_SCHEMA), models


def train_suite(
    features: DataFrame,
    target: str,
    key: str,
    kinds: Sequence[str] = ALL_KINDS,
    params: Mapping[str, Mapping] | None = None,
    run: str = "run",
    metrics_path: str | None = None,
    model_path: str | None = None,
) -> DataFrame:
    """Bare regressors on a stored numeric feature table; ``key`` only splits the rows.

    Appends to the metrics table and stores the models when paths are given.
    """
    table = feature_table(features, target)
    names = numeric_columns(table, [target, key])
    marked = hash_split(table, key)
    vectors = assembled(marked, names, carry=[target, "split"], output=FEATURES).persist()
    try:
        rows, models = _fit_kinds(vectors, target, kinds, params, run)
    finally:
        vectors.unpersist()
    if model_path:
        for kind, model in models.items():
            save_model(model, f"{model_path.rstrip('/')}/{kind}")
    if metrics_path:
        append_metrics(rows, metrics_path)
    return rows
