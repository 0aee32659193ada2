"""Regression models on Spark ML: pipelines, validation, search, scoring, storage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.names import column, quoted, require, safe_name
from tidegauge.operators.boosting import ShareBoostedTrees, path_rmse
from tidegauge.operators.fused import FusedPipeline
from tidegauge.operators.least_squares import LeastSquares
from tidegauge.operators.quality import long_metrics, regression_metrics, split_metrics
from tidegauge.operators.split import folds
from tidegauge.operators.stages import (
    DateFeatures,
    Interactions,
    MedianImputer,
    ModeImputer,
    QuantileClipper,
    SafeColumns,
    Standardizer,
)
from tidegauge.roles import Roles

FEATURES = "features"

# Default settings per kind. Spark caps the depth of a tree at 30. Up to 4,096
# features the linear solver takes the normal equations, beyond them gradients. A full set
# of category slots makes the normal equations singular; ``LeastSquares`` solves them exactly.
DEFAULTS = {
    "linear_regression": {
        "fitIntercept": True,
        "solver": "auto",
        "regParam": 0.0,
        "maxIter": 1000,
        "tol": 1e-13,
    },
    "random_forest": {
        "numTrees": 300,
        "maxDepth": 30,
        "minInstancesPerNode": 1,
        "featureSubsetStrategy": "all",
        "seed": 42,
    },
    "boosted_trees": {
        "maxIter": 200,
        "maxDepth": 6,
        "stepSize": 0.1,
        "subsamplingRate": 0.8,
        "featureSubsetStrategy": "0.8",
        "seed": 42,
    },
}
KINDS = {
    "linear_regression": LeastSquares,
    "random_forest": RandomForestRegressor,
    "boosted_trees": GBTRegressor,
}
ALIASES = {"linear": "linear_regression", "rf": "random_forest", "xgboost": "boosted_trees", "xgb": "boosted_trees"}

# The searched settings, 32 combinations.
SEARCH_GRID = {
    "maxIter": [200, 400],
    "maxDepth": [4, 6],
    "stepSize": [0.03, 0.1],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.7", "1.0"],
}


def build_model(
    kind: str,
    target: str,
    params: Mapping[str, object] | None = None,
    features: str = FEATURES,
    prediction: str = "prediction",
) -> Estimator:
    """A regressor by kind with its default settings; unknown kinds raise ``ValueError``."""
    name = ALIASES.get(kind, kind)
    if name not in KINDS:
        raise ValueError(f"unknown model kind '{kind}', expected one of {sorted(KINDS)}")
    settings = {**DEFAULTS[name], **(params or {})}
    return KINDS[name](featuresCol=features, labelCol=target, predictionCol=prediction, **settings)


def _deriving(roles: Roles, use_date: bool, drop_na: bool = False) -> tuple[DateFeatures, Interactions]:
    """The stages that derive columns from those of ``roles``."""
    dates = DateFeatures(
        timeCol=roles.time, dropOriginal=True, addCyclical=use_date, generate=use_date, dropNa=drop_na and use_date
    )
    return dates, Interactions(columns=list(roles.interactions), ratios=True, products=False)


def feature_stages(roles: Roles, drop_na: bool = False, use_date: bool = True) -> list:
    """Date features, clipping to the 1st and 99th percentile, ratios."""
    dates, pairs = _deriving(roles, use_date, drop_na)
    clipper = QuantileClipper(columns=[*roles.numeric, *dates.feature_names()], lower=0.01, upper=0.99)
    return [dates, clipper, pairs] if roles.interactions else [dates, clipper]


def number_slots(roles: Roles, use_date: bool = True) -> list[str]:
    """Numeric columns of the feature vector in its order, as the stages name them."""
    return [*roles.numeric, *(name for stage in _deriving(roles, use_date) for name in stage.feature_names())]


def preprocessor_stages(
    roles: Roles, use_date: bool = True, output: str = FEATURES, carry: Sequence[str] = ()
) -> list:
    """Impute and one-hot categories, impute and standardise numbers, then assemble.

    The vector holds the categorical block first. Unseen and missing categories are all
    zeros. Other columns are dropped, but for the target and those in ``carry``.
    """
    numbers = number_slots(roles, use_date)
    kept = [*carry] + ([roles.target] if roles.target not in carry else [])
    texts = [safe_name(c) for c in roles.categorical]
    values = [safe_name(c) for c in numbers]
    stages: list = [SafeColumns(columns=[*roles.categorical, *numbers], carry=kept)]
    blocks = []
    if texts:
        blocks = [f"{c}__hot" for c in texts]
        places = [f"{c}__ix" for c in texts]
        stages += [
            ModeImputer(columns=texts),
            StringIndexer(
                inputCols=texts,
                outputCols=places,
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            ),
            OneHotEncoder(inputCols=places, outputCols=blocks, dropLast=True),
        ]
    stages += [
        MedianImputer(columns=values),
        Standardizer(columns=values),
        VectorAssembler(inputCols=[*blocks, *values], outputCol=output),
    ]
    return stages


def model_pipeline(
    roles: Roles,
    kind: str,
    params: Mapping[str, object] | None = None,
    drop_na: bool = False,
    use_date: bool = True,
    carry: Sequence[str] = (),
) -> Pipeline:
    """Features, preprocessor and regressor in one pipeline."""
    return FusedPipeline(
        stages=[
            *feature_stages(roles, drop_na, use_date),
            *preprocessor_stages(roles, use_date, carry=carry),
            build_model(kind, roles.target, params, prediction=roles.prediction),
        ]
    )


def fit_kept(estimator: Estimator, df: DataFrame) -> Model:
    """Fit on rows that are kept meanwhile: stages read their input several times."""
    kept = df.persist()
    try:
        return estimator.fit(kept)
    finally:
        kept.unpersist()


def assembled(
    df: DataFrame, columns: Sequence[str], carry: Sequence[str] = (), output: str = FEATURES
) -> DataFrame:
    """``carry`` columns plus a vector of ``columns``; a row that lacks one is an error.

    Rows are never left out: impute first where values may be missing.
    """
    require(df, [*columns, *carry])
    plain = df.select(
        *[column(c) for c in carry],
        *[column(c).cast("double").alias(f"x__{i}") for i, c in enumerate(columns)],
    )
    names = [f"x__{i}" for i in range(len(columns))]
    return (
        VectorAssembler(inputCols=names, outputCol=output, handleInvalid="error")
        .transform(plain)
        .select(*[column(c) for c in carry], output)
    )


def coefficients(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """Coefficients of a fitted linear model, largest first."""
    rows = sorted(zip(names, map(float, model.coefficients)), key=lambda r: -r[1])
    return spark.createDataFrame(rows, "feature string, coef double")


def evaluate(model: Model, train: DataFrame, test: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE and R2 of both parts from one pass over the predictions."""
    scored = None
    for split, part in (("train", train), ("test", test)):
        rows = model.transform(part).select(
            F.lit(split).alias("split"), column(target), column(prediction)
        )
        scored = rows if scored is None else scored.unionByName(rows)
    return split_metrics(scored, target, prediction)


def cross_validate(
    estimator: Estimator,
    df: DataFrame,
    target: str,
    key: str,
    k: int = 5,
    shuffled: bool = False,
    parallelism: int = 2,
    prediction: str = "prediction",
) -> DataFrame:
    """Metrics per fold and part, ``(fold, split, n, rmse, mae, r2, mape)``.

    Each fold fits on the others. Fits run a few at a time; all metrics come from one
    aggregate over the union of the scored folds. The marked rows are kept for all of them.
    """
    marked = folds(df, key, k, shuffled).persist()
    pool = ThreadPool(min(parallelism, k))
    try:
        fitted = pool.map(
            lambda i: estimator.fit(marked.filter(F.col("fold") != i).drop("fold")), range(k)
        )
    finally:
        pool.close()
    scored = None
    for i, model in enumerate(fitted):
        for split, test in (("train", F.col("fold") != i), ("test", F.col("fold") == i)):
            rows = model.transform(marked.filter(test).drop("fold")).select(
                F.lit(i).alias("fold"), F.lit(split).alias("split"), column(target), column(prediction)
            )
            scored = rows if scored is None else scored.unionByName(rows)
    found = regression_metrics(scored, target, prediction, ["fold", "split"])
    # Two rows per fold: computed while the marked rows are kept.
    rows = df.sparkSession.createDataFrame(found.collect(), found.schema)
    marked.unpersist()
    return rows


def summarize_folds(fold_metrics: DataFrame, names: Sequence[str] = ("rmse", "mae", "r2")) -> DataFrame:
    """``metric, train_mean, test_mean, test_std`` (population std) over the folds."""
    rows = long_metrics(fold_metrics, ["fold", "split"], names)
    train, test = F.col("split") == "train", F.col("split") == "test"
    return rows.groupBy("metric").agg(
        F.avg(F.when(train, F.col("value"))).alias("train_mean"),
        F.avg(F.when(test, F.col("value"))).alias("test_mean"),
        F.stddev_pop(F.when(test, F.col("value"))).alias("test_std"),
    )


def fold_scores(fold_metrics: DataFrame, metric: str = "r2") -> DataFrame:
    """One test score per fold."""
    return fold_metrics.filter(F.col("split") == "test").select("fold", F.col(metric).alias("score"))


@dataclass(frozen=True)
class SearchResult:
    """Best pipeline refitted on all rows, its settings, and the mean RMSE of each setting."""

    best: PipelineModel
    best_params: dict[str, object]
    table: DataFrame


def _fold_rmse(
    features: Pipeline,
    regressor: Estimator,
    maps: Sequence[dict],
    train: DataFrame,
    valid: DataFrame,
    target: str,
    prediction: str,
    parallelism: int,
) -> list[float]:
    """RMSE on ``valid`` of the regressor under each setting, features fitted once.

    Boosters whose settings differ in the number of rounds only share one fit of the longest:
    its first rounds are those of the shorter ones.
    """
    fitted = features.fit(train)
    keep = [column(target), column(regressor.getFeaturesCol())]
    if isinstance(regressor, ShareBoostedTrees) and regressor.isDefined("keyCol"):
        keep.append(column(regressor.getOrDefault("keyCol")))
    parts = [fitted.transform(part).select(*keep).persist() for part in (train, valid)]

    boosted = isinstance(regressor, GBTRegressor | ShareBoostedTrees)
    paths: dict[tuple, list[int]] = {}
    for j, settings in enumerate(maps):
        alike = tuple(sorted((p.name, v) for p, v in settings.items() if p.name != "maxIter"))
        paths.setdefault(alike if boosted else (j,), []).append(j)

    def one(group: list[int]) -> dict[int, float]:
        if not boosted:
            scored = regressor.fit(parts[0], maps[group[0]]).transform(parts[1])
            return {group[0]: regression_metrics(scored, target, prediction).first()["rmse"]}
        rounds = {j: maps[j].get(regressor.maxIter, regressor.getMaxIter()) for j in group}
        longest = max(group, key=rounds.get)
        model = regressor.fit(parts[0], maps[longest])
        lead = int(isinstance(regressor, ShareBoostedTrees))
        errors = path_rmse(model, parts[1].filter(column(target).isNotNull()), list(rounds.values()), lead)
        return {j: errors[n] for j, n in rounds.items()}

    pool = ThreadPool(max(1, min(parallelism, len(paths))))
    try:
        found = {j: error for each in pool.map(one, paths.values()) for j, error in each.items()}
        return [found[j] for j in range(len(maps))]
    finally:
        pool.close()
        for part in parts:
            part.unpersist()


def grid_search(
    pipeline: Pipeline,
    df: DataFrame,
    target: str,
    key: str,
    grid: Mapping[str, Sequence] | None = None,
    k: int = 3,
    parallelism: int = 2,
    prediction: str = "prediction",
) -> SearchResult:
    """Try every combination of the last stage's settings by k-fold RMSE; refit the best.

    The settings concern the regressor only, so the stages before it are fitted once per
    fold, not once per fold and setting. Numbers of rounds of a booster share one fit.
    """
    *before, regressor = pipeline.getStages()
    builder = ParamGridBuilder()
    for name, values in (grid or SEARCH_GRID).items():
        builder = builder.addGrid(regressor.getParam(name), list(values))
    maps = builder.build()
    marked = folds(df, key, k)
    scores = [
        _fold_rmse(
            FusedPipeline(stages=before),
            regressor,
            maps,
            marked.filter(F.col("fold") != i).drop("fold"),
            marked.filter(F.col("fold") == i).drop("fold"),
            target,
            prediction,
            parallelism,
        )
        for i in range(k)
    ]
    rows = [
        ({p.name: str(v) for p, v in m.items()}, i, float(fold[j]))
        for j, m in enumerate(maps)
        for i, fold in enumerate(scores)
    ]
    table = (
        df.sparkSession.createDataFrame(rows, "params map<string,string>, fold int, rmse double")
        .groupBy(F.to_json("params").alias("settings"))
        .agg(F.avg("rmse").alias("rmse"), F.stddev_pop("rmse").alias("rmse_std"))
        .select(F.from_json("settings", "map<string,string>").alias("params"), "rmse", "rmse_std")
    )
    best = min(range(len(maps)), key=lambda j: sum(fold[j] for fold in scores))
    fitted = pipeline.copy({p: v for p, v in maps[best].items()}).fit(df)
    return SearchResult(fitted, {p.name: v for p, v in maps[best].items()}, table)


# --- scoring --------------------------------------------------------------------------


def save_model(model: Model, path: str, version: str | None = None) -> str:
    """Store a fitted model under ``path/version=<timestamp>``; returns that path."""
    version = version or datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S")
    full = f"{path.rstrip('/')}/version={version}"
    model.write().save(full)
    return full


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


@dataclass(frozen=True)
class ModelEntry:
    path: str
    source: str = "local"
    version: str | None = None


@dataclass(frozen=True)
class ModelCatalog:
    """Stored models by name, with a default."""

    models: Mapping[str, ModelEntry] = field(default_factory=dict)
    default: str | None = None

    @staticmethod
    def from_dict(stored: Mapping) -> "ModelCatalog":
        entries = {n: ModelEntry(**spec) for n, spec in stored["models"].items()}
        return ModelCatalog(entries, stored.get("default_model"))

    def name(self, wanted: str | None = None) -> str:
        name = wanted or self.default or next(iter(self.models), None)
        if name not in self.models:
            raise ValueError(f"model '{name}' is not in the catalogue")
        return name


def vectorize(requests: DataFrame, order: Sequence[str]) -> DataFrame:
    """Requests to one double column per feature, in ``order``.

    A request holds ``values array<double>`` in that order or ``features map<string,double>``.
    An absent feature or a list of another length is an error when the row is computed.
    """
    have = set(requests.columns)
    if not have & {"values", "features"}:
        raise ValueError("a request needs 'values' or 'features'")
    others = [column(c) for c in requests.columns if c not in ("values", "features")]
    picked = []
    for i, name in enumerate(order):
        options = []
        if "values" in have:
            right = F.size("values") == len(order)
            options.append(F.when(right, F.try_element_at("values", F.lit(i + 1))))
        if "features" in have:
            options.append(F.try_element_at("features", F.lit(name)))
        missing = F.raise_error(F.lit(f"feature '{name}' is missing")).cast("double")
        picked.append(F.coalesce(*options, missing).cast("double").alias(name))
    return requests.select(*others, *picked)


def score(
    df: DataFrame, catalog: ModelCatalog, name: str | None = None, prediction: str = "prediction"
) -> DataFrame:
    """Batch scoring with a catalogued model; adds the prediction and where it came from."""
    chosen = catalog.name(name)
    entry = catalog.models[chosen]
    scored = load_model(entry.path).transform(df)
    return scored.withColumns(
        {
            prediction: column(prediction).cast("double"),
            "model_name": F.lit(chosen),
            "model_source": F.lit(entry.source),
            "model_ref": F.lit(entry.path),
            "model_version": F.lit(entry.version).cast("string"),
        }
    )
