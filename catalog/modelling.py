"""Split, model and evaluation queries.

Where the result has a closed form the oracle uses it: regression aggregates for a line
through one feature, the normal equations for a full linear pipeline, group means for a tree
that may grow to single values. Whole forests have no SQL form; theirs says how many rows are
scored and what must hold of the errors, and they use few, shallow trees.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog.features import IS_TEST_SQL
from catalog.inputs import EVENT_ROLES, EVENTS_SQL, events, round_all, table
from tidegauge.operators import models as M
from tidegauge.operators.boosting import ShareBoostedTrees
from tidegauge.operators.profile import histogram
from tidegauge.operators.quality import (
    long_metrics,
    regression_metrics,
    residuals,
    split_metrics,
)
from tidegauge.operators.split import folds, hash_split
from tidegauge.plans.training import as_metric_rows, compare_models, train_suite
from tidegauge.session import shared_folder
from tidegauge.sources.tables import METRIC_SCHEMA, append_metrics, feature_table, read_table

LINE = {"linear_regression": {}}
SMALL = {
    "random_forest": {"numTrees": 5, "maxDepth": 4},
    "boosted_trees": {"maxIter": 4, "maxDepth": 3},
}


def _orders(spark, folder):
    """Order price against the number of its day, a table with a unique key."""
    days = F.datediff("o_orderdate", F.lit("1995-01-01")).cast("double")
    return table(spark, folder, "orders").select("o_orderkey", days.alias("x"), F.col("o_totalprice").alias("y"))


def _line(target="y"):
    return M.build_model("linear_regression", target)


def _line_pipeline():
    from pyspark.ml.feature import VectorAssembler

    return Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol=M.FEATURES), _line()])


def hash_split_rows(spark, folder):
    df = hash_split(table(spark, folder, "events"), "event_id")
    return df.select("event_id", "split")


def contiguous_folds(spark, folder):
    return folds(table(spark, folder, "events"), "event_id", 5).select("event_id", "fold")


def shuffled_folds(spark, folder):
    return folds(table(spark, folder, "events"), "event_id", 5, shuffled=True).select("event_id", "fold")


def linear_fit(spark, folder):
    """Coefficient table and intercept of a line fitted on all orders."""
    model = _line().fit(M.assembled(_orders(spark, folder), ["x"], carry=["y"]))
    table_ = M.coefficients(spark, model, ["x"])
    return round_all(table_.withColumn("intercept", F.lit(float(model.intercept))), 4)


def _scored(spark, folder):
    marked = hash_split(_orders(spark, folder), "o_orderkey")
    model = _line_pipeline().fit(marked.filter("split = 'train'"))
    return model.transform(marked)


def regression_metric_row(spark, folder):
    return round_all(split_metrics(_scored(spark, folder), "y", "prediction"), 3)


def metric_rows(spark, folder):
    df = regression_metrics(_scored(spark, folder), "y", "prediction", ["split"])
    return round_all(long_metrics(df, ["split"]), 3)


def _fold_metrics(spark, folder):
    return M.cross_validate(_line_pipeline(), _orders(spark, folder), "y", "o_orderkey", 5)


def cv_summary(spark, folder):
    return round_all(M.summarize_folds(_fold_metrics(spark, folder)), 3)


def cv_scores(spark, folder):
    return round_all(M.fold_scores(_fold_metrics(spark, folder)), 6)


def residual_histogram(spark, folder):
    """Residuals against a plain predictor, in 20 bins."""
    df = table(spark, folder, "lineitem").withColumn("prediction", F.col("l_quantity") * 2000.0)
    return round_all(histogram(residuals(df, "l_extendedprice"), "residual", 20))


def _stored_line(spark, folder):
    model = _line_pipeline().fit(_orders(spark, folder))
    path = M.save_model(model, f"{shared_folder(spark)}/models-{uuid4().hex}/line")
    return M.ModelCatalog({"line": M.ModelEntry(path, version="1")}, "line")


def batch_score(spark, folder):
    """Requests as maps, scored with the default model of a catalogue."""
    catalog = _stored_line(spark, folder)
    requests = _orders(spark, folder).select(
        "o_orderkey", F.create_map(F.lit("x"), F.col("x")).alias("features")
    )
    scored = M.score(M.vectorize(requests, ["x"]), catalog)
    return round_all(
        scored.select("o_orderkey", "prediction", "model_name", "model_source", "model_version"), 2
    )


def vector_score(spark, folder):
    """Requests as ordered values, scored with a named model."""
    catalog = _stored_line(spark, folder)
    requests = _orders(spark, folder).select("o_orderkey", F.array("x").alias("values"))
    scored = M.score(M.vectorize(requests, ["x"]), catalog, "line")
    return round_all(scored.select("o_orderkey", "prediction"), 2)


def metrics_sink(spark, folder):
    """Two appends to a metrics table, read back."""
    path = f"{shared_folder(spark)}/metrics-{uuid4().hex}"
    metrics = split_metrics(_scored(spark, folder), "y", "prediction")
    append_metrics(as_metric_rows(metrics, "first", "line"), path)
    append_metrics(as_metric_rows(metrics, "second", "line"), path)
    return round_all(read_table(spark, path, "json", METRIC_SCHEMA), 3)


def stored_features(spark, folder):
    """Numeric columns of a feature table without rows that lack the target."""
    df = events(spark, folder).withColumn(
        "value", F.when(F.col("event_id") % 7 != 0, F.col("value").cast("string"))
    )
    return feature_table(df, "value")


def _tree_rows(spark, folder, kind):
    """Rows scored per split, and whether the fit explains the rows it saw."""
    roles = EVENT_ROLES
    marked = hash_split(events(spark, folder), "event_id")
    pipeline = M.model_pipeline(roles, kind, SMALL.get(kind), carry=["split"])
    scored = M.fit_kept(pipeline, marked.filter("split = 'train'")).transform(marked)
    found = regression_metrics(scored, roles.target, "prediction", ["split"])
    return found.select("split", "n", (F.col("rmse") > 0).alias("scored"), ((F.col("split") == "test") | (F.col("r2") > 0)).alias("explains"))


def forest_fit(spark, folder):
    return _tree_rows(spark, folder, "random_forest")


def gbt_fit(spark, folder):
    return _tree_rows(spark, folder, "boosted_trees")


def _shown(spark, folder):
    """Two features of few values: hour of the event and half of the month."""
    return events(spark, folder).select(
        F.hour("ts").cast("double").alias("hour"), (F.dayofmonth("ts") > 15).cast("double").alias("half"), "value"
    )


def _group_means(spark, folder, kind, params):
    """A tree that may grow to single values predicts the mean of each group of equal features."""
    df = _shown(spark, folder)
    vectors = M.assembled(df, ["hour", "half"], carry=["hour", "half", "value"])
    scored = M.build_model(kind, "value", params).fit(vectors).transform(vectors)
    return round_all(scored.select("hour", "half", "prediction").distinct())


def forest_means(spark, folder):
    return _group_means(spark, folder, "random_forest", {"numTrees": 1, "bootstrap": False})


def boosting_means(spark, folder):
    """The first round of boosting is such a tree when it sees all rows and features."""
    return _group_means(
        spark, folder, "boosted_trees", {"maxIter": 1, "maxDepth": 10, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}
    )


def pipeline_fit(spark, folder):
    """Features, preprocessor and line: the residuals meet the normal equations.

    They sum to zero within every category and are orthogonal to every number of the vector.
    """
    roles = EVENT_ROLES
    df = events(spark, folder)
    made = M.fit_kept(M.model_pipeline(roles, "linear_regression", carry=["event_type"]), df).transform(df)
    residual = F.col("value") - F.col("prediction")
    slots = vector_to_array(M.FEATURES)
    names = M.number_slots(roles)
    first = F.size(slots) - len(names)
    per_type = made.groupBy(F.col("event_type").alias("item")).agg(F.count(F.lit(1)).alias("n"), F.sum(residual).alias("moment"))
    sums = made.agg(F.count(F.lit(1)).alias("n"), *[F.avg(residual * F.get(slots, first + i)).alias(f"m{i}") for i in range(len(names))])
    rows = F.inline(F.array(*[F.struct(F.lit(c).alias("item"), "n", F.col(f"m{i}").alias("moment")) for i, c in enumerate(names)]))
    found = per_type.unionByName(sums.select(rows))
    return found.select("item", "n", (F.abs("moment") < 1e-4).alias("is_zero"))


def feature_subsets(spark, folder):
    """The same line on all features, without one number, and without a category as well."""
    df = events(spark, folder)
    subsets = {"all": EVENT_ROLES, "no_k": EVENT_ROLES.without("k"), "no_k_no_type": EVENT_ROLES.without("k", "event_type")}
    # All subsets fit and score on the same kept rows.
    kept = df.persist()
    try:
        found = None
        for name, roles in subsets.items():
            scored = M.model_pipeline(roles, "linear_regression").fit(kept).transform(kept)
            row = regression_metrics(scored, roles.target, "prediction")
            row = row.select(F.lit(name).alias("features"), "n", ((F.col("r2") >= -1e-9) & (F.col("r2") <= 1)).alias("explains"))
            found = row if found is None else found.unionByName(row)
        # One row per subset: computed while the rows are kept.
        return spark.createDataFrame(found.collect(), found.schema)
    finally:
        kept.unpersist()


def pipeline_means(spark, folder):
    """Mean prediction per category: a line with a slot per category meets the mean."""
    roles = EVENT_ROLES
    df = events(spark, folder)
    scored = M.fit_kept(M.model_pipeline(roles, "linear_regression", carry=["event_type"]), df).transform(df)
    found = scored.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.avg("prediction").alias("mean_prediction")
    )
    return round_all(found)


def linear_suite(spark, folder):
    """Metric rows of a bare line through two features."""
    df = events(spark, folder).select("event_id", "user_id", "k", "value")
    return round_all(train_suite(df, "value", "event_id", ["linear_regression"]))


def _sound(rows):
    """Metric rows with what must hold of them: errors positive, a fit explains what it saw."""
    value = F.col("value")
    good = F.when(F.col("metric") == "r2", (value <= 1) & ((F.col("split") == "test") | (value > 0))).otherwise(value > 0)
    return rows.select("run", "model", "split", "metric", good.alias("sound"))


def model_comparison(spark, folder):
    return _sound(compare_models(events(spark, folder), EVENT_ROLES, "event_id", params=SMALL))


def suite(spark, folder):
    """Bare regressors on the numeric feature table."""
    df = events(spark, folder).select("event_id", "user_id", "k", "value")
    return _sound(train_suite(df, "value", "event_id", params=SMALL))


def search(spark, folder):
    """A line with and without intercept in three folds: mean error of both settings."""
    found = M.grid_search(_line_pipeline(), _orders(spark, folder), "y", "o_orderkey", {"fitIntercept": [True, False]}, k=3)
    return round_all(found.table.select(F.col("params")["fitIntercept"].alias("intercept"), "rmse", "rmse_std"), 3)


def _grouped_orders(spark, folder):
    """Order price, a number with seven values, and the same doubled."""
    g = (F.col("o_custkey") % 7).cast("double")
    return table(spark, folder, "orders").select("o_orderkey", g.alias("g"), (2 * g).alias("g2"), F.col("o_totalprice").cast("double").alias("y"))


def _group_booster(**settings):
    """Half of two equivalent columns for each tree; trees may grow to single values."""
    from pyspark.ml.feature import VectorAssembler

    booster = ShareBoostedTrees(labelCol="y", maxDepth=7, columnShare=0.5, rowShare=1.0, **settings)
    return Pipeline(stages=[VectorAssembler(inputCols=["g", "g2"], outputCol=M.FEATURES), booster])


def boosting_shares(spark, folder):
    """Boosting with one column per tree nears the group means by its step each round."""
    df = _grouped_orders(spark, folder)
    scored = _group_booster(maxIter=8, stepSize=0.25).fit(df).transform(df)
    return round_all(scored.groupBy("g").agg(F.count("y").alias("n"), F.min("prediction").alias("low"), F.max("prediction").alias("high")), 3)


def search_rounds(spark, folder):
    """Two lengths by two steps in three folds; lengths share one fit."""
    grid = {"maxIter": [2, 5], "stepSize": [0.1, 0.5]}
    found = M.grid_search(_group_booster(), _grouped_orders(spark, folder), "y", "o_orderkey", grid, k=3).table
    setting = F.col("params")
    return round_all(found.select(setting["maxIter"].cast("int").alias("rounds"), setting["stepSize"].cast("double").alias("step"), "rmse", "rmse_std"), 3)


def save_load_score(spark, folder):
    """A stored full pipeline gives the predictions it gave before it was stored."""
    df = events(spark, folder)
    model = M.model_pipeline(EVENT_ROLES, "linear_regression", carry=["event_id"]).fit(df)
    path = M.save_model(model, f"{shared_folder(spark)}/models-{uuid4().hex}/full")
    before = model.transform(df).select("event_id", F.col("prediction").alias("before"))
    after = M.load_model(path).transform(df).select("event_id", F.col("prediction").alias("after"))
    joined = before.join(after, "event_id")
    return joined.select("event_id", (F.abs(F.col("before") - F.col("after")) < 1e-9).alias("same"))


QUERIES = {
    "hash_split": hash_split_rows,
    "contiguous_folds": contiguous_folds,
    "shuffled_folds": shuffled_folds,
    "linear_fit": linear_fit,
    "regression_metrics": regression_metric_row,
    "metric_rows": metric_rows,
    "cv_summary": cv_summary,
    "cv_scores": cv_scores,
    "residuals": residual_histogram,
    "batch_score": batch_score,
    "vector_score": vector_score,
    "metrics_sink": metrics_sink,
    "feature_table": stored_features,
    "forest_fit": forest_fit,
    "gbt_fit": gbt_fit,
    "pipeline_fit": pipeline_fit,
    "forest_means": forest_means,
    "boosting_means": boosting_means,
    "feature_subsets": feature_subsets,
    "pipeline_means": pipeline_means,
    "linear_suite": linear_suite,
    "compare_models": model_comparison,
    "train_suite": suite,
    "grid_search": search,
    "boosting_shares": boosting_shares,
    "search_rounds": search_rounds,
    "save_load_score": save_load_score,
}

_ORDERS = """o AS (
  SELECT o_orderkey, CAST(date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS DOUBLE) AS x,
    o_totalprice AS y FROM orders)"""
_SIDE = IS_TEST_SQL.replace("event_id", "o_orderkey")
_SCORED = f"""{_ORDERS},
m AS (SELECT *, CASE WHEN {_SIDE} THEN 'test' ELSE 'train' END AS split FROM o),
w AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM m WHERE split = 'train'),
p AS (SELECT m.*, a * x + b AS p FROM m, w),
g AS (SELECT split, sqrt(AVG((y - p) ** 2)) AS rmse, AVG(abs(y - p)) AS mae,
        1 - SUM((y - p) ** 2) / (var_pop(y) * COUNT(*)) AS r2,
        100 * AVG(abs((y - p) / nullif(y, 0))) AS mape FROM p GROUP BY 1)"""
_ONE = "(SELECT {m} FROM g WHERE split = '{s}')"
_ROWS = [("train", "rmse"), ("test", "rmse"), ("test", "mae"), ("train", "r2"), ("test", "r2")]
_FOLDS = f"""{_ORDERS},
n AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, COUNT(*) OVER () AS t FROM o),
h AS (SELECT x, y, CAST(CASE WHEN i < (t % 5) * (t // 5 + 1) THEN i // (t // 5 + 1)
        ELSE (i - (t % 5)) // (t // 5) END AS INTEGER) AS fold FROM n),
w AS (SELECT v.f, regr_slope(y, x) AS a, regr_intercept(y, x) AS b
      FROM h JOIN range(5) AS v(f) ON h.fold <> v.f GROUP BY 1),
p AS (SELECT w.f, CASE WHEN h.fold = w.f THEN 'test' ELSE 'train' END AS split, y, a * x + b AS p
      FROM h CROSS JOIN w),
g AS (SELECT f, split, sqrt(AVG((y - p) ** 2)) AS rmse, AVG(abs(y - p)) AS mae,
        1 - SUM((y - p) ** 2) / (var_pop(y) * COUNT(*)) AS r2 FROM p GROUP BY 1, 2)"""

_GROUPED = "o AS (SELECT o_orderkey, CAST(o_custkey % 7 AS DOUBLE) AS g, CAST(o_totalprice AS DOUBLE) AS y FROM orders)"

SQL = {
    "boosting_shares": f"""WITH {_GROUPED}, m AS (SELECT AVG(y) AS m FROM o),
        w AS (SELECT g, COUNT(*) AS n, AVG(y) AS w FROM o GROUP BY 1)
        SELECT g, n, round(w - 0.75 ** 8 * (w - m), 3) AS low, round(w - 0.75 ** 8 * (w - m), 3) AS high FROM w, m""",
    "search_rounds": f"""WITH {_GROUPED},
        n AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, COUNT(*) OVER () AS t FROM o),
        h AS (SELECT g, y, CASE WHEN i < (t % 3) * (t // 3 + 1) THEN i // (t // 3 + 1)
                ELSE (i - (t % 3)) // (t // 3) END AS fold FROM n),
        k AS (SELECT f, g, y FROM h JOIN range(3) AS v(f) ON h.fold <> v.f),
        m AS (SELECT f, AVG(y) AS m FROM k GROUP BY 1),
        w AS (SELECT f, g, AVG(y) AS w FROM k GROUP BY 1, 2),
        s AS (SELECT s.rounds, s.step, h.fold, sqrt(AVG((y - w + (1 - s.step) ** s.rounds * (w - m)) ** 2)) AS rmse
              FROM h JOIN m ON m.f = h.fold JOIN w ON w.f = h.fold AND w.g = h.g
              CROSS JOIN (VALUES (2, 0.1), (2, 0.5), (5, 0.1), (5, 0.5)) AS s(rounds, step) GROUP BY 1, 2, 3)
        SELECT CAST(rounds AS INTEGER) AS rounds, CAST(step AS DOUBLE) AS step, round(AVG(rmse), 3) AS rmse,
          round(stddev_pop(rmse), 3) AS rmse_std FROM s GROUP BY 1, 2""",
    "hash_split": f"""SELECT event_id, CASE WHEN {IS_TEST_SQL} THEN 'test' ELSE 'train' END AS split
        FROM events""",
    "contiguous_folds": """SELECT event_id, CAST(CASE WHEN i < (t % 5) * (t // 5 + 1) THEN i // (t // 5 + 1)
          ELSE (i - (t % 5)) // (t // 5) END AS INTEGER) AS fold
        FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i, COUNT(*) OVER () AS t
              FROM events)""",
    "shuffled_folds": """SELECT event_id,
          CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR) || ':42'), 1, 8))::BIGINT % 5 AS INTEGER) AS fold
        FROM events""",
    "linear_fit": f"""WITH {_ORDERS} SELECT 'x' AS feature, round(regr_slope(y, x), 4) AS coef,
          round(regr_intercept(y, x), 4) AS intercept FROM o""",
    "regression_metrics": f"WITH {_SCORED} SELECT "
    + ", ".join(f"round({_ONE.format(m=m, s=s)}, 3) AS {m}_{s}" for s, m in _ROWS),
    "metric_rows": f"WITH {_SCORED} "
    + " UNION ALL ".join(
        f"SELECT split, '{m}' AS metric, round({m}, 3) AS value FROM g" for m in ("rmse", "mae", "r2", "mape")
    ),
    "cv_summary": f"WITH {_FOLDS} "
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, round(AVG({m}) FILTER (split = 'train'), 3) AS train_mean,
            round(AVG({m}) FILTER (split = 'test'), 3) AS test_mean,
            round(stddev_pop({m}) FILTER (split = 'test'), 3) AS test_std FROM g"""
        for m in ("rmse", "mae", "r2")
    ),
    "cv_scores": f"""WITH {_FOLDS} SELECT CAST(f AS INTEGER) AS fold, round(r2, 6) AS score
        FROM g WHERE split = 'test'""",
    "residuals": """WITH d AS (SELECT l_extendedprice - l_quantity * 2000 AS r FROM lineitem),
        s AS (SELECT MIN(r) AS lo, MAX(r) AS hi FROM d),
        b AS (SELECT CAST(least(floor((r - lo) / ((hi - lo) / 20)) + 1, 20) AS INTEGER) AS bin,
                COUNT(*) AS n FROM d, s GROUP BY 1)
        SELECT CAST(i AS INTEGER) AS bin, round(lo + (hi - lo) / 20 * (i - 1), 6) AS "from",
          round(lo + (hi - lo) / 20 * i, 6) AS "to", coalesce(n, 0) AS n
        FROM range(1, 21) AS r(i) CROSS JOIN s LEFT JOIN b ON b.bin = i""",
    "batch_score": f"""WITH {_ORDERS},
        w AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM o)
        SELECT o_orderkey, round(a * x + b, 2) AS prediction, 'line' AS model_name,
          'local' AS model_source, '1' AS model_version FROM o, w""",
    "vector_score": f"""WITH {_ORDERS},
        w AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM o)
        SELECT o_orderkey, round(a * x + b, 2) AS prediction FROM o, w""",
    "metrics_sink": f"WITH {_SCORED} "
    + " UNION ALL ".join(
        f"""SELECT '{run}' AS run, 'line' AS model, '{s}' AS split, '{m}' AS metric,
            round({_ONE.format(m=m, s=s)}, 3) AS value"""
        for run in ("first", "second")
        for s, m in _ROWS
    ),
    "feature_table": f"""WITH {EVENTS_SQL} SELECT event_id, user_id, k, value FROM e
        WHERE event_id % 7 <> 0""",
    **{
        name: f"""SELECT CASE WHEN {IS_TEST_SQL} THEN 'test' ELSE 'train' END AS split, COUNT(*) AS n,
          TRUE AS scored, TRUE AS explains FROM events GROUP BY 1"""
        for name in ("forest_fit", "gbt_fit")
    },
    **{
        name: """SELECT CAST(hour(ts) AS DOUBLE) AS hour, CAST(day(ts) > 15 AS INTEGER)::DOUBLE AS half,
          round(AVG(value), 6) AS prediction FROM events GROUP BY 1, 2"""
        for name in ("forest_means", "boosting_means")
    },
    "pipeline_fit": "SELECT event_type AS item, COUNT(*) AS n, TRUE AS is_zero FROM events GROUP BY 1"
    + "".join(f" UNION ALL SELECT '{c}', COUNT(*), TRUE FROM events" for c in M.number_slots(EVENT_ROLES)),
    "feature_subsets": " UNION ALL ".join(
        f"SELECT '{c}' AS features, COUNT(*) AS n, TRUE AS explains FROM events" for c in ("all", "no_k", "no_k_no_type")
    ),
    **{
        name: " UNION ALL ".join(
            f"SELECT 'run' AS run, '{m}' AS model, '{s}' AS split, '{c}' AS metric, TRUE AS sound"
            for m in ("random_forest", "linear_regression", "boosted_trees")
            for s, c in _ROWS
        )
        for name in ("compare_models", "train_suite")
    },
    "grid_search": f"""WITH {_ORDERS},
        n AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, COUNT(*) OVER () AS t FROM o),
        h AS (SELECT x, y, CASE WHEN i < (t % 3) * (t // 3 + 1) THEN i // (t // 3 + 1)
                ELSE (i - (t % 3)) // (t // 3) END AS fold FROM n),
        w AS (SELECT f, regr_slope(y, x) AS a, regr_intercept(y, x) AS b, SUM(x * y) / SUM(x * x) AS c
              FROM h JOIN range(3) AS v(f) ON h.fold <> v.f GROUP BY 1),
        e AS (SELECT f, sqrt(AVG((y - a * x - b) ** 2)) AS one, sqrt(AVG((y - c * x) ** 2)) AS two
              FROM h JOIN w ON h.fold = w.f GROUP BY 1)
        SELECT 'True' AS intercept, round(AVG(one), 3) AS rmse, round(stddev_pop(one), 3) AS rmse_std FROM e
        UNION ALL SELECT 'False', round(AVG(two), 3), round(stddev_pop(two), 3) FROM e""",
    "pipeline_means": """SELECT event_type, COUNT(*) AS n, round(AVG(value), 6) AS mean_prediction
        FROM events GROUP BY 1""",
    "linear_suite": f"""WITH {EVENTS_SQL},
        m AS (SELECT *, CASE WHEN {IS_TEST_SQL} THEN 'test' ELSE 'train' END AS split FROM e),
        c AS (SELECT AVG(value) AS my, AVG(k) AS m1, AVG(user_id) AS m2, var_pop(k) AS v1,
                var_pop(user_id) AS v2, covar_pop(k, user_id) AS v12, covar_pop(k, value) AS c1,
                covar_pop(user_id, value) AS c2 FROM m WHERE split = 'train'),
        w AS (SELECT *, (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) AS b1,
                (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) AS b2 FROM c),
        p AS (SELECT split, value AS y, my + b1 * (k - m1) + b2 * (user_id - m2) AS p FROM m, w),
        g AS (SELECT split, sqrt(AVG((y - p) ** 2)) AS rmse, AVG(abs(y - p)) AS mae,
                1 - SUM((y - p) ** 2) / (var_pop(y) * COUNT(*)) AS r2 FROM p GROUP BY 1) """
    + " UNION ALL ".join(
        f"""SELECT 'run' AS run, 'linear_regression' AS model, '{s}' AS split, '{m}' AS metric,
            round({_ONE.format(m=m, s=s)}, 6) AS value"""
        for s, m in _ROWS
    ),
    "save_load_score": "SELECT event_id, TRUE AS same FROM events",
}
