"""Feature stage queries."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog.inputs import EVENT_ROLES, EVENTS_SQL, TYPED_SQL, dirty_events, events, round_all, table
from tidegauge.functions.names import normalize_headers
from tidegauge.operators import clean as C
from tidegauge.operators.fused import FusedPipeline
from tidegauge.operators.models import feature_stages, fit_kept, number_slots, preprocessor_stages
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
from tidegauge.plans.cleaning import time_columns
from tidegauge.plans.features import engineer, feature_frame

DATES = DateFeatures(timeCol=EVENT_ROLES.time).feature_names()


def _typed(spark, folder):
    df = normalize_headers(dirty_events(spark, folder))
    df = C.coerce_numeric(C.coerce_timestamp(df, "date"), ["usage_value"])
    return C.normalize_text(df, ["event_type"])


def date_features(spark, folder):
    df = _typed(spark, folder).select("event_id", "date")
    return round_all(DateFeatures(timeCol="date").transform(df), 5)


def date_batch_clip(spark, folder):
    df = events(spark, folder).select("event_id", "ts")
    made = DateFeatures(timeCol="ts").transform(df)
    return round_all(clip_batch(made, DATES[:4], 0.05, 0.95))


def clip_nan(spark, folder):
    """NaN stays missing."""
    nan = F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    df = table(spark, folder, "events").select("event_id", nan.alias("value"))
    return round_all(QuantileClipper(columns=["value"]).fit(df).transform(df))


def dummies_typed(spark, folder):
    """Booleans and whole numbers as categories."""
    df = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_tax") > 0.04).alias("high"), (F.col("l_linenumber") * 5).alias("n"))
    made = Dummies(columns=["high", "n"]).fit(df).transform(df)
    names = [c for c in made.columns if c not in ("l_orderkey", "l_linenumber")]
    return made.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in names])


def sparse_dummies(spark, folder):
    """One slot per part in a sparse vector: its sum is one for every row."""
    df = table(spark, folder, "lineitem").select("l_partkey")
    made = SparseDummies(columns=["l_partkey"]).fit(df).transform(df)
    # The stored form of a vector: its size, and its values other than zero.
    slots = F.unwrap_udt("l_partkey_dummies")
    total = F.aggregate(slots["values"], F.lit(0.0), lambda acc, x: acc + x)
    return made.agg(F.count(F.lit(1)).alias("rows"), F.sum(total).alias("ones"), F.max(slots["size"]).alias("slots"))


def ratio_features(spark, folder):
    df = table(spark, folder, "lineitem").select("l_quantity", "l_discount", "l_tax")
    return round_all(Interactions(columns=["l_quantity", "l_discount", "l_tax"]).transform(df), 4)


def product_features(spark, folder):
    df = table(spark, folder, "lineitem").select("l_quantity", "l_discount", "l_tax")
    stage = Interactions(columns=["l_quantity", "l_discount", "l_tax"], ratios=False, products=True)
    return round_all(stage.transform(df))


def clip_outliers(spark, folder):
    df = events(spark, folder).select("event_id", "value", "k")
    return round_all(QuantileClipper(columns=["value", "k"]).fit(df).transform(df))


def median_impute(spark, folder):
    df = _typed(spark, folder).select("event_id", "usage_value")
    return round_all(MedianImputer(columns=["usage_value"]).fit(df).transform(df))


def mode_impute(spark, folder):
    df = _typed(spark, folder).select("event_id", "event_type")
    return ModeImputer(columns=["event_type"]).fit(df).transform(df)


def one_hot(spark, folder):
    """Every value becomes a slot; missing ones are all zeros."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    df = table(spark, folder, "events").select("event_id", "event_type")
    stages = [
        StringIndexer(
            inputCol="event_type", outputCol="ix", stringOrderType="alphabetAsc", handleInvalid="keep"
        ),
        OneHotEncoder(inputCol="ix", outputCol="hot", dropLast=True),
    ]
    gaps = df.withColumn("event_type", F.when(F.col("event_id") % 9 != 0, F.col("event_type")))
    hot = vector_to_array("hot")
    made = Pipeline(stages=stages).fit(df).transform(gaps)
    return made.select("event_id", *[hot[i].alias(f"h{i}") for i in range(5)])


def dummies(spark, folder):
    df = table(spark, folder, "lineitem").select("l_quantity", "l_returnflag", "l_linestatus")
    return Dummies(columns=["l_returnflag", "l_linestatus"]).fit(df).transform(df)


def time_parts(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return time_columns(df, "o_orderdate").drop("o_orderdate")


def standardize(spark, folder):
    df = events(spark, folder).select("event_id", "value", "k")
    return round_all(Standardizer(columns=["value", "k"]).fit(df).transform(df))


def frame(spark, folder):
    df = feature_frame(events(spark, folder), EVENT_ROLES)
    return df.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


def feature_pipeline(spark, folder):
    """Date features, clipping and the ratio, fitted and applied."""
    df = events(spark, folder).select("event_id", "ts", "user_id", "k")
    return round_all(FusedPipeline(stages=feature_stages(EVENT_ROLES)).fit(df).transform(df), 5)


def feature_matrix(spark, folder):
    """The vector a model sees, slot by slot: categories first, then scaled numbers."""
    df = events(spark, folder)
    stages = [*feature_stages(EVENT_ROLES), *preprocessor_stages(EVENT_ROLES, carry=["event_id"])]
    made = fit_kept(FusedPipeline(stages=stages), df).transform(df)
    slots = vector_to_array("features")
    width = 5 + len(_SCALED)
    return round_all(made.select("event_id", *[slots[i].alias(f"x{i}") for i in range(width)]), 4)


def engineered_split(spark, folder):
    df = table(spark, folder, "events")
    train, test = engineer(df, ["event_id", "user_id"], "value", "event_id", drop=["props"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


QUERIES = {
    "clip_nan": clip_nan,
    "dummies_typed": dummies_typed,
    "sparse_dummies": sparse_dummies,
    "date_features": date_features,
    "batch_clip": date_batch_clip,
    "ratio_features": ratio_features,
    "product_features": product_features,
    "clip_outliers": clip_outliers,
    "median_impute": median_impute,
    "mode_impute": mode_impute,
    "one_hot": one_hot,
    "dummies": dummies,
    "time_columns": time_parts,
    "standardize": standardize,
    "feature_frame": frame,
    "feature_pipeline": feature_pipeline,
    "feature_matrix": feature_matrix,
    "engineered_split": engineered_split,
}

IS_TEST_SQL = "('0x' || substr(md5(CAST(event_id AS VARCHAR) || ':42'), 1, 8))::BIGINT < 858993459"

_PAIRS = [("l_quantity", "l_discount"), ("l_quantity", "l_tax"), ("l_discount", "l_tax")]

# Date parts as 32-bit floats, then all clipped to their 1st and 99th percentile.
_PARTS_SQL = """d AS (
  SELECT event_id, event_type, CAST(user_id AS DOUBLE) AS user_id, k,
    CAST(hour(ts) AS DOUBLE) AS ts_hour, CAST(isodow(ts) - 1 AS DOUBLE) AS ts_dayofweek,
    CAST(month(ts) AS DOUBLE) AS ts_month, CAST(dayofyear(ts) AS DOUBLE) AS ts_dayofyear,
    CAST(CAST(sin(2 * pi() * hour(ts) / 24) AS FLOAT) AS DOUBLE) AS ts_sin_hour,
    CAST(CAST(cos(2 * pi() * hour(ts) / 24) AS FLOAT) AS DOUBLE) AS ts_cos_hour
  FROM e)"""
_CLIPPED = ["k", "user_id", *DATES]
_CLIP_SQL = (
    "b AS (SELECT "
    + ", ".join(
        f"quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.99) AS {c}_hi" for c in _CLIPPED
    )
    + " FROM d), c AS (SELECT event_id, event_type, "
    + ", ".join(f"least(greatest({c}, {c}_lo), {c}_hi) AS {c}" for c in _CLIPPED)
    + " FROM d, b), f AS (SELECT *, coalesce(user_id / nullif(k, 0), 0) AS user_id__div__k FROM c)"
)
_SCALED = number_slots(EVENT_ROLES)

SQL = {
    "clip_nan": """WITH e AS (SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events),
        b AS (SELECT quantile_cont(value, 0.01) AS vl, quantile_cont(value, 0.99) AS vh FROM e)
        SELECT event_id, CASE WHEN value IS NOT NULL THEN round(least(greatest(value, vl), vh), 6) END AS value FROM e, b""",
    "dummies_typed": """SELECT l_linenumber, COUNT(*) AS rows, CAST(SUM(CAST(l_tax > 0.04 AS INTEGER)) AS BIGINT) AS high_true, """
    + ", ".join(f"CAST(SUM(CAST(l_linenumber = {i} AS INTEGER)) AS BIGINT) AS n_{5 * i}" for i in range(2, 8))
    + " FROM lineitem GROUP BY 1",
    "sparse_dummies": """SELECT COUNT(*) AS rows, CAST(COUNT(*) AS DOUBLE) AS ones,
        CAST(COUNT(DISTINCT l_partkey) AS INTEGER) AS slots FROM lineitem""",
    "date_features": f"""WITH {TYPED_SQL}
        SELECT event_id, round(coalesce(hour(date), -1)::DOUBLE, 5) AS date_hour,
          round(coalesce(isodow(date) - 1, -1)::DOUBLE, 5) AS date_dayofweek,
          round(coalesce(month(date), -1)::DOUBLE, 5) AS date_month,
          round(coalesce(dayofyear(date), -1)::DOUBLE, 5) AS date_dayofyear,
          round(coalesce(sin(2 * pi() * hour(date) / 24), 0)::FLOAT::DOUBLE, 5) + 0 AS date_sin_hour,
          round(coalesce(cos(2 * pi() * hour(date) / 24), 0)::FLOAT::DOUBLE, 5) + 0 AS date_cos_hour
        FROM typed""",
    "batch_clip": f"""WITH {EVENTS_SQL}, {_PARTS_SQL},
        q AS (SELECT {", ".join(f"quantile_cont({c}, 0.05) AS {c}_lo, quantile_cont({c}, 0.95) AS {c}_hi" for c in DATES[:4])}
              FROM d)
        SELECT event_id, {", ".join(f"round(least(greatest({c}, {c}_lo), {c}_hi), 6) AS {c}" for c in DATES[:4])},
          round(ts_sin_hour, 6) + 0 AS ts_sin_hour, round(ts_cos_hour, 6) + 0 AS ts_cos_hour
        FROM d, q""",
    "ratio_features": f"""SELECT round(l_quantity, 4) AS l_quantity, round(l_discount, 4) AS l_discount,
          round(l_tax, 4) AS l_tax,
          {", ".join(f"round(coalesce({a} / nullif({b}, 0), 0), 4) AS {a}__div__{b}" for a, b in _PAIRS)}
        FROM lineitem""",
    "product_features": f"""SELECT round(l_quantity, 6) AS l_quantity, round(l_discount, 6) AS l_discount,
          round(l_tax, 6) AS l_tax, {", ".join(f"round({a} * {b}, 6) AS {a}__x__{b}" for a, b in _PAIRS)}
        FROM lineitem""",
    "clip_outliers": f"""WITH {EVENTS_SQL},
        b AS (SELECT quantile_cont(value, 0.01) AS vl, quantile_cont(value, 0.99) AS vh,
                quantile_cont(k, 0.01) AS kl, quantile_cont(k, 0.99) AS kh FROM e)
        SELECT event_id, round(least(greatest(value, vl), vh), 6) AS value,
          round(least(greatest(k, kl), kh), 6) AS k FROM e, b""",
    "median_impute": f"""WITH {TYPED_SQL}
        SELECT event_id, round(coalesce(usage_value, (SELECT median(usage_value) FROM typed)), 6)
          AS usage_value FROM typed""",
    "mode_impute": f"""WITH {TYPED_SQL}
        SELECT event_id, coalesce(event_type, (SELECT event_type FROM typed WHERE event_type IS NOT NULL
          GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)) AS event_type FROM typed""",
    "one_hot": """SELECT event_id, """
    + ", ".join(
        f"CAST(event_type = '{v}' AND event_id % 9 <> 0 AS INTEGER)::DOUBLE AS h{i}"
        for i, v in enumerate(("click", "error", "purchase", "signup", "view"))
    )
    + " FROM events",
    "dummies": """SELECT l_quantity, CAST(l_returnflag = 'N' AS INTEGER) AS "l_returnflag_N",
          CAST(l_returnflag = 'R' AS INTEGER) AS "l_returnflag_R",
          CAST(l_linestatus = 'O' AS INTEGER) AS "l_linestatus_O" FROM lineitem""",
    "time_columns": """SELECT o_orderkey, CAST(hour(o_orderdate) AS INTEGER) AS hour,
          CAST(isodow(o_orderdate) - 1 AS INTEGER) AS dayofweek_num,
          CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""",
    "standardize": f"""WITH {EVENTS_SQL},
        s AS (SELECT AVG(value) AS mv, stddev_pop(value) AS sv, AVG(k) AS mk, stddev_pop(k) AS sk FROM e)
        SELECT event_id, round((value - mv) / sv, 6) AS value, round((k - mk) / sk, 6) AS k FROM e, s""",
    "feature_frame": f"""WITH {EVENTS_SQL}
        SELECT event_type, k, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, value FROM e""",
    "feature_pipeline": f"""WITH {EVENTS_SQL}, {_PARTS_SQL}, {_CLIP_SQL}
        SELECT event_id, {", ".join(f"round({c}, 5) + 0 AS {c}" for c in [*_CLIPPED, "user_id__div__k"])}
        FROM f""",
    "feature_matrix": f"""WITH {EVENTS_SQL}, {_PARTS_SQL}, {_CLIP_SQL},
        s AS (SELECT {", ".join(f"AVG({c}) AS {c}_m, coalesce(nullif(stddev_pop({c}), 0), 1) AS {c}_s" for c in _SCALED)}
              FROM f)
        SELECT event_id, """
    + ", ".join(
        f"CAST(event_type = '{v}' AS INTEGER)::DOUBLE AS x{i}"
        for i, v in enumerate(("click", "error", "purchase", "signup", "view"))
    )
    + ", "
    + ", ".join(f"round(({c} - {c}_m) / {c}_s, 4) + 0 AS x{5 + i}" for i, c in enumerate(_SCALED))
    + " FROM f, s",
    "engineered_split": f"""SELECT event_id, user_id, value,
          CASE WHEN {IS_TEST_SQL} THEN 'test' ELSE 'train' END AS part FROM events""",
}
