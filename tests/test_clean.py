from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import column
from tidegauge.functions import names as N
from tidegauge.functions.values import safe_ratio, to_number
from tidegauge.operators import clean as C
from tidegauge.plans.cleaning import clean, prepare_table, preprocess
from tidegauge.roles import ENERGY_ROLES, Roles
from tidegauge.sources.tables import (
    append_metrics,
    feature_table,
    metric_rows,
    read_table,
    text_schema,
    write_table,
)


@pytest.fixture()
def raw(spark):
    rows = [
        ("2024-01-01 05:00:00", 1.0, 0.1, 0.9, 0.1, 100, "Weekday", "Monday", "heavy", 10.0),
        ("not-a-date", 2.0, 0.2, 0.8, 0.2, 200, "Weekday", "Tuesday", "heavy", 15.0),
        ("2024-02-15 18:30:00", 3.0, 0.3, 0.95, 0.05, 300, "Weekend", "Sunday", "light", 30.0),
    ]
    names = [
        "date",
        "lagging_current_reactive.power_kvarh",
        "leading_current_reactive_power_kvarh",
        "lagging_current_power_factor",
        "leading_current_power_factor",
        "nsm",
        "weekstatus",
        "day_of_week",
        "load_type",
        "usage_kwh",
    ]
    return spark.createDataFrame(rows, names)


ROLES = ENERGY_ROLES.without("co2(tco2)")


def test_preprocess_drops_bad_dates_and_adds_columns(raw):
    df = preprocess(raw, ROLES)
    rows = df.collect()
    assert [r["hour"] for r in rows] == [5, 18]
    assert [r["dayofweek_num"] for r in rows] == [0, 3]
    assert [r["month"] for r in rows] == [1, 2]
    assert {"weekstatus_Weekend", "day_of_week_Sunday", "load_type_light"} <= set(df.columns)
    assert "weekstatus_Weekday" not in df.columns


def test_prepare_table_round_trip(spark, raw, tmp_path):
    source = str(tmp_path / "raw")
    write_table(raw, source, "csv")
    stored = prepare_table(spark, source, str(tmp_path / "out"), ROLES)
    assert stored.count() == 2
    assert stored.agg(F.sum("usage_kwh")).first()[0] == 40.0


def test_missing_file_and_column(spark, raw, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "absent"))
    write_table(raw.drop("weekstatus"), str(tmp_path / "t"))
    with pytest.raises(ValueError, match="weekstatus"):
        read_table(spark, str(tmp_path / "t"), required=["date", "weekstatus"])


def test_partitioned_write_keeps_all_rows(spark, tmp_path):
    df = spark.range(1000).withColumn("day", F.when(F.col("id") < 700, "a").otherwise("b"))
    write_table(df, str(tmp_path / "p"), partition_by=["day"], sort_by=["id"])
    back = read_table(spark, str(tmp_path / "p"))
    assert back.count() == 1000
    assert back.filter("day = 'a'").count() == 700


def test_text_schema_reads_everything_as_text(spark, tmp_path):
    write_table(spark.createDataFrame([("1", "x")], ["a", "b"]), str(tmp_path / "c"), "csv")
    df = read_table(spark, str(tmp_path / "c"), "csv", text_schema(["a", "b"]))
    assert [t for _, t in df.dtypes] == ["string", "string"]


def test_metrics_table_appends(spark, tmp_path):
    rows = metric_rows(spark, "r1", "line", {"test": {"rmse": 1.0, "mae": 0.5}})
    append_metrics(rows, str(tmp_path / "m"))
    append_metrics(rows, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 4


def test_feature_table(spark):
    df = spark.createDataFrame(
        [(1, 10, "0.5", "x"), (2, 20, "bad", "y"), (3, 30, None, "z")], "f1 long, f2 long, t string, s string"
    )
    kept = feature_table(df, "t")
    assert kept.columns == ["f1", "f2", "t"]
    assert kept.count() == 1
    with pytest.raises(ValueError):
        feature_table(df.select("s", "t"), "t")


@pytest.mark.parametrize(
    "text,value",
    [
        (" 12.5 ", 12.5),
        ("1e3", 1000.0),
        (".5", 0.5),
        ("5.", 5.0),
        ("-7", -7.0),
        ("5d", None),
        ("1_000", None),
        ("n/a", None),
        ("", None),
        ("NaN", None),
        ("0x10", None),
        (None, None),
    ],
)
def test_to_number(spark, text, value):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(to_number(F.col("x"))).first()[0] == value


def test_normalize_text(spark):
    df = spark.createDataFrame([("  heavy   LOAD ",), ("NaN",), ("none",), ("",), (None,)], "t string")
    assert column(C.normalize_text(df, ["t", "absent"]), "t") == ["Heavy load", None, None, None, None]


def test_coerce_timestamp_formats(spark):
    df = spark.createDataFrame([("13/01/2018 00:15",), ("2018-01-13 00:15:00",), ("soon",)], "date string")
    found = column(C.coerce_timestamp(df), "date")
    assert found[0] == found[1] and found[2] is None


def test_duplicates_treat_missing_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert C.drop_duplicates(df).count() == 2
    assert C.duplicate_count(df).first()[0] == 1
    assert C.duplicate_count(df.limit(0)).first()[0] == 0


def test_clean_deduplicates_before_the_casts(spark):
    df = spark.createDataFrame([("1",), ("1",), ("1.0",)], ["Usage kWh"])
    roles = Roles(target="usage_kwh", numeric=())
    assert column(clean(df, roles), "usage_kwh") == [1.0, 1.0]


def test_drop_missing_modes(spark):
    df = spark.createDataFrame(
        [(1.0, "a"), (None, "b"), (None, None), (float("nan"), "c")], "x double, y string"
    )
    assert C.drop_missing(df, "any").count() == 1
    assert C.drop_missing(df, "all").count() == 3
    assert C.drop_missing(df, subset=["y"]).count() == 3


def test_threshold(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    assert C.threshold(df, "x").count() == 4
    assert column(C.threshold(df, "x", 1, 3), "x") == [1.0, 2.0, 3.0]
    assert column(C.threshold(df, "x", 1, 3, inclusive=False), "x") == [2.0]


def test_quantile_filter_skips_narrow_columns(spark):
    df = spark.range(1000).select(
        F.col("id").cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("y")
    )
    kept = C.quantile_filter(df, ["x", "y"], 0.01, 0.99)
    assert kept.count() == 980
    assert kept.select("y").distinct().count() == 3


def chained_rows(rows, lower, upper, min_distinct):
    """Brute force: indices of the rows that stay, column after column."""
    left = list(range(len(rows)))
    for c in range(len(rows[0])):
        values = sorted(rows[i][c] for i in left if rows[i][c] is not None and rows[i][c] == rows[i][c])
        if len(set(values)) <= min_distinct:
            continue
        ends = []
        for q in (lower, upper):
            place = (len(values) - 1) * q
            low, high = values[int(place)], values[min(int(place) + 1, len(values) - 1)]
            ends.append(low + (high - low) * (place - int(place)))
        left = [i for i in left if rows[i][c] is not None and ends[0] <= rows[i][c] <= ends[1]]
    return left


@pytest.mark.parametrize("limit", [100_000, 300, 0])
def test_quantile_filter_follows_the_chain(spark, monkeypatch, limit):
    """Wide, tied, narrow, correlated, null and NaN columns; joint counts, a part of them, none."""
    monkeypatch.setattr("tidegauge.operators.chained.DRIVER_ROWS", limit)
    rng = random.Random(5)
    rows = []
    for i in range(4000):
        a = rng.gauss(0, 1)
        b = None if i % 50 == 0 else float("nan") if i % 50 == 1 else a * 3 + rng.random()
        rows.append((a, b, float(rng.randrange(25)), float(i % 4), float("inf") if i % 900 == 7 else rng.expovariate(1), None))
    schema = "a double, b double, c double, d double, e double, f double, i int"
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema).repartition(4)
    kept = C.quantile_filter(df, ["a", "b", "c", "d", "e", "f"], 0.02, 0.97)
    assert sorted(column(kept, "i")) == chained_rows(rows, 0.02, 0.97, 10)


def test_quantile_filter_of_no_rows(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert C.quantile_filter(df, ["a", "b"]).count() == 0


def test_fill_mean_and_strip_thousands(spark):
    df = spark.createDataFrame([("1,000.5", "1"), ("2", "x"), (None, "3")], "n string, m string")
    made = C.strip_thousands(df)
    assert made.dtypes == [("n", "double"), ("m", "string")]
    assert column(C.fill_mean(made, ["n"]), "n") == [1000.5, 2.0, 501.25]


def test_select_columns_guards_the_target(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["f1", "target", "gone"])
    assert C.select_columns(df, ["f1"], "target", ["gone"]).columns == ["f1", "target"]
    with pytest.raises(ValueError):
        C.select_columns(df, ["f1"], "target", ["target"])


def test_hash_sample_is_stable(spark):
    df = spark.range(500)
    first = sorted(column(C.hash_sample(df, "id", 20), "id"))
    assert first == sorted(column(C.hash_sample(df.repartition(9), "id", 20), "id"))
    assert len(first) == 20


def test_update_where_keeps_rows_with_unknown_condition(spark):
    df = spark.createDataFrame([(1, 10), (None, 20), (3, 30)], "a int, b int")
    assert column(C.update_where(df, F.col("a") > 2, {"b": F.lit(0)}), "b") == [10, 20, 0]


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" Usage kWh ", "Lagging.Power (kVarh)", "Date"])
    assert N.normalize_headers(df).columns == ["usage_kwh", "lagging.power_(kvarh)", "date"]
    assert N.safe_names(df).columns == ["usage_kwh", "lagging_power_kvarh", "date"]
    assert N.safe_names(df, lower=False).columns == ["Usage_kWh", "Lagging_Power_kVarh", "Date"]
    assert N.resolve(N.normalize_headers(df), ["USAGE.KWH"]) == "usage_kwh"
    assert N.find_target(N.normalize_headers(df)) == "usage_kwh"
    assert N.find_target(df) == " Usage kWh "
    assert N.first_time_column(df) == "Date"
    with pytest.raises(KeyError):
        N.resolve(df, ["other"])
    with pytest.raises(ValueError):
        N.safe_names(spark.createDataFrame([(1, 2)], ["a.b", "a_b"]))


def test_classify(readings):
    numeric, text = N.classify(readings, ["usage_kwh", "date"])
    assert len(numeric) == 6 and text == ["weekstatus", "day_of_week", "load_type"]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 4.0), (None, 1.0), (1e308, 1e-308)], "a double, b double")
    assert [r[0] for r in df.select(safe_ratio(F.col("a"), F.col("b"))).collect()] == [0.0, 0.5, 0.0, 0.0]


def test_threshold_drops_nan_with_either_bound(spark):
    df = spark.createDataFrame([(1.0,), (7.0,), (float("nan"),), (None,)], "x double")
    assert column(C.threshold(df, "x", lower=5), "x") == [7.0]
    assert column(C.threshold(df, "x", upper=5), "x") == [1.0]


def test_times_do_not_depend_on_the_zone(spark):
    from tidegauge.functions.values import to_time
    from tidegauge.operators.order_stats import with_rank

    df = spark.createDataFrame([("2018-03-11 02:15:00",), ("2018-03-11 03:15:00",), ("11/03/2018 02:15",), ("2018-13-01",), ("2018-03-11",)], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = [str(v) if v else None for v in column(df.select(to_time(F.col("t")).alias("v")), "v")]
        hours = spark.createDataFrame([("2018-11-04 01:30:00",), ("2018-11-04 02:30:00",), ("2018-03-11 02:30:00",), ("2018-03-11 03:30:00",)], "t string")
        ranks = with_rank(hours.select(to_time(F.col("t")).alias("v")), "v").orderBy("v").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == ["2018-03-11 02:15:00", "2018-03-11 03:15:00", "2018-03-11 02:15:00", None, "2018-03-11 00:00:00"]
    assert [r["rank"] for r in ranks] == [0, 1, 2, 3]


def test_matching_names_is_never_ambiguous(spark):
    with pytest.raises(ValueError, match="equally"):
        N.best_match(["Usage_kWh", "usage kwh"], ["usage_kwh"])
    assert N.best_match(["Usage_kWh", "usage_kwh"], ["usage_kwh"]) == "usage_kwh"
    assert N.best_match(["b", "a"], ["a", "b"]) == "a"
    assert N.best_match(["total usage in kwh", "x"], ["target"], ("usage", "kwh")) == "total usage in kwh"
