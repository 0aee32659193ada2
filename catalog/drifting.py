"""Drift, monitoring, scenario and stream queries."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from catalog.inputs import EVENTS_SQL, HALF, SHIP_SPLIT, events, round_all, table
from tidegauge.functions.names import find_target, first_time_column
from tidegauge.operators import drift as D
from tidegauge.operators import scenario as S
from tidegauge.operators.order_stats import with_rank
from tidegauge.operators.profile import histogram
from tidegauge.operators.quality import degradation, performance
from tidegauge.operators.reference import History, keep_reference, ks_against, stored_reference
from tidegauge.plans.monitoring import Monitor
from tidegauge.plans.scenarios import scenario_power_factor, scenario_totals, what_if
from tidegauge.session import shared_folder
from tidegauge.streaming.ledger import Rollup, WindowMonitor
from tidegauge.streaming.live import monitor_stream, stream_rollup

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TEXTS = ["l_returnflag", "l_linestatus"]


def _shipped(spark, folder):
    df = table(spark, folder, "lineitem")
    return df.filter(f"l_shipdate < '{SHIP_SPLIT}'"), df.filter(f"l_shipdate >= '{SHIP_SPLIT}'")


def _months(spark, folder):
    df = events(spark, folder)
    return df.filter(f"ts < '{HALF}'"), df.filter(f"ts >= '{HALF}'")


def ks_drift(spark, folder):
    return round_all(D.ks(*_shipped(spark, folder), NUMBERS))


def chi_squared_drift(spark, folder):
    return round_all(D.chi_squared(*_shipped(spark, folder), TEXTS))


def drift_summary(spark, folder):
    rows = D.column_drift(*_shipped(spark, folder), NUMBERS, TEXTS)
    return round_all(D.drift_summary(rows))


def drift_history(spark, folder):
    before, after = _months(spark, folder)
    week = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd")
    return round_all(D.drift_history(before, after, week, ["value", "k"], ["event_type"]))


def ks_against_stored(spark, folder):
    """The later rows against the stored distribution of the earlier ones."""
    before, after = _shipped(spark, folder)
    path = f"{shared_folder(spark)}/reference-{uuid4().hex}"
    keep_reference(before, path, NUMBERS)
    return round_all(ks_against(stored_reference(spark, path), after))


def drift_history_grown(spark, folder):
    """Weekly history that grows by two increments; the cut lies inside a week."""
    before, after = _months(spark, folder)
    week = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd")
    path = f"{shared_folder(spark)}/history-{uuid4().hex}"
    history = History(keep_reference(before, f"{path}/reference", ["value", "k"], ["event_type"]), path)
    cut = F.dayofyear("ts") % 5 < 2
    history.add(after.filter(cut), week, "first")
    history.add(after.filter(~cut), week, "second")
    return round_all(history.summary())


def ks_history(spark, folder):
    """KS per event type of the current half against the whole reference half."""
    before, after = _months(spark, folder)
    return round_all(D.ks(before, after, ["value", "k"], by=["event_type"]))


def stability(spark, folder):
    return round_all(D.psi(*_months(spark, folder), ["value", "k"]))


def stability_history(spark, folder):
    before, after = _months(spark, folder)
    return round_all(D.psi(before, after, ["value", "k"], by=["event_type"]))


def _predicted(df):
    return df.withColumn("prediction", F.col("value") * 0.9 + F.col("k") * 0.05)


def performance_report(spark, folder):
    return round_all(performance(_predicted(events(spark, folder)), "value", by=["event_type"]), 5)


def quality_change(spark, folder):
    before, after = _months(spark, folder)
    worse = S.shift_scale(after, {"k": (1.5, 0.0)})
    return round_all(
        degradation({"baseline": _predicted(before), "monitored": _predicted(worse)}, "value"), 5
    )


def before_after(spark, folder):
    before, after = _months(spark, folder)
    both = before.withColumn("side", F.lit("before")).unionByName(
        S.shift_scale(after, {"value": (1.5, 0.0)}).withColumn("side", F.lit("after"))
    )
    return round_all(histogram(both, "value", 40, ["side"]))


def full_report(spark, folder):
    """Drift, summary and quality of one current table, in long form."""
    before, after = _months(spark, folder)
    monitor = Monitor.of(
        before.select("event_id", "value", "k", "event_type", "ts"),
        "value",
        time="ts",
        numeric=["k"],
        categorical=["event_type"],
    )
    return round_all(monitor.full_report(_predicted(after)), 5)


def _line(df):
    """A fixed predictor, so that the scenario's arithmetic can be checked."""
    return df.withColumn("prediction", F.col("value") * 0.8 + F.col("k") * 0.1 + 2.0)


def _scenario(spark, folder):
    df = events(spark, folder)
    updates = {"value": F.col("value") + 175.0, "k": F.col("k") + 149.15}
    return df, what_if(df, F.weekday("ts") < 5, updates, _line, "value")


def what_if_totals(spark, folder):
    return round_all(scenario_totals(_scenario(spark, folder)[1]), 3)


def what_if_power_factor(spark, folder):
    before, after = _scenario(spark, folder)
    df = scenario_power_factor(before, after, "ts", "value", "k", "user_id")
    return round_all(df.withColumn("date", F.date_format("date", "yyyy-MM-dd")))


def shift_scale(spark, folder):
    df = events(spark, folder).select("event_id", "value", "k")
    return round_all(S.shift_scale(df, {"value": (1.5, 0.0), "k": (1.0, -3.5)}))


def masked(spark, folder):
    df = events(spark, folder).select("event_id", "value", "k")
    return S.mask_share(df, "k", "event_id", 0.15, seed=7)


def _partial(spark, folder):
    """Both halves with columns that miss values, are constant, or lie far away, by a rule."""
    before, after = _months(spark, folder)
    one = F.lit(3.0)
    return (
        before.select("k", "event_type", F.lit(None).cast("double").alias("late"), F.col("value").alias("gone"), one.alias("still"),
                      F.col("value").alias("far"), F.lit(None).cast("string").alias("label")),
        after.select("k", "event_type", F.col("value").alias("late"), F.lit(None).cast("double").alias("gone"), (one * 3).alias("still"),
                     (F.col("value") + 1e6).alias("far"), F.col("event_type").alias("label")),
    )


def psi_shifted(spark, folder):
    """One column wholly out of range, one constant that moved, one side without values."""
    return round_all(D.psi(*_partial(spark, folder), ["k", "far", "still", "late", "gone"]))


def ks_empty_sides(spark, folder):
    return round_all(D.ks(*_partial(spark, folder), ["k", "late", "gone"]))


def drift_summary_incomplete(spark, folder):
    rows = D.column_drift(*_partial(spark, folder), ["k", "late", "gone", "still"], ["event_type", "label"])
    return round_all(D.drift_summary(rows))


def watched_by_type(spark, folder):
    """What a monitor watches when no columns are named, and how many values it finds there."""
    df = events(spark, folder).withColumnsRenamed({"value": "Usage kWh", "ts": "reading_time"})
    df = df.withColumn("k", F.when(F.col("event_id") % 7 != 0, F.col("k")))
    target, time = find_target(df), first_time_column(df)
    monitor = Monitor.of(df, target, time=time)
    roles = [("target", [target]), ("time", [time]), ("numeric", monitor.numeric), ("categorical", monitor.categorical)]
    own = [(c, kind) for kind, columns in roles for c in columns]
    counts = df.agg(*[F.count(f"`{c}`").alias(f"n{i}") for i, (c, _) in enumerate(own)])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.col(f"n{i}").alias("filled")) for i, (c, kind) in enumerate(own)]
    return counts.select(F.inline(F.array(*rows)))


def inferred_report(spark, folder):
    """A monitor that finds its columns by type, on both halves."""
    before, after = (df.drop("event_id") for df in _months(spark, folder))
    return round_all(Monitor.of(before, "value", time="ts").columns(after).select("column", "test", "n_reference", "n_current", "status"))


def rank_by_time(spark, folder):
    """Position of every event by its time; equal times share the first."""
    df = events(spark, folder).select("event_id", "ts")
    return with_rank(df, "ts", "place").select("event_id", "place", "place_rows")


def _stream(spark, folder):
    # The file source takes a folder or a pattern; this pattern names the one table.
    schema = table(spark, folder, "events").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/event[s].parquet")


def stream_hours(spark, folder):
    """Closed hourly windows of the event stream, through a file sink."""
    path = f"{shared_folder(spark)}/stream-{uuid4().hex}"
    rolled = stream_rollup(_stream(spark, folder), "ts", sums=["value"], maxes=["user_id"])
    query = (
        rolled.writeStream.format("parquet")
        .option("path", f"{path}/rows")
        .option("checkpointLocation", f"{path}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    stored = spark.read.schema(rolled.schema).parquet(f"{path}/rows")
    return round_all(
        stored.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))
    )


def stream_monitor(spark, folder):
    """Stability of each micro-batch of the event stream against a stored profile."""
    path = f"{shared_folder(spark)}/stream-{uuid4().hex}"
    before, _ = _months(spark, folder)
    profile = D.Profile.from_dict(D.build_profile(before, ["value"]).as_dict())
    query = (
        monitor_stream(_stream(spark, folder).filter(f"ts >= '{HALF}'"), profile, f"{path}/rows")
        .option("checkpointLocation", f"{path}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return round_all(spark.read.parquet(f"{path}/rows").drop("batch_id"))


def _in_pieces(spark, df, pieces, taker, path):
    """Run ``taker`` over ``df`` as a stream whose micro-batches are the ``pieces`` in turn."""
    for i, piece in enumerate(pieces):
        df.filter(piece).write.mode("append").parquet(f"{path}/inbox")
        stream = spark.readStream.schema(df.schema).parquet(f"{path}/inbox")
        query = taker.start(stream).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
        query.awaitTermination()


def stream_rollup_accounted(spark, folder):
    """Hourly windows of events that come in two pieces, and the rows of the second that are late."""
    path = f"{shared_folder(spark)}/stream-{uuid4().hex}"
    hours = Rollup.of(path, "ts", sums=["total"], means=["mean"], maxes=["user_id"])
    second = F.col("event_id") % 3 == 0
    df = table(spark, folder, "events").select("event_id", "ts", "user_id", F.col("value").alias("total"), F.col("value").alias("mean"))
    _in_pieces(spark, df, [~second, second], hours.ledger, path)
    found = hours.windows(spark, flush=True).join(hours.ledger.late(spark), "window_start", "full")
    none = F.lit(0).cast("bigint")
    found = found.withColumns({"n": F.coalesce("n", none), "n_late": F.coalesce("n_late", none)})
    return round_all(found.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")))


def stream_drift_by_day(spark, folder):
    """Stability of every day of the later half; the days arrive in five mixed pieces."""
    path = f"{shared_folder(spark)}/stream-{uuid4().hex}"
    before, after = _months(spark, folder)
    days = WindowMonitor.of(path, D.build_profile(before, ["value", "k"]), "ts", window="1 day", lateness="400 days")
    _in_pieces(spark, after.select("event_id", "ts", "value", "k"), [F.col("event_id") % 5 == i for i in range(5)], days.ledger, path)
    found = days.verdicts(spark, flush=True).withColumn("period", F.date_format("window_start", "yyyy-MM-dd"))
    return round_all(found.select("period", "column", "psi", "n_reference", "n_current", "n_outside", "drifted", "share", "tier"))


QUERIES = {
    "stream_rollup_accounted": stream_rollup_accounted,
    "stream_drift_by_day": stream_drift_by_day,
    "drift_summary": drift_summary,
    "ks_drift": ks_drift,
    "chi2_drift": chi_squared_drift,
    "drift_history": drift_history,
    "ks_against_stored": ks_against_stored,
    "drift_history_grown": drift_history_grown,
    "ks_by_group": ks_history,
    "psi": stability,
    "psi_by_group": stability_history,
    "performance_report": performance_report,
    "degradation": quality_change,
    "before_after_hist": before_after,
    "comprehensive_report": full_report,
    "what_if_totals": what_if_totals,
    "what_if_power_factor": what_if_power_factor,
    "shift_scale": shift_scale,
    "mask_share": masked,
    "psi_shifted": psi_shifted,
    "ks_empty_sides": ks_empty_sides,
    "drift_summary_incomplete": drift_summary_incomplete,
    "watched_by_type": watched_by_type,
    "inferred_report": inferred_report,
    "rank_by_time": rank_by_time,
    "stream_rollup": stream_hours,
    "stream_monitor": stream_monitor,
}


def _ks_sql(source: str, names: list[str], is_current: str, by: str = "") -> str:
    """Sorted distinct values, running counts, largest gap, Kolmogorov series."""
    parts = []
    for c in names:
        if by:
            rows = f"""SELECT g.{by}, {c} AS v, FALSE AS cur FROM {source}
                CROSS JOIN (SELECT DISTINCT {by} FROM {source} WHERE {is_current}) g
                WHERE NOT ({is_current})
                UNION ALL SELECT {by}, {c}, TRUE FROM {source} WHERE {is_current}"""
            rows = rows.replace(f"SELECT g.{by}, {c} AS v", f"SELECT g.{by} AS {by}, {source}.{c} AS v")
        else:
            rows = f"SELECT {c} AS v, {is_current} AS cur FROM {source}"
        key, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
        group = f"GROUP BY {by}" if by else ""
        parts.append(
            f"""SELECT {key}'{c}' AS "column", MAX(abs(r / nr - c / nc)) AS d, MAX(nr) AS nr, MAX(nc) AS nc
            FROM (SELECT {key}SUM(a) OVER ({part}ORDER BY v) AS r, SUM(b) OVER ({part}ORDER BY v) AS c,
                    CAST(SUM(a) OVER ({part or ""}) AS DOUBLE) AS nr, CAST(SUM(b) OVER ({part or ""}) AS DOUBLE) AS nc
                  FROM (SELECT {key}v, COUNT(*) FILTER (NOT cur) AS a, COUNT(*) FILTER (cur) AS b
                        FROM ({rows}) GROUP BY {key}v)) {group}"""
        )
    return " UNION ALL ".join(parts)


_P_KS = """CASE WHEN x < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * list_sum(
  [(CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * j * j * x * x) for j in range(1, 101)]))) END"""


def _ks_rows_sql(source: str, names: list[str], is_current: str, by: str = "") -> str:
    key = f"{by}, " if by else ""
    return f"""SELECT {key}"column", 'ks' AS test, d AS statistic, {_P_KS} AS p_value,
          CAST(nr AS BIGINT) AS n_reference, CAST(nc AS BIGINT) AS n_current
        FROM (SELECT *, d * sqrt(nr * nc / (nr + nc)) AS x
              FROM ({_ks_sql(source, names, is_current, by)}))"""


# 1 - P(f/2, s/2), the series of the lower incomplete gamma function in logs.
_P_CHI = """1 - list_sum([exp((f / 2.0 + i) * ln(s / 2.0) - s / 2.0 - lgamma(f / 2.0 + i + 1))
  for i in range(0, 400)])"""


def _chi_rows_sql(source: str, names: list[str], is_current: str, by: str = "") -> str:
    parts = []
    for c in names:
        if by:
            rows = f"""SELECT g.{by} AS {by}, {source}.{c} AS v, FALSE AS cur FROM {source}
                CROSS JOIN (SELECT DISTINCT {by} FROM {source} WHERE {is_current}) g
                WHERE NOT ({is_current})
                UNION ALL SELECT {by}, {c}, TRUE FROM {source} WHERE {is_current}"""
        else:
            rows = f"SELECT {c} AS v, {is_current} AS cur FROM {source}"
        key, part = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
        parts.append(
            f"""SELECT {key}'{c}' AS "column", SUM((a - ea) ** 2 / ea + (b - eb) ** 2 / eb) AS s,
              COUNT(*) - 1 AS f, MAX(na) AS na, MAX(nb) AS nb
            FROM (SELECT *, (a + b) * na / (na + nb) AS ea, (a + b) * nb / (na + nb) AS eb
              FROM (SELECT *, SUM(a) OVER ({part}) AS na, SUM(b) OVER ({part}) AS nb
                FROM (SELECT {key}v, COUNT(*) FILTER (NOT cur) AS a, COUNT(*) FILTER (cur) AS b
                      FROM ({rows}) GROUP BY {key}v))) {f"GROUP BY {by}" if by else ""}"""
        )
    key = f"{by}, " if by else ""
    return f"""SELECT {key}"column", 'chi2' AS test, s AS statistic, {_P_CHI} AS p_value,
          CAST(na AS BIGINT) AS n_reference, CAST(nb AS BIGINT) AS n_current
        FROM ({" UNION ALL ".join(parts)})"""


_SHIPPED = f"l_shipdate >= DATE '{SHIP_SPLIT}'"
_LATER = f"ts >= TIMESTAMP '{HALF}'"
_ROUNDED = """"column", test, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value,
  n_reference, n_current"""


def _summary_sql(rows: str, key: str = "") -> str:
    group = f"GROUP BY {key.rstrip(', ')}" if key else ""
    return f"""SELECT {key}bad > 0 AS dataset_drift_detected, bad AS number_of_drifted_columns,
          n AS number_of_columns, round(bad / n, 6) AS share_of_drifted_columns,
          CASE WHEN bad / n > 0.3 THEN 'critical' WHEN bad / n > 0.15 THEN 'warning' ELSE 'ok' END AS tier
        FROM (SELECT {key}COUNT(*) FILTER (p_value < 0.05) AS bad, COUNT(*) AS n FROM ({rows}) {group})"""


def _psi_sql(names: list[str], by: str = "") -> str:
    """Deciles of the reference, distinct edges, counts on both sides per bucket."""
    parts = []
    for c in names:
        key = f"{by}, " if by else ""
        parts.append(
            f"""SELECT {key}'{c}' AS "column", round(SUM((x - y) * ln(x / y)), 6) AS psi,
              CAST(MAX(nr) AS BIGINT) AS n_reference, CAST(MAX(nc) AS BIGINT) AS n_current,
              CAST(MAX(total) - MAX(nc) AS BIGINT) AS n_outside
            FROM (SELECT {key}nr, nc, total, (CASE WHEN a = 0 THEN 1e-6 ELSE a END) / nr AS x,
                    (CASE WHEN c = 0 THEN 1e-6 ELSE c END) / nc AS y
              FROM (SELECT *, SUM(a) OVER ({f"PARTITION BY {by}" if by else ""}) AS nr,
                      SUM(c) OVER ({f"PARTITION BY {by}" if by else ""}) AS nc
                FROM (SELECT {"g." + by + ", " if by else ""}lo,
                        (SELECT COUNT(*) FROM e WHERE NOT ({_LATER}) AND {c} >= lo
                           AND ({c} < hi OR (last AND {c} <= hi))) AS a,
                        (SELECT COUNT(*) FROM e WHERE {_LATER} {f"AND e.{by} = g.{by}" if by else ""}
                           AND {c} >= lo AND ({c} < hi OR (last AND {c} <= hi))) AS c,
                        (SELECT COUNT({c}) FROM e WHERE {_LATER} {f"AND e.{by} = g.{by}" if by else ""}) AS total
                      FROM (SELECT lo, lead(lo) OVER (ORDER BY lo) AS hi,
                              lead(lo, 2) OVER (ORDER BY lo) IS NULL AS last
                            FROM (SELECT DISTINCT unnest(quantile_cont({c},
                                    [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS lo
                                  FROM e WHERE NOT ({_LATER})))
                      {f"CROSS JOIN (SELECT DISTINCT {by} FROM e WHERE {_LATER}) g" if by else ""}
                      WHERE hi IS NOT NULL))) {f"GROUP BY {by}" if by else ""}"""
        )
    return f"WITH {EVENTS_SQL} " + " UNION ALL ".join(parts)


_QUALITY = """COUNT(*) AS n, round(sqrt(AVG((value - p) ** 2)), 5) AS rmse,
  round(AVG(abs(value - p)), 5) AS mae,
  round(1 - SUM((value - p) ** 2) / (var_pop(value) * COUNT(*)), 5) AS r2,
  round(100 * AVG(abs((value - p) / nullif(value, 0))), 5) AS mape"""

_REPORT = f"""WITH {EVENTS_SQL},
rows AS ({_ks_rows_sql("e", ["k"], _LATER)} UNION ALL {_chi_rows_sql("e", ["event_type"], _LATER)}),
total AS ({_summary_sql("SELECT * FROM rows")}),
quality AS (SELECT {_QUALITY} FROM (SELECT value, value * 0.9 + k * 0.05 AS p FROM e WHERE {_LATER}))
SELECT 'drift' AS section, "column" AS item, 'statistic' AS metric, round(statistic, 5) AS value FROM rows
UNION ALL SELECT 'drift', "column", 'p_value', round(p_value, 5) FROM rows
UNION ALL SELECT 'drift', "column", 'drifted', (p_value < 0.05)::INTEGER::DOUBLE FROM rows
UNION ALL SELECT 'summary', 'dataset', 'dataset_drift_detected', dataset_drift_detected::INTEGER::DOUBLE FROM total
UNION ALL SELECT 'summary', 'dataset', 'number_of_drifted_columns', number_of_drifted_columns::DOUBLE FROM total
UNION ALL SELECT 'summary', 'dataset', 'share_of_drifted_columns', round(share_of_drifted_columns, 5) FROM total
UNION ALL SELECT 'performance', 'dataset', 'rmse', rmse FROM quality
UNION ALL SELECT 'performance', 'dataset', 'mae', mae FROM quality
UNION ALL SELECT 'performance', 'dataset', 'r2', r2 FROM quality
UNION ALL SELECT 'performance', 'dataset', 'mape', mape FROM quality"""

_SCENARIO = f"""{EVENTS_SQL},
s AS (SELECT ts, user_id, value AS baseline, k,
        CASE WHEN isodow(ts) < 6 THEN value + 175 ELSE value END AS v2,
        CASE WHEN isodow(ts) < 6 THEN k + 149.15 ELSE k END AS k2 FROM e),
t AS (SELECT *, v2 * 0.8 + k2 * 0.1 + 2.0 AS scenario FROM s)"""

SQL = {
    "ks_drift": f"SELECT {_ROUNDED} FROM ({_ks_rows_sql('lineitem', NUMBERS, _SHIPPED)})",
    "chi2_drift": f"SELECT {_ROUNDED} FROM ({_chi_rows_sql('lineitem', TEXTS, _SHIPPED)})",
    "drift_summary": _summary_sql(
        f"{_ks_rows_sql('lineitem', NUMBERS, _SHIPPED)} UNION ALL {_chi_rows_sql('lineitem', TEXTS, _SHIPPED)}"
    ),
    "drift_history": f"""WITH {EVENTS_SQL.replace("e AS (", "b AS (", 1)},
        e AS (SELECT *, strftime(date_trunc('week', ts), '%Y-%m-%d') AS period FROM b) """
    + _summary_sql(
        f"{_ks_rows_sql('e', ['value', 'k'], _LATER, 'period')} UNION ALL "
        f"{_chi_rows_sql('e', ['event_type'], _LATER, 'period')}",
        "period, ",
    ),
    "ks_by_group": f"""WITH {EVENTS_SQL} SELECT event_type, {_ROUNDED}
        FROM ({_ks_rows_sql('e', ['value', 'k'], _LATER, 'event_type')})""",
    "psi": _psi_sql(["value", "k"]),
    "psi_by_group": _psi_sql(["value", "k"], "event_type"),
    "performance_report": f"""WITH {EVENTS_SQL} SELECT event_type, {_QUALITY}
        FROM (SELECT event_type, value, value * 0.9 + k * 0.05 AS p FROM e) GROUP BY 1""",
    "degradation": f"""WITH {EVENTS_SQL} SELECT dataset, n, rmse, r2 FROM (SELECT dataset, {_QUALITY}
        FROM (SELECT CASE WHEN {_LATER} THEN 'monitored' ELSE 'baseline' END AS dataset, value,
                value * 0.9 + (CASE WHEN {_LATER} THEN k * 1.5 ELSE k END) * 0.05 AS p FROM e)
        GROUP BY 1)""",
    "before_after_hist": f"""WITH d AS (
          SELECT CASE WHEN {_LATER} THEN 'after' ELSE 'before' END AS side,
            CASE WHEN {_LATER} THEN value * 1.5 ELSE value END AS x FROM events),
        s AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM d),
        b AS (SELECT side, CAST(least(floor((x - lo) / ((hi - lo) / 40)) + 1, 40) AS INTEGER) AS bin,
                COUNT(*) AS n FROM d, s GROUP BY 1, 2)
        SELECT v.side, CAST(i AS INTEGER) AS bin, round(lo + (hi - lo) / 40 * (i - 1), 6) AS "from",
          round(lo + (hi - lo) / 40 * i, 6) AS "to", coalesce(n, 0) AS n
        FROM range(1, 41) AS r(i) CROSS JOIN (VALUES ('before'), ('after')) AS v(side) CROSS JOIN s
        LEFT JOIN b ON b.bin = i AND b.side = v.side""",
    "comprehensive_report": _REPORT,
    "what_if_totals": f"""WITH {_SCENARIO}
        SELECT round(b, 3) AS baseline_total, round(n, 3) AS scenario_total,
          round((n - b) / b * 100, 3) AS change_pct
        FROM (SELECT SUM(baseline) AS b, SUM(scenario) AS n FROM t)""",
    "what_if_power_factor": f"""WITH {_SCENARIO},
        g AS (SELECT strftime(ts, '%Y-%m-%d') AS date, SUM(baseline) AS p, SUM(k - user_id) AS q,
                SUM(scenario) AS p2, SUM(k2 - user_id) AS q2 FROM t GROUP BY 1)
        SELECT date, round(p / sqrt(p * p + q * q), 6) AS pf_baseline,
          round(p2 / sqrt(p2 * p2 + q2 * q2), 6) AS pf_scenario FROM g""",
    "shift_scale": f"""WITH {EVENTS_SQL} SELECT event_id, round(value * 1.5, 6) AS value,
        round(k - 3.5, 6) AS k FROM e""",
    "mask_share": f"""WITH {EVENTS_SQL} SELECT event_id, value,
        CASE WHEN ('0x' || substr(md5(CAST(event_id AS VARCHAR) || ':7'), 1, 8))::BIGINT >= 644245094
             THEN k END AS k FROM e""",
    "psi_shifted": f"""WITH {EVENTS_SQL}, k AS (SELECT psi, n_reference, n_current, n_outside FROM ({_psi_sql(["k"])})),
        n AS (SELECT COUNT(value) FILTER (NOT ({_LATER})) AS a, COUNT(value) FILTER ({_LATER}) AS b,
                COUNT(*) FILTER (NOT ({_LATER})) AS ra, COUNT(*) FILTER ({_LATER}) AS rb FROM e)
        SELECT 'k' AS "column", psi, n_reference, n_current, n_outside FROM k
        UNION ALL SELECT 'far', 'inf'::DOUBLE, a, 0, b FROM n
        UNION ALL SELECT 'still', 'inf'::DOUBLE, ra, 0, rb FROM n
        UNION ALL SELECT 'late', NULL, 0, 0, b FROM n
        UNION ALL SELECT 'gone', NULL, a, 0, 0 FROM n""",
    "ks_empty_sides": f"""WITH {EVENTS_SQL},
        n AS (SELECT COUNT(value) FILTER (NOT ({_LATER})) AS a, COUNT(value) FILTER ({_LATER}) AS b FROM e)
        SELECT {_ROUNDED} FROM ({_ks_rows_sql('e', ['k'], _LATER)})
        UNION ALL SELECT 'late', 'ks', NULL, NULL, 0, b FROM n
        UNION ALL SELECT 'gone', 'ks', NULL, NULL, a, 0 FROM n""",
    "drift_summary_incomplete": f"""WITH {EVENTS_SQL},
        rows AS (SELECT p_value FROM ({_ks_rows_sql('e', ['k'], _LATER)}) UNION ALL
          SELECT p_value FROM ({_chi_rows_sql('e', ['event_type'], _LATER)}) UNION ALL
          SELECT 0.0 FROM range(4))
        {_summary_sql("SELECT * FROM rows")}""",
    "watched_by_type": f"""WITH {EVENTS_SQL}, n AS (
          SELECT COUNT(value) AS v, COUNT(ts) AS t, COUNT(event_id) AS i, COUNT(user_id) AS u,
            COUNT(k) FILTER (event_id % 7 <> 0) AS k, COUNT(event_type) AS e, (SELECT COUNT(props) FROM events) AS p FROM e)
        SELECT 'Usage kWh' AS "column", 'target' AS kind, v AS filled FROM n
        UNION ALL SELECT 'reading_time', 'time', t FROM n
        UNION ALL SELECT 'event_id', 'numeric', i FROM n
        UNION ALL SELECT 'user_id', 'numeric', u FROM n
        UNION ALL SELECT 'k', 'numeric', k FROM n
        UNION ALL SELECT 'event_type', 'categorical', e FROM n
        UNION ALL SELECT 'props', 'categorical', p FROM n""",
    "inferred_report": f"""WITH {EVENTS_SQL}, n AS (SELECT COUNT(*) FILTER (NOT ({_LATER})) AS a, COUNT(*) FILTER ({_LATER}) AS b,
            COUNT(k) FILTER (NOT ({_LATER})) AS ka, COUNT(k) FILTER ({_LATER}) AS kb FROM e)
        SELECT 'user_id' AS "column", 'ks' AS test, a AS n_reference, b AS n_current, 'tested' AS status FROM n
        UNION ALL SELECT 'k', 'ks', ka, kb, 'tested' FROM n
        UNION ALL SELECT c, 'chi2', a, b, 'tested' FROM n, (VALUES ('event_type'), ('props')) AS v(c)""",
    "rank_by_time": """SELECT event_id, rank() OVER (ORDER BY ts) - 1 AS place, COUNT(*) OVER () AS place_rows
        FROM events""",
    "stream_rollup": """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
          COUNT(*) AS n, round(SUM(value), 6) AS value, CAST(MAX(user_id) AS DOUBLE) AS user_id
        FROM events
        WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) - INTERVAL 2 HOUR FROM events)
        GROUP BY 1""",
    "stream_monitor": f"""SELECT "column", psi, n_reference, n_current, n_outside, psi > 0.2 AS drifted,
          (psi > 0.2)::INTEGER::DOUBLE AS share,
          CASE WHEN psi > 0.2 THEN 'critical' ELSE 'ok' END AS tier FROM ({_psi_sql(["value"])})""",
}
# Stored references and histories answer as the direct tests do.
SQL["ks_against_stored"] = SQL["ks_drift"]
SQL["drift_history_grown"] = SQL["drift_history"]
SQL["stream_rollup_accounted"] = """WITH d AS (SELECT *, date_trunc('hour', ts) AS w, event_id % 3 = 0 AS second FROM events),
    m AS (SELECT MAX(ts) - INTERVAL 2 HOUR AS mark FROM d WHERE NOT second),
    r AS (SELECT d.*, second AND w + INTERVAL 1 HOUR <= mark AS late FROM d, m)
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, COUNT(*) FILTER (NOT late) AS n, COUNT(*) FILTER (late) AS n_late,
      round(SUM(value) FILTER (NOT late), 6) AS total, round(AVG(value) FILTER (NOT late), 6) AS mean,
      CAST(MAX(user_id) FILTER (NOT late) AS DOUBLE) AS user_id
    FROM r GROUP BY w"""
_BY_DAY = _psi_sql(["value", "k"], "period").replace(
    EVENTS_SQL, EVENTS_SQL.replace("e AS (", "b AS (", 1) + ", e AS (SELECT *, strftime(ts, '%Y-%m-%d') AS period FROM b)"
)
SQL["stream_drift_by_day"] = f"""SELECT period, "column", psi, n_reference, n_current, n_outside, psi > 0.2 AS drifted,
      AVG((psi > 0.2)::INTEGER) OVER (PARTITION BY period) AS share,
      CASE WHEN AVG((psi > 0.2)::INTEGER) OVER (PARTITION BY period) > 0.3 THEN 'critical'
           WHEN AVG((psi > 0.2)::INTEGER) OVER (PARTITION BY period) > 0.15 THEN 'warning' ELSE 'ok' END AS tier
    FROM ({_BY_DAY})"""
