"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import (
    DIRTY_ROLES,
    EVENTS_SQL,
    SHIP_SPLIT,
    TYPED_SQL,
    dirty_events,
    events,
    round_all,
    table,
)
from tidegauge.operators import profile as P
from tidegauge.plans.exploring import explore

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _text_date(df):
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def describe_percentiles(spark, folder):
    return round_all(P.describe(table(spark, folder, "lineitem"), NUMBERS), 4)


def describe_categorical(spark, folder):
    df = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus")
    return P.describe_categorical(df)


def describe_all(spark, folder):
    df = table(spark, folder, "customer").select("c_acctbal", "c_mktsegment")
    found = P.describe_all(df)
    return round_all(found.withColumns({c: F.col(c).cast("double") for c in ("unique", "freq")}), 4)


def single_quantile(spark, folder):
    df = table(spark, folder, "events")
    value = P.quantile(df, "value", 0.99)
    return round_all(df.agg(F.count("value").alias("n")).withColumn("p99", F.lit(value)))


def hourly_rollup(spark, folder):
    df = P.rollup(events(spark, folder), "ts", "hour", ["value"], ["k"], ["user_id"])
    return round_all(_text_date(df))


def daily_rollup(spark, folder):
    df = P.rollup(events(spark, folder), "ts", "day", ["value"], ["k"], ["user_id"])
    return round_all(_text_date(df))


def hour_pattern(spark, folder):
    return round_all(P.hour_pattern(events(spark, folder), "ts", "value"))


def hour_profile(spark, folder):
    return round_all(P.calendar_profile(events(spark, folder), "ts", "value", "hour"))


def weekday_profile(spark, folder):
    df = table(spark, folder, "orders")
    return round_all(P.calendar_profile(df, "o_orderdate", "o_totalprice", "weekday"), 3)


def month_profile(spark, folder):
    df = table(spark, folder, "orders")
    return round_all(P.calendar_profile(df, "o_orderdate", "o_totalprice", "month"), 3)


def category_counts(spark, folder):
    return P.category_counts(table(spark, folder, "orders"), "o_orderpriority")


def distinct_values(spark, folder):
    return P.distinct_values(table(spark, folder, "part"), "p_brand")


def distinct_counts(spark, folder):
    df = table(spark, folder, "lineitem")
    return P.distinct_counts(df, ["l_partkey", "l_suppkey", "l_returnflag"])


def correlation_matrix(spark, folder):
    return round_all(P.correlation(table(spark, folder, "lineitem"), NUMBERS))


def correlation_daily(spark, folder):
    daily = P.rollup(events(spark, folder), "ts", "day", ["value"], ["k"], ["user_id"])
    return round_all(P.correlation(daily))


def _wide_lines(spark, folder):
    """48 numbers of a line: sums of two columns with weights, absent where a rule says so."""
    made = [
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % (i + 3) != 0, F.col(NUMBERS[i % 4]) * (i + 1) + F.col(NUMBERS[(i + 1) % 4]) * (i % 5)).alias(f"w{i}")
        for i in range(48)
    ]
    return table(spark, folder, "lineitem").select(*made)


def correlation_wide(spark, folder):
    """Pairwise-complete correlation of 48 columns by matrix products."""
    return round_all(P.correlation(_wide_lines(spark, folder)))


def histogram(spark, folder):
    return round_all(P.histogram(table(spark, folder, "lineitem"), "l_extendedprice", 30), 3)


def box_stats(spark, folder):
    return round_all(P.box_stats(table(spark, folder, "events"), ["value"]))


def box_stats_by_category(spark, folder):
    df = table(spark, folder, "lineitem")
    return round_all(P.box_stats(df, ["l_quantity", "l_extendedprice"], ["l_returnflag"]))


def cap_and_describe(spark, folder):
    return round_all(P.cap_and_describe(table(spark, folder, "events"), "value", 157.0), 5)


def compare_datasets(spark, folder):
    df = table(spark, folder, "lineitem")
    early, late = (df.filter(f"l_shipdate {op} '{SHIP_SPLIT}'") for op in ("<", ">="))
    return round_all(P.compare(late, early, NUMBERS, ("late", "early")), 4)


def compare_p99(spark, folder):
    df = table(spark, folder, "lineitem")
    early, late = (df.filter(f"l_shipdate {op} '{SHIP_SPLIT}'") for op in ("<", ">="))
    return round_all(P.compare_quantile({"early": early, "late": late}, "l_extendedprice"))


def power_factor_daily(spark, folder):
    df = events(spark, folder)
    return round_all(_text_date(P.power_factor(df, "ts", "value", "k", "user_id")))


def totals_change(spark, folder):
    df = table(spark, folder, "lineitem").withColumn(
        "net", F.col("l_extendedprice") * (1 - F.col("l_discount"))
    )
    return round_all(P.totals_change(df, "l_extendedprice", "net"), 2)


def exploration(spark, folder):
    """Size and mean of the exploration's steps, and the percentile of its last one."""
    raw = dirty_events(spark, folder)
    tables = explore(raw, DIRTY_ROLES, "user_id", "usage_value", 157.0, 60.0, other=raw)
    parts = None
    for name in ("clean", "within_target_cap", "final"):
        part = tables[name].agg(
            F.count(F.lit(1)).alias("n"), F.avg("usage_value").alias("mean")
        ).withColumn("step", F.lit(name))
        parts = part if parts is None else parts.unionByName(part)
    compared = tables["percentile_comparison"].select(
        "n", F.col("quantile").alias("mean"), F.concat(F.lit("p99 "), "dataset").alias("step")
    )
    return round_all(parts.unionByName(compared))


QUERIES = {
    "describe_percentiles": describe_percentiles,
    "describe_categorical": describe_categorical,
    "describe_all": describe_all,
    "single_quantile": single_quantile,
    "hourly_rollup": hourly_rollup,
    "daily_rollup": daily_rollup,
    "hour_pattern": hour_pattern,
    "hour_profile": hour_profile,
    "weekday_profile": weekday_profile,
    "month_profile": month_profile,
    "category_counts": category_counts,
    "distinct_values": distinct_values,
    "distinct_counts": distinct_counts,
    "correlation_matrix": correlation_matrix,
    "correlation_daily": correlation_daily,
    "correlation_wide": correlation_wide,
    "histogram": histogram,
    "box_stats": box_stats,
    "box_stats_by_category": box_stats_by_category,
    "cap_and_describe": cap_and_describe,
    "compare_datasets": compare_datasets,
    "compare_p99": compare_p99,
    "power_factor_daily": power_factor_daily,
    "totals_change": totals_change,
    "eda_chain": exploration,
}


def _describe_sql(name: str, source: str, shares: dict[str, float], digits: int) -> str:
    marks = ", ".join(
        f"round(quantile_cont({name}, {q}), {digits}) AS {label}" for label, q in shares.items()
    )
    return f"""SELECT '{name}' AS "column", COUNT({name}) AS "count",
        round(AVG({name}), {digits}) AS mean, round(stddev_samp({name}), {digits}) AS std,
        round(MIN({name}), {digits}) AS "min", {marks}, round(MAX({name}), {digits}) AS "max"
        FROM {source}"""


_MARKS = {"p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
_FIELD = {"value": "value", "k": "k", "user_id": "CAST(user_id AS DOUBLE)"}


def _corr_sql(names, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM {source}"
        for a in names
        for b in names
    )


def _box_sql(name: str, source: str, keys: list[str]) -> str:
    by = "".join(f"{k}, " for k in keys)
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    join = f"USING ({', '.join(keys)})" if keys else "ON TRUE"
    return f"""SELECT {by}'{name}' AS "column", n, round(q1, 6) AS q1, round(med, 6) AS median,
          round(q3, 6) AS q3, round(MIN({name}) FILTER (ok), 6) AS whisker_low,
          round(MAX({name}) FILTER (ok), 6) AS whisker_high, COUNT(*) FILTER (NOT ok) AS outliers
        FROM (SELECT s.*, q.n, q.q1, q.med, q.q3,
                {name} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok
              FROM {source} s JOIN (
                SELECT {by}COUNT({name}) AS n, quantile_cont({name}, 0.25) AS q1,
                  quantile_cont({name}, 0.5) AS med, quantile_cont({name}, 0.75) AS q3
                FROM {source} {group}) q {join})
        GROUP BY {by}n, q1, med, q3"""


def _rollup_sql(keys: str) -> str:
    return f"""WITH {EVENTS_SQL}
        SELECT {keys}, round(SUM(value), 6) AS value, round(AVG(k), 6) AS k,
          CAST(MAX(user_id) AS DOUBLE) AS user_id
        FROM e GROUP BY ALL"""


SQL = {
    "describe_percentiles": " UNION ALL ".join(_describe_sql(c, "lineitem", _MARKS, 4) for c in NUMBERS),
    "describe_categorical": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(SUM(n) AS BIGINT) AS "count", COUNT(*) AS "unique",
            arg_min(v, (-n, v)) AS top, MAX(n) AS freq
            FROM (SELECT {c} AS v, COUNT(*) AS n FROM lineitem WHERE {c} IS NOT NULL GROUP BY 1)"""
        for c in ("l_returnflag", "l_linestatus")
    ),
    "describe_all": f"""SELECT *, CAST(NULL AS DOUBLE) AS "unique", CAST(NULL AS VARCHAR) AS top,
          CAST(NULL AS DOUBLE) AS freq
        FROM ({_describe_sql("c_acctbal", "customer", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, 4)})
        UNION ALL BY NAME
        SELECT 'c_mktsegment' AS "column", CAST(SUM(n) AS BIGINT) AS "count",
          CAST(COUNT(*) AS DOUBLE) AS "unique", arg_min(v, (-n, v)) AS top, CAST(MAX(n) AS DOUBLE) AS freq
        FROM (SELECT c_mktsegment AS v, COUNT(*) AS n FROM customer GROUP BY 1)""",
    "single_quantile": """SELECT COUNT(value) AS n, round(quantile_cont(value, 0.99), 6) AS p99
        FROM events""",
    "hourly_rollup": _rollup_sql("strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS INTEGER) AS hour"),
    "daily_rollup": _rollup_sql("strftime(ts, '%Y-%m-%d') AS date"),
    "hour_pattern": """SELECT CAST(h AS INTEGER) AS hour, round(AVG(s), 6) AS mean
        FROM (SELECT CAST(ts AS DATE) AS d, hour(ts) AS h, SUM(value) AS s FROM events GROUP BY 1, 2)
        GROUP BY 1""",
    "hour_profile": """SELECT CAST(hour(ts) AS INTEGER) AS hour, round(AVG(value), 6) AS mean
        FROM events GROUP BY 1""",
    "weekday_profile": """SELECT weekday, round(AVG(o_totalprice), 3) AS mean
        FROM (VALUES ('Monday'), ('Tuesday'), ('Wednesday'), ('Thursday'), ('Friday'),
                     ('Saturday'), ('Sunday')) AS d(weekday)
        LEFT JOIN orders ON dayname(o_orderdate) = weekday GROUP BY 1""",
    "month_profile": """SELECT CAST(month(o_orderdate) AS INTEGER) AS month,
          round(AVG(o_totalprice), 3) AS mean FROM orders GROUP BY 1""",
    "category_counts": "SELECT o_orderpriority AS value, COUNT(*) AS n FROM orders GROUP BY 1",
    "distinct_values": "SELECT DISTINCT p_brand AS value FROM part",
    "distinct_counts": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(DISTINCT {c}) AS n FROM lineitem"""
        for c in ("l_partkey", "l_suppkey", "l_returnflag")
    ),
    "correlation_matrix": _corr_sql(NUMBERS, "lineitem"),
    "correlation_daily": f"""WITH {EVENTS_SQL},
        d AS (SELECT CAST(ts AS DATE) AS day, SUM(value) AS value, AVG(k) AS k,
                CAST(MAX(user_id) AS DOUBLE) AS user_id FROM e GROUP BY 1)
        SELECT a, b, CASE WHEN isnan(r) THEN NULL ELSE r END AS r
        FROM ({_corr_sql(["value", "k", "user_id"], "d")})""",
    "correlation_wide": f"""WITH w AS (SELECT {", ".join(
        f"CASE WHEN (l_orderkey + l_linenumber) % {i + 3} <> 0 THEN {NUMBERS[i % 4]} * {i + 1} + {NUMBERS[(i + 1) % 4]} * {i % 5} END AS w{i}"
        for i in range(48)
    )} FROM lineitem) {_corr_sql([f"w{i}" for i in range(48)], "w")}""",
    "histogram": """WITH s AS (SELECT MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem),
        b AS (SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 30)) + 1, 30) AS INTEGER) AS bin,
                COUNT(*) AS n FROM lineitem, s GROUP BY 1)
        SELECT CAST(i AS INTEGER) AS bin, round(lo + (hi - lo) / 30 * (i - 1), 3) AS "from",
          round(lo + (hi - lo) / 30 * i, 3) AS "to", coalesce(n, 0) AS n
        FROM range(1, 31) AS r(i) CROSS JOIN s LEFT JOIN b ON b.bin = i""",
    "box_stats": _box_sql("value", "events", []),
    "box_stats_by_category": " UNION ALL ".join(
        _box_sql(c, "lineitem", ["l_returnflag"]) for c in ("l_quantity", "l_extendedprice")
    ),
    "cap_and_describe": f"""SELECT *, round((SELECT quantile_cont(value, 0.99) FROM events), 5) AS percentile
        FROM (SELECT *, 'before' AS stage FROM ({_describe_sql("value", "events", _MARKS, 5)})
              UNION ALL
              SELECT *, 'after' FROM ({_describe_sql("value", "(SELECT * FROM events WHERE value <= 157)", _MARKS, 5)}))""",
    "compare_datasets": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column",
            round(AVG({c}) FILTER (l_shipdate >= DATE '{SHIP_SPLIT}'), 4) AS mean_late,
            round(AVG({c}) FILTER (l_shipdate < DATE '{SHIP_SPLIT}'), 4) AS mean_early,
            round(stddev_samp({c}) FILTER (l_shipdate >= DATE '{SHIP_SPLIT}'), 4) AS std_late,
            round(stddev_samp({c}) FILTER (l_shipdate < DATE '{SHIP_SPLIT}'), 4) AS std_early
            FROM lineitem"""
        for c in NUMBERS
    ),
    "compare_p99": f"""SELECT CASE WHEN l_shipdate < DATE '{SHIP_SPLIT}' THEN 'early' ELSE 'late' END AS dataset,
          COUNT(*) AS n, round(quantile_cont(l_extendedprice, 0.99), 6) AS quantile
        FROM lineitem GROUP BY 1""",
    "power_factor_daily": f"""WITH {EVENTS_SQL},
        d AS (SELECT strftime(ts, '%Y-%m-%d') AS date, SUM(value) AS p, SUM(k - user_id) AS q
              FROM e GROUP BY 1)
        SELECT date, round(p, 6) AS p, round(q, 6) AS q,
          round(p / nullif(sqrt(p * p + q * q), 0), 6) AS power_factor FROM d""",
    "totals_change": """SELECT round(b, 2) AS baseline_total, round(s, 2) AS scenario_total,
          round((s - b) / b * 100, 2) AS change_pct
        FROM (SELECT SUM(l_extendedprice) AS b, SUM(l_extendedprice * (1 - l_discount)) AS s
              FROM lineitem)""",
    "eda_chain": f"""WITH {TYPED_SQL},
        capped AS (SELECT * FROM typed WHERE usage_value <= 157),
        final AS (SELECT * FROM capped WHERE usage_value <= 60)
        SELECT 'clean' AS step, COUNT(*) AS n, round(AVG(usage_value), 6) AS mean FROM typed
        UNION ALL SELECT 'within_target_cap', COUNT(*), round(AVG(usage_value), 6) FROM capped
        UNION ALL SELECT 'final', COUNT(*), round(AVG(usage_value), 6) FROM final
        UNION ALL SELECT 'p99 original', COUNT(usage_value), round(quantile_cont(usage_value, 0.99), 6) FROM typed
        UNION ALL SELECT 'p99 modified', COUNT(usage_value), round(quantile_cont(usage_value, 0.99), 6) FROM final""",
}
