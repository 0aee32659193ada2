"""Cleaning queries."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.inputs import (
    DIRTY_ROLES,
    DIRTY_SQL,
    EVENTS_SQL,
    TYPED_SQL,
    dirty_events,
    events,
    round_all,
    second_text,
    table,
)
from tidegauge.functions.names import normalize_headers, rename, resolve, safe_names
from tidegauge.operators import clean as C
from tidegauge.operators.order_stats import nth_row
from tidegauge.operators.profile import null_profile, schema_report
from tidegauge.plans.cleaning import clean, prepare_table, preprocess
from tidegauge.session import shared_folder
from tidegauge.sources.quarantine import quarantined
from tidegauge.sources.tables import read_table, text_schema, write_table


def _typed(spark, folder):
    """Dirty events with normal headers, coerced but not deduplicated."""
    df = normalize_headers(dirty_events(spark, folder))
    df = C.coerce_timestamp(df, "date")
    df = C.coerce_numeric(df, ["usage_value"])
    return C.normalize_text(df, ["event_type"])


def coerce_numeric(spark, folder):
    df = normalize_headers(dirty_events(spark, folder))
    return C.coerce_numeric(df, ["usage_value"]).select("event_id", "usage_value")


def coerce_timestamp(spark, folder):
    df = normalize_headers(dirty_events(spark, folder))
    return C.coerce_timestamp(df, "date").select("event_id", second_text("date").alias("date"))


def normalize_text(spark, folder):
    df = normalize_headers(dirty_events(spark, folder))
    return C.normalize_text(df, ["event_type"]).select("event_id", "event_type")


def strip_thousands(spark, folder):
    df = table(spark, folder, "orders").select(
        "o_orderkey",
        F.format_number("o_totalprice", 2).alias("price"),
        F.concat("o_orderstatus", F.lit(",1")).alias("code"),
    )
    return C.strip_thousands(df).select("o_orderkey", "price", "code")


def drop_duplicates(spark, folder):
    df = table(spark, folder, "events").select(
        "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")
    )
    return C.drop_duplicates(df)


def duplicate_count(spark, folder):
    df = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return C.duplicate_count(df).select(F.col("duplicates").cast("bigint").alias("duplicates"))


def drop_missing(spark, folder):
    df = _typed(spark, folder).select("event_id", "date", "usage_value", "event_type")
    parts = None
    for label, how, subset in (
        ("any", "any", None),
        ("all", "all", ["date", "usage_value", "event_type"]),
        ("subset", "any", ["usage_value"]),
    ):
        part = C.drop_missing(df, how, subset).select(F.lit(label).alias("mode"), "event_id")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def threshold_filter(spark, folder):
    df = table(spark, folder, "events").select("event_id", "value")
    closed = C.threshold(df, "value", lower=5.0, upper=60.0)
    opened = C.threshold(df, "value", lower=5.0, upper=60.0, inclusive=False)
    return closed.withColumn("bounds", F.lit("closed")).unionByName(
        opened.withColumn("bounds", F.lit("open"))
    )


def quantile_filter(spark, folder):
    df = events(spark, folder).select("event_id", "value", "k")
    return C.quantile_filter(df, ["value", "k"], 0.005, 0.995)


def mean_fill(spark, folder):
    df = _typed(spark, folder).select("event_id", "usage_value")
    return round_all(C.fill_mean(df, ["usage_value"]))


def hash_sample(spark, folder):
    return C.hash_sample(table(spark, folder, "events"), "event_id", 100).select("event_id", "value")


def null_counts(spark, folder):
    return null_profile(_typed(spark, folder))


def schema_rows(spark, folder):
    return schema_report(_typed(spark, folder))


def rename_headers(spark, folder):
    df = safe_names(dirty_events(spark, folder))
    found = resolve(df, ["USAGE.VALUE"])
    return rename(df, {found: "reading", "absent": "x"}).select(
        "event_id", "user_id", "date", "reading", "event_type"
    )


def column_select(spark, folder):
    df = table(spark, folder, "events")
    return C.select_columns(df, ["event_id", "user_id"], "value", drop=["props", "event_type"])


def row_lookup(spark, folder):
    df = table(spark, folder, "events")
    return C.row_at(df, "event_id", 329).select("event_id", "user_id", "event_type", "value")


def conditional_update(spark, folder):
    df = events(spark, folder).select("event_id", "ts", "value", "k")
    weekday = F.weekday("ts") < 5
    changed = C.update_where(df, weekday, {"value": F.col("value") + 175.0, "k": F.lit(0.0)})
    return round_all(changed.drop("ts"))


def clean_chain(spark, folder):
    df = dirty_events(spark, folder)
    doubled = df.unionByName(df)
    return round_all(clean(doubled, DIRTY_ROLES).withColumn("date", second_text("date")))


def preprocess_chain(spark, folder):
    df = C.normalize_text(normalize_headers(dirty_events(spark, folder)), ["event_type"])
    df = C.coerce_numeric(df, ["usage_value"])
    kept = C.update_where(df, F.col("event_type").endswith(" event"), {"event_type": F.lit("Event")})
    return preprocess(kept, DIRTY_ROLES).withColumn("date", second_text("date"))


def write_read(spark, folder):
    path = f"{shared_folder(spark)}/written-{uuid4().hex}"
    df = table(spark, folder, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    write_table(df.drop("ts", "props"), path, partition_by=["day"], sort_by=["event_id"])
    stored = read_table(spark, path, required=["event_id", "day"])
    return stored.select("event_id", "user_id", "event_type", "value", F.col("day").cast("string").alias("day"))


def csv_round_trip(spark, folder):
    """Text with quotes, commas and line breaks through a CSV sink and source."""
    path = f"{shared_folder(spark)}/csv-{uuid4().hex}"
    note = F.concat(F.lit('said "'), "event_type", F.lit('",\nthen left'))
    df = table(spark, folder, "events").select("event_id", "value", "event_type", note.alias("note"))
    write_table(df, path, fmt="csv", sort_by=["event_id"])
    back = read_table(spark, path, "csv", required=["event_id", "note"], schema=text_schema(df.columns), multi_line=True)
    typed = C.coerce_numeric(back, ["value"]).withColumn("event_id", F.col("event_id").cast("bigint"))
    return typed.select("event_id", "value", "event_type", "note")


def quarantined_lines(spark, folder):
    """Lines of events, some with a field too many, an open quote or a word for a number."""
    base = f"{shared_folder(spark)}/lines-{uuid4().hex}"
    e = F.col("event_id")
    value = F.when(e % 13 == 0, "much").when(e % 11 == 0, F.lit('"7')).otherwise((e % 50).cast("string"))
    line = F.concat_ws(",", e, value, "event_type", F.when(e % 7 == 0, "more"))
    table(spark, folder, "events").select(line.alias("line")).write.text(f"{base}/raw")
    found = quarantined(spark, f"{base}/raw", T.StructType.fromDDL("event_id long, amount int, event_type string"), f"{base}/out", header=False)
    good = found.good.select(F.lit("good").alias("state"), "event_id", "amount", F.lit("").alias("record"))
    bad = found.bad.select(F.lit("bad").alias("state"), F.lit(-1).cast("long").alias("event_id"), F.lit(-1).alias("amount"), "record")
    sums = found.counts.agg(F.sum("good").alias("event_id"), F.sum("bad").cast("int").alias("amount"))
    return good.unionByName(bad).unionByName(sums.select(F.lit("counts").alias("state"), "event_id", "amount", F.lit("").alias("record")))


def prepared(spark, folder):
    """Raw CSV to a table with a folder per day: rows per day and the largest value."""
    base = f"{shared_folder(spark)}/prepared-{uuid4().hex}"
    write_table(normalize_headers(dirty_events(spark, folder)), f"{base}/raw", fmt="csv")
    names = ["event_id", "user_id", "date", "usage_value", "event_type"]
    raw = read_table(spark, f"{base}/raw", "csv", schema=text_schema(names))
    write_table(raw, f"{base}/text")
    stored = prepare_table(spark, f"{base}/text", f"{base}/out", DIRTY_ROLES, fmt="parquet")
    found = stored.groupBy(F.col("date_day").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.max("usage_value").alias("largest"), F.sum("hour").alias("hours")
    )
    return round_all(found)


def threshold_nan(spark, folder):
    """NaN is within no bound."""
    df = table(spark, folder, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    return C.threshold(df, "value", lower=40.0)


def row_lookup_wide(spark, folder):
    """The row at a position by ids that doubles cannot tell apart."""
    df = table(spark, folder, "events").select((F.col("event_id") + F.lit(1 << 60)).alias("wide_id"), "event_type")
    return nth_row(df, "wide_id", 57)


QUERIES = {
    "csv_round_trip": csv_round_trip,
    "quarantined_lines": quarantined_lines,
    "prepare_table": prepared,
    "threshold_nan": threshold_nan,
    "row_lookup_wide": row_lookup_wide,
    "coerce_numeric": coerce_numeric,
    "coerce_timestamp": coerce_timestamp,
    "normalize_text": normalize_text,
    "strip_thousands": strip_thousands,
    "drop_duplicates": drop_duplicates,
    "duplicate_count": duplicate_count,
    "drop_missing_modes": drop_missing,
    "threshold_filter": threshold_filter,
    "quantile_filter": quantile_filter,
    "mean_fill": mean_fill,
    "hash_sample": hash_sample,
    "null_profile": null_counts,
    "schema_report": schema_rows,
    "rename_headers": rename_headers,
    "column_select": column_select,
    "row_lookup": row_lookup,
    "conditional_update": conditional_update,
    "clean_chain": clean_chain,
    "preprocess": preprocess_chain,
    "write_read_table": write_read,
}

SQL = {
    "csv_round_trip": """SELECT event_id, value, event_type,
        'said "' || event_type || '",' || chr(10) || 'then left' AS note FROM events""",
    "quarantined_lines": """WITH l AS (SELECT event_id, event_id % 13 = 0 OR event_id % 11 = 0 OR event_id % 7 = 0 AS bad,
          concat_ws(',', event_id, CASE WHEN event_id % 13 = 0 THEN 'much' WHEN event_id % 11 = 0 THEN '"7'
            ELSE CAST(event_id % 50 AS VARCHAR) END, event_type, CASE WHEN event_id % 7 = 0 THEN 'more' END) AS line FROM events)
        SELECT CASE WHEN bad THEN 'bad' ELSE 'good' END AS state, CASE WHEN bad THEN -1 ELSE event_id END AS event_id,
          CAST(CASE WHEN bad THEN -1 ELSE event_id % 50 END AS INTEGER) AS amount, CASE WHEN bad THEN line ELSE '' END AS record FROM l
        UNION ALL SELECT 'counts', CAST(SUM(CASE WHEN bad THEN 0 ELSE 1 END) AS BIGINT),
          CAST(SUM(CASE WHEN bad THEN 1 ELSE 0 END) AS INTEGER), '' FROM l""",
    "prepare_table": f"""WITH {TYPED_SQL},
        r AS (SELECT t.date, t.usage_value FROM typed t JOIN dirty d USING (event_id)
              WHERE t.date IS NOT NULL AND t.usage_value IS NOT NULL AND d.raw_type <> '')
        SELECT strftime(date, '%Y-%m-%d') AS day, COUNT(*) AS n, round(MAX(usage_value), 6) AS largest,
          CAST(SUM(hour(date)) AS BIGINT) AS hours FROM r GROUP BY 1""",
    "threshold_nan": "SELECT event_id, value FROM events WHERE event_id % 3 <> 0 AND value >= 40",
    "row_lookup_wide": """SELECT event_id + 1152921504606846976 AS wide_id, event_type FROM
        (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events) WHERE i = 57""",
    "coerce_numeric": f"WITH {TYPED_SQL} SELECT event_id, usage_value FROM typed",
    "coerce_timestamp": f"""WITH {TYPED_SQL}
        SELECT event_id, strftime(date, '%Y-%m-%d %H:%M:%S') AS date FROM typed""",
    "normalize_text": f"WITH {TYPED_SQL} SELECT event_id, event_type FROM typed",
    "strip_thousands": """SELECT o_orderkey,
        CAST(replace(format('{:,.2f}', o_totalprice), ',', '') AS DOUBLE) AS price,
        o_orderstatus || ',1' AS code FROM orders""",
    "drop_duplicates": """SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day
        FROM events""",
    "duplicate_count": """SELECT CAST(COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT)
        AS duplicates FROM lineitem""",
    "drop_missing_modes": f"""WITH {TYPED_SQL}
        SELECT 'any' AS mode, event_id FROM typed
        WHERE date IS NOT NULL AND usage_value IS NOT NULL AND event_type IS NOT NULL
        UNION ALL SELECT 'all', event_id FROM typed
        WHERE date IS NOT NULL OR usage_value IS NOT NULL OR event_type IS NOT NULL
        UNION ALL SELECT 'subset', event_id FROM typed WHERE usage_value IS NOT NULL""",
    "threshold_filter": """SELECT event_id, value, 'closed' AS bounds FROM events
        WHERE value BETWEEN 5 AND 60
        UNION ALL SELECT event_id, value, 'open' FROM events WHERE value > 5 AND value < 60""",
    "quantile_filter": f"""WITH {EVENTS_SQL},
        b1 AS (SELECT quantile_cont(value, 0.005) AS lo, quantile_cont(value, 0.995) AS hi FROM e),
        s1 AS (SELECT e.* FROM e, b1 WHERE value BETWEEN lo AND hi),
        b2 AS (SELECT quantile_cont(k, 0.005) AS lo, quantile_cont(k, 0.995) AS hi FROM s1)
        SELECT event_id, value, k FROM s1, b2 WHERE k BETWEEN lo AND hi""",
    "mean_fill": f"""WITH {TYPED_SQL}
        SELECT event_id, round(coalesce(usage_value, (SELECT avg(usage_value) FROM typed)), 6)
        AS usage_value FROM typed""",
    "hash_sample": """SELECT event_id, value FROM events
        ORDER BY md5(CAST(event_id AS VARCHAR) || ':42'), event_id LIMIT 100""",
    "null_profile": f"""WITH {TYPED_SQL}
        SELECT 'event_id' AS "column", COUNT(*) - COUNT(event_id) AS missing FROM typed
        UNION ALL SELECT 'user_id', COUNT(*) - COUNT(user_id) FROM typed
        UNION ALL SELECT 'date', COUNT(*) - COUNT(date) FROM typed
        UNION ALL SELECT 'usage_value', COUNT(*) - COUNT(usage_value) FROM typed
        UNION ALL SELECT 'event_type', COUNT(*) - COUNT(event_type) FROM typed""",
    "schema_report": f"""WITH {TYPED_SQL}
        SELECT 'event_id' AS "column", 'bigint' AS "type", COUNT(*) AS "rows",
               COUNT(event_id) AS present FROM typed
        UNION ALL SELECT 'user_id', 'bigint', COUNT(*), COUNT(user_id) FROM typed
        UNION ALL SELECT 'date', 'timestamp_ntz', COUNT(*), COUNT(date) FROM typed
        UNION ALL SELECT 'usage_value', 'double', COUNT(*), COUNT(usage_value) FROM typed
        UNION ALL SELECT 'event_type', 'string', COUNT(*), COUNT(event_type) FROM typed""",
    "rename_headers": f"""WITH {DIRTY_SQL}
        SELECT event_id, user_id, raw_date AS date, raw_value AS reading, raw_type AS event_type
        FROM dirty""",
    "column_select": "SELECT event_id, user_id, value FROM events",
    "row_lookup": """SELECT event_id, user_id, event_type, value FROM
        (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS place FROM events) WHERE place = 329""",
    "conditional_update": f"""WITH {EVENTS_SQL}
        SELECT event_id,
          round(CASE WHEN isodow(ts) < 6 THEN value + 175 ELSE value END, 6) AS value,
          round(CASE WHEN isodow(ts) < 6 THEN 0 ELSE k END, 6) AS k FROM e""",
    "clean_chain": f"""WITH {TYPED_SQL}
        SELECT event_id, CAST(user_id AS DOUBLE) AS user_id,
          strftime(date, '%Y-%m-%d %H:%M:%S') AS date, round(usage_value, 6) AS usage_value, event_type
        FROM typed""",
    "preprocess": f"""WITH {TYPED_SQL},
        kept AS (SELECT event_id, user_id, date, usage_value,
                   CASE WHEN event_type LIKE '% event' THEN 'Event' ELSE event_type END AS event_type
                 FROM typed
                 WHERE date IS NOT NULL AND usage_value IS NOT NULL AND event_type IS NOT NULL)
        SELECT event_id, user_id, strftime(date, '%Y-%m-%d %H:%M:%S') AS date, usage_value,
          CAST(hour(date) AS INTEGER) AS hour, CAST(isodow(date) - 1 AS INTEGER) AS dayofweek_num,
          CAST(month(date) AS INTEGER) AS month,
          CAST(event_type = 'Error' AS INTEGER) AS "event_type_Error",
          CAST(event_type = 'Event' AS INTEGER) AS "event_type_Event",
          CAST(event_type = 'Purchase' AS INTEGER) AS "event_type_Purchase",
          CAST(event_type = 'Signup' AS INTEGER) AS "event_type_Signup",
          CAST(event_type = 'View' AS INTEGER) AS "event_type_View"
        FROM kept""",
    "write_read_table": """SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS day
        FROM events""",
}
