"""Views on the given tables shared by the queries.

The tables are clean, so the cleaning queries see dirt made from their own columns, with
the same rule in Spark and in the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.roles import Roles

HALF = "2024-01-15"
SHIP_SPLIT = "1998-06-01"

EVENT_ROLES = Roles(
    target="value",
    numeric=("k", "user_id"),
    categorical=("event_type",),
    interactions=("user_id", "k"),
    time="ts",
    key="event_id",
)
DIRTY_ROLES = Roles(
    target="usage_value", numeric=("user_id",), categorical=("event_type",), time="date"
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(value: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, digits)


def round_all(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double, so that the last bits of two engines do not matter."""
    doubles = [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({n: F.round(F.col(f"`{n}`").cast("double"), digits) for n in doubles})


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the number in ``props`` as ``k``."""
    return table(spark, folder, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("double")
    )


EVENTS_SQL = """e AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events)"""


def dirty_events(spark: SparkSession, folder: str) -> DataFrame:
    """Text records with bad dates, bad numbers, odd spacing and missing words."""
    return table(spark, folder, "events").selectExpr(
        "event_id",
        "user_id",
        """CASE WHEN event_id % 23 = 0 THEN 'not-a-date'
                WHEN event_id % 7 = 0 THEN date_format(ts, 'dd/MM/yyyy HH:mm:ss')
                ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS Date""",
        """CASE WHEN event_id % 11 = 0 THEN concat('  ', CAST(value AS STRING), ' ')
                WHEN event_id % 13 = 0 THEN 'n/a'
                WHEN event_id % 17 = 0 THEN '5d'
                WHEN event_id % 19 = 0 THEN NULL
                WHEN event_id % 29 = 0 THEN 'NaN'
                ELSE CAST(value AS STRING) END AS `Usage Value`""",
        """CASE WHEN event_id % 5 = 0 THEN concat('  ', upper(event_type), '   EVENT ')
                WHEN event_id % 31 = 0 THEN 'NaN'
                WHEN event_id % 37 = 0 THEN ''
                WHEN event_id % 41 = 0 THEN 'None'
                ELSE event_type END AS `Event Type`""",
    )


DIRTY_SQL = """dirty AS (
  SELECT event_id, user_id,
    CASE WHEN event_id % 23 = 0 THEN 'not-a-date'
         WHEN event_id % 7 = 0 THEN strftime(ts, '%d/%m/%Y %H:%M:%S')
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS raw_date,
    CASE WHEN event_id % 11 = 0 THEN '  ' || CAST(value AS VARCHAR) || ' '
         WHEN event_id % 13 = 0 THEN 'n/a'
         WHEN event_id % 17 = 0 THEN '5d'
         WHEN event_id % 19 = 0 THEN NULL
         WHEN event_id % 29 = 0 THEN 'NaN'
         ELSE CAST(value AS VARCHAR) END AS raw_value,
    CASE WHEN event_id % 5 = 0 THEN '  ' || upper(event_type) || '   EVENT '
         WHEN event_id % 31 = 0 THEN 'NaN'
         WHEN event_id % 37 = 0 THEN ''
         WHEN event_id % 41 = 0 THEN 'None'
         ELSE event_type END AS raw_type
  FROM events)"""

# The same columns after coercion.
TYPED_SQL = (
    DIRTY_SQL
    + """,
flat AS (
  SELECT *, lower(trim(regexp_replace(raw_type, '\\s+', ' ', 'g'))) AS low_type,
         trim(raw_value) AS cut_value
  FROM dirty),
typed AS (
  SELECT event_id, user_id,
    try_strptime(raw_date, ['%Y-%m-%d %H:%M:%S', '%d/%m/%Y %H:%M:%S']) AS date,
    CASE WHEN regexp_matches(cut_value, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$')
         THEN TRY_CAST(cut_value AS DOUBLE) END AS usage_value,
    CASE WHEN low_type NOT IN ('nan', 'none', 'na', '')
         THEN upper(substr(low_type, 1, 1)) || substr(low_type, 2) END AS event_type
  FROM flat)"""
)


def second_text(name: str) -> Column:
    """A time as text to the second, the same in both engines."""
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss")
