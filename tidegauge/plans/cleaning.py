"""Cleaning jobs: dirty text records to a clean, or a model-ready, table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidegauge.functions.names import column, normalize_headers, require
from tidegauge.functions.calendar import part
from tidegauge.functions.values import MISSING_WORDS, TIME_FORMATS
from tidegauge.operators.clean import (
    coerce_numeric,
    coerce_timestamp,
    drop_duplicates,
    drop_missing,
    normalize_text,
    sort_by_time,
)
from tidegauge.operators.stages import Dummies
from tidegauge.roles import Roles
from tidegauge.sources.tables import read_table, write_table


def clean(
    df: DataFrame,
    roles: Roles,
    formats: Sequence[str] = TIME_FORMATS,
    words: Iterable[str] = MISSING_WORDS,
) -> DataFrame:
    """Headers, duplicates, time, numbers, text: one lazy plan.

    Duplicates go before the casts, so rows that only become equal by coercion stay.
    """
    df = drop_duplicates(normalize_headers(df))
    df = coerce_timestamp(df, roles.time, formats)
    df = coerce_numeric(df, [roles.target, *roles.numeric])
    return normalize_text(df, roles.categorical, words)


def time_columns(df: DataFrame, time: str) -> DataFrame:
    """Add ``hour``, ``dayofweek_num`` (Monday 0) and ``month``."""
    moment = column(time)
    return df.withColumns(
        {
            "hour": part(moment, "hour"),
            "dayofweek_num": part(moment, "dayofweek"),
            "month": part(moment, "month"),
        }
    )


def preprocess(
    df: DataFrame, roles: Roles, formats: Sequence[str] = TIME_FORMATS, sort: bool = True
) -> DataFrame:
    """Time, complete rows only, by time, time columns, dummy columns."""
    require(df, [roles.time, *roles.categorical])
    df = drop_missing(coerce_timestamp(df, roles.time, formats))
    df = time_columns(df, roles.time)
    df = Dummies(columns=list(roles.categorical)).fit(df).transform(df)
    return sort_by_time(df, roles.time) if sort else df


def prepare_table(
    spark: SparkSession,
    source: str,
    output: str,
    roles: Roles,
    fmt: str = "csv",
    output_fmt: str = "parquet",
    by_day: bool = True,
) -> DataFrame:
    """Read raw records, preprocess, write in order of time; returns the written table.

    ``by_day`` makes one folder per day, column ``<time>_day``, so that readers of a period
    skip the rest.
    """
    raw = read_table(spark, source, fmt, required=[roles.time, *roles.categorical, roles.target])
    typed = coerce_numeric(raw, [roles.target, *roles.numeric])
    ready = preprocess(typed, roles, sort=False)
    day = f"{roles.time}_day"
    if by_day:
        ready = ready.withColumn(day, column(roles.time).cast("date"))
    write_table(ready, output, output_fmt, partition_by=[day] if by_day else [], sort_by=[roles.time])
    return read_table(spark, output, output_fmt)
