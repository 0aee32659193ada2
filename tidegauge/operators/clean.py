"""Cleaning: coercion, text, duplicates, missing values, thresholds, selection.

Every function is lazy except those that must look at values to decide (mean fill,
quantile bounds, whether a text column is numeric); these run one aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.names import column, numeric_columns, require
from tidegauge.functions.values import (
    MISSING_WORDS,
    TIME_FORMATS,
    hash_number,
    nan_to_null,
    normal_text,
    to_number,
    to_time,
)
from tidegauge.operators.chained import chained_bounds
from tidegauge.operators.order_stats import build_grid, nth_row, quantile_values


def _present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def coerce_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Columns to double; text that is no number becomes NULL. Absent ones are skipped."""
    updates = {}
    for name in _present(df, columns):
        numeric = isinstance(df.schema[name].dataType, T.NumericType)
        updates[name] = nan_to_null(column(name).cast("double")) if numeric else to_number(column(name))
    return df.withColumns(updates)


def strip_thousands(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Text columns with thousands commas to double, if no value of the column fails.

    A column with a value that is no number stays as it is. One aggregate decides for all.
    """
    names = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and (columns is None or f.name in set(columns))
    ]
    if not names:
        return df
    numbers = {c: to_number(F.replace(column(c), F.lit(","), F.lit(""))) for c in names}
    words = {c: F.lower(F.trim(column(c))).isin(*MISSING_WORDS) for c in names}
    failing = [
        F.count_if(column(c).isNotNull() & ~words[c] & numbers[c].isNull()).alias(f"f{i}")
        for i, c in enumerate(names)
    ]
    row = df.agg(*failing).first()
    return df.withColumns({c: numbers[c] for i, c in enumerate(names) if row[f"f{i}"] == 0})


def coerce_timestamp(
    df: DataFrame, name: str = "date", formats: Sequence[str] = TIME_FORMATS
) -> DataFrame:
    """Column to ``timestamp_ntz``; text that fits no format becomes NULL."""
    if name not in df.columns:
        return df
    if isinstance(df.schema[name].dataType, T.StringType):
        return df.withColumn(name, to_time(column(name), formats))
    return df.withColumn(name, column(name).cast("timestamp_ntz"))


def normalize_text(
    df: DataFrame, columns: Iterable[str], words: Iterable[str] = MISSING_WORDS
) -> DataFrame:
    """Strip, collapse blanks, lower-case, capital first letter; missing words to NULL."""
    return df.withColumns({c: normal_text(column(c), words) for c in _present(df, columns)})


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One of each set of equal rows; missing values count as equal."""
    return df.dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier one."""
    groups = df.groupBy(*[column(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def drop_missing(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any or all of ``subset`` (default: every column) missing."""
    names = list(subset) if subset is not None else df.columns
    require(df, names)
    tests = [_is_missing(df, c) for c in names]
    combined = tests[0]
    for test in tests[1:]:
        combined = combined | test if how == "any" else combined & test
    return df.filter(~combined)


def _is_missing(df: DataFrame, name: str) -> Column:
    value = column(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def threshold(
    df: DataFrame,
    name: str,
    lower: float | None = None,
    upper: float | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Rows within the bounds. Missing values, NaN too, fall out once there is a bound."""
    require(df, [name])
    value = column(name)
    if lower is not None:
        df = df.filter(value >= lower if inclusive else value > lower)
    if upper is not None:
        df = df.filter(value <= upper if inclusive else value < upper)
    # NaN is above every number.
    if (lower is not None or upper is not None) and isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        df = df.filter(~F.isnan(value))
    return df


def quantile_filter(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    lower: float = 0.005,
    upper: float = 0.995,
    min_distinct: int = 10,
) -> DataFrame:
    """Column after column, keep rows between two quantiles of what is left so far.

    Only columns with more than ``min_distinct`` values count. Two scans answer all columns
    of a table whose joint counts the driver can take (``chained``); on larger ones columns
    go one by one. The bounds are literals, so each pass is the source scan with pushed-down
    filters, not a growing lineage.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    require(df, names)
    while names:
        done, bounds = chained_bounds(df, names, lower, upper, min_distinct)
        if not done:
            break
        for name, (low, high) in bounds.items():
            df = df.filter((column(name) >= low) & (column(name) <= high))
        names = names[done:]
    shares = {"low": lower, "high": upper}
    for name in names:
        grid = build_grid(df, [name])
        if grid.seen[0] <= min_distinct:
            present = df.select(column(name)).filter(~_is_missing(df, name))
            if present.distinct().limit(min_distinct + 1).count() <= min_distinct:
                continue
        bounds = quantile_values(df, [name], shares, grid)[name]
        df = df.filter((column(name) >= bounds["low"]) & (column(name) <= bounds["high"]))
    return df


def fill_mean(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing numbers to the column's mean: one aggregate for all columns."""
    names = list(columns) if columns is not None else numeric_columns(df)
    values = {c: nan_to_null(column(c).cast("double")) for c in names}
    means = df.agg(*[F.avg(values[c]).alias(f"m{i}") for i, c in enumerate(names)]).first()
    return df.withColumns({c: F.coalesce(values[c], F.lit(means[f"m{i}"])) for i, c in enumerate(names)})


def select_columns(
    df: DataFrame, columns: Sequence[str], target: str, drop: Iterable[str] = ()
) -> DataFrame:
    """Drop some columns, then select features and target; the target cannot go."""
    gone = [c for c in drop if c in df.columns]
    if target in gone:
        raise ValueError(f"cannot drop target column '{target}'")
    kept = df.select(*[column(c) for c in df.columns if c not in gone])
    require(kept, [*columns, target])
    return kept.select(*[column(c) for c in (*columns, target)])


def row_at(df: DataFrame, key: str, position: int) -> DataFrame:
    """The row at a 0-based position in the order of ``key``."""
    return nth_row(df, key, position)


def hash_sample(df: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """``size`` rows in hash order of ``key``: the same rows in every run."""
    order = F.md5(F.concat(column(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
    return df.orderBy(order, column(key)).limit(size)


def hash_fraction(key: str, share: float, seed: int = 42) -> Column:
    """True for about ``share`` of the keys, always the same ones."""
    return hash_number(column(key), seed) < int(share * 2**32)


def update_where(df: DataFrame, condition: Column, updates: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows that match; other rows keep their values."""
    require(df, updates)
    return df.withColumns(
        {c: F.when(condition, value).otherwise(column(c)) for c, value in updates.items()}
    )


def sort_by_time(df: DataFrame, time: str = "date") -> DataFrame:
    """Ascending by time: range partitioned, sorted inside each partition."""
    return df.orderBy(column(time).asc_nulls_last())
