"""Profiling: summaries, roll-ups, distributions, correlation, comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.calendar import DAY_NAMES, day_name
from tidegauge.functions.names import categorical_columns, column, numeric_columns, require
from tidegauge.functions.values import nan_to_null
from tidegauge.operators.clean import threshold
from tidegauge.operators.order_stats import build_grid, quantile_values, quantiles
from tidegauge.operators.wide import wide_correlation
from tidegauge.session import broadcast_if_small

PERCENTILES = (0.05, 0.25, 0.5, 0.75, 0.99)
#: Most columns whose correlations are written as one aggregate per pair.
WIDE = 40


def percentile_name(share: float) -> str:
    return "p" + f"{share * 100:.6f}".rstrip("0").rstrip(".").replace(".", "_")


def _number(name: str) -> Column:
    return nan_to_null(column(name).cast("double"))


def _unfold(row: DataFrame, names: Sequence[str], fields: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Columns ``<field><i>`` of a summary to one row per name."""
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{f}{i}").alias(f) for f in fields])
        for i, c in enumerate(names)
    ]
    keys = [column(c) for c in by]
    return row.select(*keys, F.inline(F.array(*entries)))


def moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, max of each column in one aggregate, one row per column."""
    require(df, [*columns, *by])
    aggregates = []
    for i, name in enumerate(columns):
        value = _number(name)
        aggregates += [
            F.count(value).alias(f"count{i}"),
            F.avg(value).alias(f"mean{i}"),
            F.stddev_samp(value).alias(f"std{i}"),
            F.min(value).alias(f"min{i}"),
            F.max(value).alias(f"max{i}"),
        ]
    row = df.groupBy(*[column(c) for c in by]).agg(*aggregates) if by else df.agg(*aggregates)
    return _unfold(row, columns, ["count", "mean", "std", "min", "max"], by)


def describe(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    percentiles: Sequence[float] = PERCENTILES,
    approx: bool = False,
) -> DataFrame:
    """count, mean, std, min, percentiles and max, one row per column.

    Percentiles are exact with linear interpolation. Count, mean, deviation and limits come
    from the pass that fixes the cells of the exact percentiles. ``approx`` takes everything
    from one aggregate with one sketch per column.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    labels = {percentile_name(p): p for p in percentiles}
    if approx:
        shares = [float(p) for p in labels.values()]
        found = df.agg(*[F.percentile_approx(_number(c), shares, 10000).alias(f"marks{i}") for i, c in enumerate(names)])
        marks = _unfold(found, names, ["marks"])
        marks = marks.select("column", *[F.get("marks", F.lit(i)).alias(label) for i, label in enumerate(labels)])
        # One row per described column on both sides.
        joined = moments(df, names).join(F.broadcast(marks), "column", "left")
        return joined.select("column", "count", "mean", "std", "min", *labels, "max")
    grid = build_grid(df, names)
    marks = quantile_values(df, names, labels, grid)
    rows = []
    for i, c in enumerate(names):
        n, mean, squares = grid.moments[i]
        some = (float(mean), (squares / (n - 1)) ** 0.5 if n > 1 else None, float(grid.lows[i])) if n else (None, None, None)
        rows.append((c, n, *some, *(marks[c][label] for label in labels), float(grid.highs[i]) if n else None))
    fields = ", ".join(f"`{f}` double" for f in ("mean", "std", "min", *labels, "max"))
    return df.sparkSession.createDataFrame(rows, f"column string, count bigint, {fields}")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, value) for text columns; missing values are left out."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), column(c).cast("string").alias("value")) for c in columns]
    )
    long = df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def describe_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, unique, top and freq of text columns; ties go to the smallest value."""
    names = list(columns) if columns is not None else categorical_columns(df)
    first = F.min(F.struct((-F.col("n")).alias("minus"), F.col("value").alias("value")))
    return (
        value_counts(df, names)
        .groupBy("column")
        .agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), first.alias("first"))
        .select("column", "count", "unique", F.col("first.value").alias("top"), (-F.col("first.minus")).alias("freq"))
    )


def describe_all(df: DataFrame, percentiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Numeric and text summaries in one table."""
    return describe(df, None, percentiles).unionByName(
        describe_categorical(df), allowMissingColumns=True
    )


def category_counts(df: DataFrame, name: str) -> DataFrame:
    """Categories by falling frequency, then by value."""
    counts = df.groupBy(column(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("value"))


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(column(name).alias("value")).distinct()


def distinct_counts(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct non-missing values per column.

    Exact counts come from one group-by on (column, value), a shuffle of distinct values
    only; ``approx`` uses a fixed-size sketch.
    """
    if approx:
        row = df.agg(*[F.approx_count_distinct(column(c)).alias(f"n{i}") for i, c in enumerate(columns)])
        return _unfold(row, columns, ["n"])
    return value_counts(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("n"))


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column."""
    return schema_report(df).select("column", (F.col("rows") - F.col("present")).alias("missing"))


def schema_report(df: DataFrame) -> DataFrame:
    """Type, row count and non-missing count per column."""
    kinds = dict(df.dtypes)
    present = [
        F.count(_number(c) if kinds[c] in ("double", "float") else column(c)).alias(f"present{i}")
        for i, c in enumerate(df.columns)
    ]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *present)
    entries = [
        F.struct(
            F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.col(f"present{i}").alias("present")
        )
        for i, c in enumerate(df.columns)
    ]
    return row.select("rows", F.inline(F.array(*entries))).select("column", "type", "rows", "present")


# --- time ---------------------------------------------------------------------------


def rollup(
    df: DataFrame,
    time: str,
    grain: str = "hour",
    sums: Sequence[str] = (),
    means: Sequence[str] = (),
    maxes: Sequence[str] = (),
) -> DataFrame:
    """Readings per day, or per day and hour: sums, means and maxima under their names."""
    require(df, [time, *sums, *means, *maxes])
    if grain not in ("day", "hour"):
        raise ValueError(f"unknown grain '{grain}'")
    keys = [F.to_date(column(time)).alias("date")]
    if grain == "hour":
        keys.append(F.hour(column(time)).alias("hour"))
    aggregates = [F.sum(_number(c)).alias(c) for c in sums]
    aggregates += [F.avg(_number(c)).alias(c) for c in means]
    aggregates += [F.max(_number(c)).alias(c) for c in maxes]
    return df.filter(column(time).isNotNull()).groupBy(*keys).agg(*aggregates)


def hour_pattern(df: DataFrame, time: str, value: str) -> DataFrame:
    """Mean over days of the hourly sums, by hour of day."""
    hourly = rollup(df, time, "hour", sums=[value])
    return hourly.groupBy("hour").agg(F.avg(column(value)).alias("mean"))


def calendar_profile(df: DataFrame, time: str, value: str, part: str) -> DataFrame:
    """Mean by ``hour``, ``month`` or ``weekday``.

    Weekdays come in calendar order with a row for each of the seven, NULL if unseen.
    """
    mean = F.avg(_number(value)).alias("mean")
    if part in ("hour", "month"):
        place = (F.hour if part == "hour" else F.month)(column(time))
        return df.groupBy(place.alias(part)).agg(mean).filter(F.col(part).isNotNull()).orderBy(part)
    if part != "weekday":
        raise ValueError(f"unknown calendar part '{part}'")
    found = df.groupBy(day_name(column(time)).alias("weekday")).agg(mean)
    days = df.sparkSession.createDataFrame(list(enumerate(DAY_NAMES)), "place int, weekday string")
    # Seven rows on each side.
    return days.join(F.broadcast(found), "weekday", "left").orderBy("place").select("weekday", "mean")


def power_factor(
    df: DataFrame, time: str, active: str, lagging: str, leading: str
) -> DataFrame:
    """Daily P / sqrt(P^2 + Q^2) with Q = lagging - leading, from daily sums."""
    daily = df.groupBy(F.to_date(column(time)).alias("date")).agg(
        F.sum(_number(active)).alias("p"),
        F.sum(_number(lagging) - _number(leading)).alias("q"),
    )
    size = F.sqrt(F.col("p") * F.col("p") + F.col("q") * F.col("q"))
    return daily.withColumn("power_factor", F.try_divide(F.col("p"), size))


def totals_change(df: DataFrame, baseline: str, scenario: str) -> DataFrame:
    """Grand totals of two columns and the change in percent."""
    totals = df.agg(
        F.sum(_number(baseline)).alias("baseline_total"), F.sum(_number(scenario)).alias("scenario_total")
    )
    change = F.col("scenario_total") - F.col("baseline_total")
    return totals.withColumn("change_pct", F.try_divide(change, F.col("baseline_total")) * 100)


# --- distribution --------------------------------------------------------------------


def correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of all ordered pairs over rows where both are present.

    Every pair is one mergeable aggregate of a single scan; half of them are computed. More
    than ``WIDE`` columns, too many for expressions, go by matrix products of blocks.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    if len(names) > WIDE:
        return wide_correlation(df, names)
    pairs = [(a, b) for a in range(len(names)) for b in range(a, len(names))]
    row = df.agg(
        *[F.corr(_number(names[a]), _number(names[b])).alias(f"r{a}_{b}") for a, b in pairs]
    )
    entries = [
        F.struct(
            F.lit(names[a]).alias("a"),
            F.lit(names[b]).alias("b"),
            nan_to_null(F.col(f"r{min(a, b)}_{max(a, b)}")).alias("r"),
        )
        for a in range(len(names))
        for b in range(len(names))
    ]
    return row.select(F.inline(F.array(*entries)))


def bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Number 1..bins of the equal-width bin, top edge closed; NULL outside."""
    width = (high - low) / bins
    place = F.when(high == low, F.lit(1)).otherwise(
        F.least(F.floor((value - low) / F.nullif(width, F.lit(0.0))) + 1, F.lit(bins))
    )
    return F.when((value >= low) & (value <= high), place).cast("int")


def histogram(df: DataFrame, name: str, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Rows per equal-width bin between the smallest and largest value, empty ones too.

    With ``by`` the groups share the edges, for before/after tables.
    """
    require(df, [name, *by])
    value = _number(name)
    keys = [column(c) for c in by]
    span = df.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
    if span["low"] is None:
        raise ValueError(f"column '{name}' has no value")
    low, high = F.lit(span["low"]), F.lit(span["high"])
    binned = (
        df.filter(value.isNotNull())
        .groupBy(*keys, bin_of(value, low, high, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most ``bins`` entries per group: empty bins are filled in from a map.
    filled = binned.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("seen")
    )
    exploded = filled.select(
        *keys, "seen", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")
    )
    width = (high - low) / bins
    return exploded.select(
        *keys,
        "bin",
        (low + width * (F.col("bin") - 1)).alias("from"),
        (low + width * F.col("bin")).alias("to"),
        F.coalesce(F.try_element_at("seen", "bin"), F.lit(0)).alias("n"),
    )


def box_stats(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), reach: float = 1.5
) -> DataFrame:
    """Quartiles, whisker ends within ``reach`` IQR and the outlier count.

    One row per (``by``, column). Quartiles first, then one pass that compares each row
    with the fences of its group.
    """
    by = list(by)
    source = df.dropna(subset=by) if by else df
    grid = build_grid(source, columns, by)
    quartiles = quantiles(source, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by, grid)
    iqr = F.col("q3") - F.col("q1")
    fences = quartiles.withColumns(
        {"fence_low": F.col("q1") - iqr * reach, "fence_high": F.col("q3") + iqr * reach}
    )
    keys = [*by, "column"]
    k = [column(c) for c in keys]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), _number(c).alias("x")) for c in columns])
    long = source.select(*[column(c) for c in by], F.inline(pairs)).filter(F.col("x").isNotNull())
    small = broadcast_if_small(fences, grid.groups * len(columns), 128)
    inside = (F.col("x") >= F.col("fence_low")) & (F.col("x") <= F.col("fence_high"))
    return (
        long.join(small, keys)
        .groupBy(*k, "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def quantile(df: DataFrame, name: str, share: float = 0.99) -> float | None:
    """One exact quantile of a column, as a number on the driver."""
    return quantile_values(df, [name], {"q": share})[name]["q"]


def cap(
    df: DataFrame, name: str, value: float | None = None, share: float = 0.99
) -> tuple[DataFrame, float | None]:
    """Rows up to a cap (default: the quantile), and the quantile itself."""
    found = quantile(df, name, share)
    limit = found if value is None else float(value)
    return threshold(df, name, upper=limit), found


def cap_and_describe(
    df: DataFrame, name: str, value: float | None = None, share: float = 0.99
) -> DataFrame:
    """Summary of a column before and after the cap."""
    label = percentile_name(share)
    # The cap is one more percentile of the first description.
    before = describe(df, [name], sorted({*PERCENTILES, share}))
    found = before.first()[label]
    extra = [label] if share not in PERCENTILES else []
    capped = threshold(df, name, upper=found if value is None else float(value))
    after = describe(capped, [name]).withColumn("stage", F.lit("after"))
    return before.drop(*extra).withColumn("stage", F.lit("before")).unionByName(after).withColumn("percentile", F.lit(found))


def compare(
    left: DataFrame,
    right: DataFrame,
    columns: Sequence[str] | None = None,
    suffixes: Sequence[str] = ("left", "right"),
) -> DataFrame:
    """Mean and std of two datasets side by side, one row per column of the first."""
    names = list(columns) if columns is not None else numeric_columns(left)
    shared = [c for c in names if c in right.columns]
    a, b = suffixes
    first = moments(left, names).select(
        "column", F.col("mean").alias(f"mean_{a}"), F.col("std").alias(f"std_{a}")
    )
    second = moments(right, shared).select(
        "column", F.col("mean").alias(f"mean_{b}"), F.col("std").alias(f"std_{b}")
    )
    # One row per column on both sides.
    joined = first.join(F.broadcast(second), "column", "left")
    return joined.select("column", f"mean_{a}", f"mean_{b}", f"std_{a}", f"std_{b}")


def compare_quantile(
    datasets: Mapping[str, DataFrame], name: str, share: float = 0.99
) -> DataFrame:
    """The same quantile of one column in several datasets, one row per label."""
    labelled = None
    for label, df in datasets.items():
        part = df.select(F.lit(label).alias("dataset"), _number(name).alias(name))
        labelled = part if labelled is None else labelled.unionByName(part)
    found = quantiles(labelled, [name], {"quantile": share}, by=["dataset"])
    return found.select("dataset", "n", "quantile")
