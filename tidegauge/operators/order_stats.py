"""Exact order statistics without a global sort, a global window or a value map.

The value line of every column is cut into *cells* at quantile edges from one sketch,
fixed on the driver. Counting rows per cell is one small aggregate and gives, by running
sums, how many rows lie before each cell. A question such as "the value of rank k" then
concerns one cell only. Where cells hold many rows each is cut again into *parts* at the
quantiles of its own rows, by a second sketch; only the rows of the cells in question are
counted by part, and only those of the part in question value by value.

The sketch steers where the work goes, never the answer: counts are exact, so a poor
sketch makes cells uneven but leaves results unchanged. A value that fills many rows
is one row after the map-side count, and has a cell of its own.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.names import column, require
from tidegauge.functions.values import nan_to_null
from tidegauge.session import broadcast_if_small, checkpointed

INTERVALS = 512
SKETCH_ACCURACY = 8 * INTERVALS
SKETCH_GROUPS = 64
ROWS_PER_CELL = 2_000_000
MAX_SPLITS = 256
EXACT_DOUBLE = 2.0**53


@dataclass(frozen=True)
class Grid:
    """A monotone map from the values of each column to whole cell numbers.

    ``frequent`` values fill whole sketch intervals; ``seen`` counts the distinct values
    the sketch met, a lower bound for the column.
    """

    columns: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    frequent: tuple[tuple[float, ...], ...]
    lows: tuple[float, ...]
    highs: tuple[float, ...]
    rows: int
    splits: int
    groups: int
    seen: tuple[int, ...]
    # Rows with a value, their mean, and the sum of squares about it, per column.
    moments: tuple[tuple[int, float, float], ...]
    # Edges of the parts of all cells, on tables whose cells hold many rows.
    fine: tuple[tuple[float, ...], ...] = ()

    @property
    def total_cells(self) -> int:
        return sum(len(e) + 1 for e in self.edges)

    def name_of(self, index: Column) -> Column:
        return F.element_at(F.array(*[F.lit(c) for c in self.columns]), index + 1)

    def only(self, chosen: Sequence[int]) -> "Grid":
        """The grid of some of the columns, by index."""

        def some(values):
            return tuple(values[i] for i in chosen)

        return replace(
            self,
            columns=some(self.columns),
            edges=some(self.edges),
            frequent=some(self.frequent),
            lows=some(self.lows),
            highs=some(self.highs),
            seen=some(self.seen),
            moments=some(self.moments),
            fine=some(self.fine) if self.fine else (),
        )

    def value_of_cell(self, index: int, cell: int) -> float | None:
        """The value of a one-value cell, else None."""
        value = self.edges[index][cell - 1] if cell else None
        known = value in self.frequent[index] and abs(value) < EXACT_DOUBLE
        return value if known else None

    def one_value_cells(self, index: int) -> list[int]:
        """Cells known to hold equal values only."""
        return [
            self.edges[index].index(v) + 1
            for v in self.frequent[index]
            if abs(v) < EXACT_DOUBLE
        ]


def doubles(values: Iterable[float]) -> str:
    """SQL text of a constant array of doubles: one literal, however many values."""
    named = {math.inf: "Infinity", -math.inf: "-Infinity"}
    text = ",".join(named.get(v) or repr(float(v)) for v in values)
    return f"CAST(split('{text}', ',') AS ARRAY<DOUBLE>)"


def as_position(df: DataFrame, name: str) -> Column:
    """The column as a double that keeps its order; NULL for NaN."""
    kind = df.schema[name].dataType
    value = column(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        # From its fields, which no time zone touches.
        seconds = F.unix_date(value.cast("date")) * 86400.0 + F.hour(value) * 3600 + F.minute(value) * 60
        return F.round(seconds * 1e6 + F.extract(F.lit("SECOND"), value).cast("double") * 1e6)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(value.cast("double"))
    return value.cast("double")


def _merged_edges(parts: Sequence[tuple[int, Sequence[float]]], intervals: int) -> list[float]:
    """Edges of the whole from those of its parts, each edge standing for equal rows."""
    if len(parts) == 1:
        return [float(e) for e in parts[0][1] if math.isfinite(e)]
    weighted = sorted((float(e), n) for n, edges in parts for e in edges if math.isfinite(e))
    total = sum(n for _, n in weighted)
    merged, upto, wanted = [], 0, 1
    for edge, n in weighted:
        upto += n
        while wanted < intervals and upto * intervals >= wanted * total:
            merged.append(edge)
            wanted += 1
    return merged


def _merged_moments(parts: Sequence[tuple[int, float, float]]) -> tuple[int, float, float]:
    """Count, mean and sum of squares about the mean of the whole from those of its parts."""
    n = sum(k for k, _, _ in parts)
    mean = _added(k * m for k, m, _ in parts) / n if n else 0.0
    return n, mean, _added(k * v + k * (m - mean) ** 2 for k, m, v in parts)


def _added(values: Iterable[float]) -> float:
    """Exact sum; infinities add up to an infinity or NaN."""
    listed = list(values)
    return math.fsum(listed) if all(map(math.isfinite, listed)) else sum(listed)


def build_grid(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    rows_per_cell: int = ROWS_PER_CELL,
    intervals: int = INTERVALS,
) -> Grid:
    """Fix the cells for ``columns``: one aggregate over ``df``, its edges collected.

    With ``by`` the number of groups is counted as well, to bound the size of tables
    that hold cells per group.
    """
    require(df, [*columns, *by])
    shares = doubles(i / intervals for i in range(1, intervals))
    aggregates = []
    for i in range(len(columns)):
        aggregates += [
            F.count(f"v{i}").alias(f"n{i}"),
            F.min(f"v{i}").alias(f"low{i}"),
            F.max(f"v{i}").alias(f"high{i}"),
            F.avg(f"v{i}").alias(f"mean{i}"),
            F.var_pop(f"v{i}").alias(f"var{i}"),
            F.expr(f"percentile_approx(v{i}, {shares}, {SKETCH_ACCURACY})").alias(f"edges{i}"),
        ]
    values = [as_position(df, name).alias(f"v{i}") for i, name in enumerate(columns)]
    # Sketches of many tasks meet in SKETCH_GROUPS reducers, not in one.
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))
    parts = df.select(group.alias("part"), *values).groupBy("part").agg(*aggregates).collect()
    groups = df.select(*[column(c) for c in by]).distinct().count() if by else 1
    edges, frequent, lows, highs, seen, counts, moments = [], [], [], [], [], [0], []
    for i in range(len(columns)):
        filled = [p for p in parts if p[f"n{i}"]]
        found = _merged_edges([(p[f"n{i}"], p[f"edges{i}"]) for p in filled], intervals)
        often = sorted({a for a, b in zip(found, found[1:]) if a == b})
        after = {math.nextafter(v, math.inf) for v in often}
        edges.append(tuple(sorted({*found, *after} or {0.0})))
        frequent.append(tuple(often))
        seen.append(len(set(found)))
        lows.append(min((p[f"low{i}"] for p in filled), default=0.0))
        highs.append(max((p[f"high{i}"] for p in filled), default=0.0))
        counts.append(sum(p[f"n{i}"] for p in filled))
        moments.append(_merged_moments([(p[f"n{i}"], p[f"mean{i}"], p[f"var{i}"]) for p in filled]))
    rows = max(counts)
    splits = max(1, min(MAX_SPLITS, math.ceil(rows / (rows_per_cell * intervals))))
    grid = Grid(
        tuple(columns),
        tuple(edges),
        tuple(frequent),
        tuple(lows),
        tuple(highs),
        rows,
        splits,
        groups,
        tuple(seen),
        tuple(moments),
    )
    return replace(grid, fine=_fine_edges(df, grid, splits)) if splits > 1 else grid


def _fine_edges(df: DataFrame, grid: Grid, splits: int) -> tuple[tuple[float, ...], ...]:
    """Edges that cut every cell into about ``splits`` parts of equal rows, per column.

    A second sketch, per cell, so that a value far from the others does not stretch the
    parts: they follow the rows, not the range. At most cells x splits numbers per column.
    """
    shares = doubles(i / splits for i in range(1, splits))
    inner = f"percentile_approx(value, {shares}, {8 * splits})"
    found = long_cells(df, grid).groupBy("ix", "cell").agg(F.expr(inner).alias("edges")).select("ix", "edges")
    edges = [set(e) for e in grid.edges]
    for row in found.toLocalIterator():
        edges[row["ix"]].update(float(e) for e in row["edges"] if math.isfinite(e))
    return tuple(tuple(sorted(e)) for e in edges)


def with_cells(df: DataFrame, grid: Grid, keep: Sequence[Column] = ()) -> DataFrame:
    """``keep`` columns plus per grid column its position, cell and part: ``v0, b0, p0, ..``"""
    kept = df.select(*keep).columns
    count = len(grid.columns)
    values = [as_position(df, c).alias(f"v{i}") for i, c in enumerate(grid.columns)]

    def placed(rows: DataFrame, edges: Sequence[Sequence[float]], name: str) -> DataFrame:
        return Bucketizer(
            splitsArray=[[-math.inf, *e, math.inf] for e in edges],
            inputCols=[f"v{i}" for i in range(count)],
            outputCols=[f"{name}{i}" for i in range(count)],
            handleInvalid="keep",
        ).transform(rows)

    wide = placed(df.select(*keep, *values), grid.edges, "i")
    if grid.fine:
        wide = placed(wide, grid.fine, "f")
    cells = []
    for i in range(count):
        value, cell = F.col(f"v{i}"), F.col(f"i{i}").cast("int")
        # Parts are numbered through all cells.
        part = F.col(f"f{i}").cast("int") if grid.fine else F.lit(0)
        known = value.isNotNull()
        cells += [value, F.when(known, cell).alias(f"b{i}"), F.when(known, part).alias(f"p{i}")]
    return wide.select(*[column(c) for c in kept], *cells)


def long_cells(df: DataFrame, grid: Grid, keep: Sequence[Column] = ()) -> DataFrame:
    """One row per present value: ``keep``, ``ix`` (grid column), ``value``, ``cell``, ``part``."""
    kept = df.select(*keep).columns
    count = len(grid.columns)
    parts = ", ".join(f"{i}, v{i}, b{i}, p{i}" for i in range(count))
    return (
        with_cells(df, grid, keep)
        .select(
            *[column(c) for c in kept],
            F.expr(f"stack({count}, {parts}) AS (ix, value, cell, part)"),
        )
        .filter(F.col("value").isNotNull())
    )


def in_cells(long: DataFrame, cells: DataFrame, keys: Sequence[str], size: int | None) -> DataFrame:
    """Rows of ``long`` that fall in ``cells``, with the columns of ``cells``.

    ``size`` is the number of cells where it is known to be small; otherwise they are kept
    in the shared folder and counted. Too many to broadcast, rows outside any of their
    (ix, cell) are still left out before the shuffle.
    """
    if size is None:
        cells = checkpointed(cells)
        size = cells.count()
        distinct = cells.select("ix", "cell").distinct()
        long = long.join(F.broadcast(distinct), ["ix", "cell"], "left_semi")
    return long.join(broadcast_if_small(cells, size, 96), list(keys))


def _located(df: DataFrame, grid: Grid, by: Sequence[str]) -> DataFrame:
    """Rows per (``by``, ix, cell), rows ``before`` the cell, and ``total`` of the group."""
    k = [*[column(c) for c in by], F.col("ix")]
    line = Window.partitionBy(*k)
    counts = (
        long_cells(df, grid, k[:-1]).groupBy(*k, "cell").agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.select(
        *k,
        "cell",
        "n",
        (F.sum("n").over(line.orderBy("cell")) - F.col("n")).alias("before"),
        F.sum("n").over(line).alias("total"),
    )


def _rank_targets(places: Sequence[Column]) -> list[Column]:
    """For each place the ranks below and above it: targets 2i and 2i + 1."""
    return [
        F.struct(F.lit(2 * i + side).alias("qx"), rank.cast("bigint").alias("rank"))
        for i, place in enumerate(places)
        for side, rank in enumerate((F.floor(place), F.ceil(place)))
    ]


def _between(targets: Column, start: Column, end: Column) -> Column:
    return F.filter(targets, lambda t: (t["rank"] >= start) & (t["rank"] < end))


def _open_cells(df: DataFrame, grid: Grid, by: Sequence[str], targets: Column) -> DataFrame:
    """Cells that hold a target: an array of structs with ``rank``, which may use ``total``."""
    end = F.col("before") + F.col("n")
    found = _located(df, grid, by).withColumn("asked", _between(targets, F.col("before"), end))
    return found.filter(F.size("asked") > 0)


def _values_at(
    long: DataFrame,
    grid: Grid,
    cells: DataFrame,
    keys: Sequence[str],
    targets: Column,
    size: int | None,
) -> DataFrame:
    """Values at the targets, looked up in open cells (``before`` and ``total`` known).

    ``before`` and ``total`` belong to the cell: as keys they keep the hash aggregate.
    """
    k = [column(c) for c in keys]
    opened = in_cells(long, cells, [*keys, "cell"], size)
    if grid.splits > 1:
        counts = opened.groupBy(*k, "cell", "part", "before", "total").agg(
            F.count(F.lit(1)).alias("n")
        )
        line = Window.partitionBy(*k, "cell").orderBy("part")
        start = F.col("before") + F.sum("n").over(line) - F.col("n")
        parts = counts.select(*k, "cell", "part", "total", "n", start.alias("before"))
        end = F.col("before") + F.col("n")
        asked = parts.filter(F.size(_between(targets, F.col("before"), end)) > 0).drop("n")
        opened = in_cells(long, asked, [*keys, "cell", "part"], size)
    values = opened.groupBy(*k, "cell", "part", "before", "total", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    walk = Window.partitionBy(*k, "cell", "part").orderBy("value")
    ranked = values.withColumn("upto", F.col("before") + F.sum("n").over(walk))
    here = _between(targets, F.col("upto") - F.col("n"), F.col("upto"))
    return ranked.select(*k, "value", "total", F.explode(here).alias("t"))


def _driver_values(
    df: DataFrame, grid: Grid, ranks_of: Callable[[int], Sequence[int]]
) -> dict[int, tuple[int, list[float]]]:
    """ix -> (rows, values at ``ranks_of(rows)``) without groups: few numbers on the driver.

    The counts per cell, at most one per interval and column, are summed up here. A cell with
    one value needs no look at its rows, so the last pass reads only the columns that still
    have a question, and only their open cells.
    """
    counted = long_cells(df, grid).groupBy("ix", "cell").agg(F.count(F.lit(1)).alias("n")).collect()
    lines: dict[int, list[tuple[int, int]]] = {}
    for row in counted:
        lines.setdefault(row["ix"], []).append((row["cell"], row["n"]))
    found: dict[int, tuple[int, dict[int, float]]] = {}
    questions: dict[int, set[tuple[int, int]]] = {}
    for ix, line in lines.items():
        line.sort()
        ends = list(accumulate(n for _, n in line))
        values: dict[int, float] = {}
        for rank in ranks_of(ends[-1]):
            at = bisect_right(ends, rank)
            cell, n = line[at]
            single = grid.value_of_cell(ix, cell)
            if single is None:
                questions.setdefault(ix, set()).add((cell, ends[at] - n))
            else:
                values[rank] = single
        found[ix] = ends[-1], values
    if questions:
        order = sorted(questions)
        part = grid.only(order)
        rows = [(i, cell, before) for i, ix in enumerate(order) for cell, before in sorted(questions[ix])]
        wanted = {i: sorted(set(ranks_of(found[ix][0]))) for i, ix in enumerate(order)}
        # At most a cell per column and rank.
        text = ", ".join(f"({i}, {cell}, {before}L, {found[order[i]][0]}L)" for i, cell, before in rows)
        small = df.sparkSession.sql(f"SELECT * FROM VALUES {text} AS (ix, cell, before, total)")
        lists = ", ".join("array(" + ", ".join(f"{r}L" for r in wanted[i]) + ")" for i in range(len(order)))
        ranks = F.transform(
            F.element_at(F.expr(f"array({lists})"), F.col("ix") + 1), lambda r: F.struct(r.alias("rank"))
        )
        values = _values_at(long_cells(df, part), part, small, ["ix"], ranks, len(rows))
        for row in values.select("ix", "t.rank", "value").collect():
            found[order[row["ix"]]][1][row["rank"]] = row["value"]
    return {ix: (rows, [values[r] for r in ranks_of(rows)]) for ix, (rows, values) in found.items()}


def _check(shares: Mapping[str, float]) -> None:
    if not shares or any(not 0.0 <= q <= 1.0 for q in shares.values()):
        raise ValueError("quantile shares must lie in [0, 1]")


def _interpolated(low: float, high: float, place: float) -> float:
    return low if low == high else low + (high - low) * (place - math.floor(place))


def _global_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Mapping[str, float], grid: Grid | None
) -> dict[str, tuple[int, dict[str, float]]]:
    _check(shares)
    grid = grid or build_grid(df, columns)

    def around(rows: int) -> list[int]:
        places = [(rows - 1) * float(q) for q in shares.values()]
        return [rank for place in places for rank in (math.floor(place), math.ceil(place))]

    result = {}
    for ix, (rows, values) in _driver_values(df, grid, around).items():
        result[grid.columns[ix]] = rows, {
            label: _interpolated(values[2 * i], values[2 * i + 1], (rows - 1) * float(q))
            for i, (label, q) in enumerate(shares.items())
        }
    return result


def quantile_values(
    df: DataFrame, columns: Sequence[str], shares: Mapping[str, float], grid: Grid | None = None
) -> dict[str, dict[str, float | None]]:
    """Exact quantiles of a few columns on the driver: column -> name -> value."""
    found = _global_quantiles(df, columns, shares, grid)
    return {c: found[c][1] if c in found else {s: None for s in shares} for c in columns}


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    shares: Mapping[str, float],
    by: Sequence[str] = (),
    grid: Grid | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per (``by``, column).

    ``shares`` maps output names to shares in [0, 1]. Rows with a NULL in ``by`` are
    left out, NULL and NaN values too. Output: ``by``, ``column``, ``n``, then the names.
    """
    if not by:
        rows = [
            (name, n, *values.values())
            for name, (n, values) in _global_quantiles(df, columns, shares, grid).items()
        ]
        fields = ", ".join(f"`{s}` double" for s in shares)
        return df.sparkSession.createDataFrame(rows, f"column string, n bigint, {fields}")
    _check(shares)
    places = [(F.col("total") - 1) * F.lit(float(q)) for q in shares.values()]
    targets = F.array(*_rank_targets(places))
    by = list(by)
    df = df.dropna(subset=by)
    grid = grid or build_grid(df, columns, by)
    keys = [*by, "ix"]
    k = [column(c) for c in keys]
    cells = _open_cells(df, grid, by, targets).select(*k, "cell", "before", "total")
    long = long_cells(df, grid, k[:-1])
    # Two entries per share.
    found = (
        _values_at(long, grid, cells, keys, targets, None)
        .groupBy(*k, "total")
        .agg(F.map_from_entries(F.collect_list(F.struct("t.qx", "value"))).alias("at"))
    )
    outputs = []
    for i, (name, place) in enumerate(zip(shares, places)):
        low, high = F.element_at("at", F.lit(2 * i)), F.element_at("at", F.lit(2 * i + 1))
        step = F.when(high == low, F.lit(0.0)).otherwise((high - low) * (place - F.floor(place)))
        outputs.append((low + step).alias(name))
    return found.select(
        *k[:-1],
        grid.name_of(F.col("ix")).alias("column"),
        F.col("total").alias("n"),
        *outputs,
    )


def values_at_ranks(
    df: DataFrame, key: str, ranks: Sequence[int], grid: Grid | None = None
) -> list[float]:
    """Positions (see ``as_position``) of ``key`` at some 0-based ranks, on the driver."""
    found = _driver_values(df, grid or build_grid(df, [key]), lambda rows: ranks)
    return found[0][1]


def keys_at_ranks(df: DataFrame, key: str, ranks: Sequence[int], grid: Grid | None = None) -> list[tuple[Column, Column]]:
    """For each 0-based rank, what to compare rows with: (row's side, key at the rank).

    Keys that doubles tell apart are compared as positions. Larger ones may share a double;
    they are looked up among the keys of that double, a few thousand for 64-bit numbers.
    """
    place = as_position(df, key)
    sides = []
    for rank, found in zip(ranks, values_at_ranks(df, key, ranks, grid)):
        side = place, F.lit(found)
        if abs(found) >= EXACT_DOUBLE and not isinstance(df.schema[key].dataType, (T.DoubleType, T.FloatType)):
            rest = rank - df.filter(place < found).count()
            near = df.filter(place == found).groupBy(column(key).alias("key")).count().orderBy("key")
            for row in near.toLocalIterator():
                if rest < row["count"]:
                    side = column(key), F.lit(row["key"])
                    break
                rest -= row["count"]
        sides.append(side)
    return sides


def nth_row(df: DataFrame, key: str, position: int) -> DataFrame:
    """The row at a 0-based position by ``key`` (all rows that tie there)."""
    grid = build_grid(df, [key])
    if not 0 <= position < grid.rows:
        return df.limit(0)
    ((own, there),) = keys_at_ranks(df, key, [position], grid)
    return df.filter(own == there)


def with_rank(df: DataFrame, key: str, name: str = "rank", grid: Grid | None = None) -> DataFrame:
    """Add the 0-based position of each row by ``key`` and, as ``<name>_rows``, the count.

    Equal keys share the position of the first of them; rows without a key get NULL.
    Only rows of one part of a cell meet in a window partition.
    """
    grid = grid or build_grid(df, [key])
    row = [column(c) for c in df.columns]
    marked = with_cells(df, grid, row)
    start, rows = f"{name}_start", f"{name}_rows"
    place = ["b0", "p0"]
    counts = marked.filter(F.col("b0").isNotNull()).groupBy(*place).agg(F.count(F.lit(1)).alias("n"))
    # Two short running sums: over the parts of a cell, then over the cells.
    cell = Window.partitionBy("b0")
    by_part = counts.select(
        *place,
        (F.sum("n").over(cell.orderBy("p0")) - F.col("n")).alias("inside"),
        F.sum("n").over(cell).alias("cell_rows"),
    )
    line = Window.partitionBy(F.lit(0))
    by_cell = by_part.groupBy("b0").agg(F.max("cell_rows").alias("n")).select(
        "b0",
        (F.sum("n").over(line.orderBy("b0")) - F.col("n")).alias("before"),
        F.sum("n").over(line).alias(rows),
    )
    starts = by_part.join(F.broadcast(by_cell), "b0").select(
        *place, (F.col("before") + F.col("inside")).alias(start), rows
    )
    placed = marked.join(broadcast_if_small(starts, grid.total_cells * grid.splits, 40), place, "left")
    level = F.col("b0").isNull()
    if grid.frequent[0]:
        level = level | F.col("b0").isin(grid.one_value_cells(0))
    # Rows of a one-value cell stand where the cell starts; they and rows without a key are
    # neither sorted nor shuffled.
    flat = placed.filter(level).withColumn("_in", F.lit(0))
    window = Window.partitionBy(*place).orderBy(column(key))
    uneven = placed.filter(~level).withColumn("_in", F.rank().over(window) - 1)
    rank = F.when(F.col("b0").isNotNull(), F.col(start) + F.col("_in"))
    return flat.unionByName(uneven).select(*row, rank.cast("bigint").alias(name), F.col(rows))
