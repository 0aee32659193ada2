"""Order statistics, moments and category counts of many columns from shared scans.

Two scans answer everything that is asked at once. The first sketches the columns whose
quantiles are asked and measures count, mean and variance of others. The second counts, for
each wanted rank, the rows below a narrow window about it and the values inside, and the
categories of text columns beside them. The windows come from the sketch and are checked by
the counts, so answers are exact; a rank outside its window, or windows that would hold more
rows than the driver should see, are answered by the cells of ``order_stats`` instead.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.names import column, require
from tidegauge.operators.order_stats import (
    INTERVALS,
    SKETCH_ACCURACY,
    SKETCH_GROUPS,
    _driver_values,
    _merged_edges,
    _merged_moments,
    as_position,
    build_grid,
    doubles,
)

#: Rows, each a value or category and its count, that the driver takes from the second scan.
DRIVER_ROWS = 100_000
#: Sketch intervals that a window reaches to either side of its share.
REACH = 2


@dataclass
class Asked:
    """What a group of consumers wants to know about one table."""

    shares: dict[str, set[float]] = field(default_factory=dict)
    moments: set[str] = field(default_factory=set)
    categories: set[str] = field(default_factory=set)

    def __bool__(self) -> bool:
        return bool(self.shares or self.moments or self.categories)

    def share(self, name: str, *shares: float) -> None:
        self.shares.setdefault(name, set()).update(shares)


@dataclass
class Answers:
    """``around``: values at the ranks below and above a share; absent for a column without values."""

    rows: int = 0
    around: dict[str, dict[float, tuple[float, float, float]]] = field(default_factory=dict)
    moments: dict[str, tuple[int, float, float]] = field(default_factory=dict)
    categories: dict[str, dict[str, int] | None] = field(default_factory=dict)

    def quantile(self, name: str, share: float, low: float = -math.inf, high: float = math.inf) -> float | None:
        """The quantile of the column, or of the column limited to ``[low, high]``."""
        if name not in self.around:
            return None
        below, above, part = self.around[name][share]
        below, above = min(max(below, low), high), min(max(above, low), high)
        return below if below == above else below + (above - below) * part


@dataclass(frozen=True)
class _Windows:
    """Closed intervals of one column, disjoint and in order, that should hold its ranks."""

    name: str
    rows: int
    bounds: tuple[tuple[float, float], ...]


def sketches(df: DataFrame, asked: Sequence[str], measured: Sequence[str]) -> tuple[int, dict[str, tuple[int, list[float]]], dict]:
    """One scan: number of rows; rows and sorted edges of the columns with values; moments."""
    steps = doubles(i / INTERVALS for i in range(1, INTERVALS))
    made = [F.count(F.lit(1)).alias("rows")]
    values = []
    for i, name in enumerate(asked):
        values.append(as_position(df, name).alias(f"v{i}"))
        made += [F.count(f"v{i}").alias(f"n{i}"), F.expr(f"percentile_approx(v{i}, {steps}, {SKETCH_ACCURACY})").alias(f"e{i}")]
    for i, name in enumerate(measured):
        values.append(as_position(df, name).alias(f"w{i}"))
        made += [F.count(f"w{i}").alias(f"k{i}"), F.avg(f"w{i}").alias(f"m{i}"), F.var_pop(f"w{i}").alias(f"s{i}")]
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("part")
    parts = df.select(group, *values).groupBy("part").agg(*made).collect()
    edges = {}
    for i, name in enumerate(asked):
        filled = [p for p in parts if p[f"n{i}"]]
        if filled:
            edges[name] = sum(p[f"n{i}"] for p in filled), sorted(_merged_edges([(p[f"n{i}"], p[f"e{i}"]) for p in filled], INTERVALS))
    found = {}
    for i, name in enumerate(measured):
        filled = [(p[f"k{i}"], p[f"m{i}"], p[f"s{i}"]) for p in parts if p[f"k{i}"]]
        n, mean, square = _merged_moments(filled)
        found[name] = n, mean, square / n if n else 0.0
    return sum(p["rows"] for p in parts), edges, found


def _sketched(df: DataFrame, shares: Mapping[str, set[float]], moments: Sequence[str]) -> tuple[int, list[_Windows], dict]:
    """One scan: number of rows, windows of the columns with values, moments."""
    total, sketched, found = sketches(df, list(shares), list(moments))
    windows = []
    for name, (rows, edges) in sketched.items():
        spans = []
        for share in sorted(shares[name]):
            at = round(share * INTERVALS) - 1
            low = edges[at - REACH] if 0 <= at - REACH < len(edges) else -math.inf
            high = edges[at + REACH] if 0 <= at + REACH < len(edges) else math.inf
            if spans and low <= spans[-1][1]:
                spans[-1] = spans[-1][0], max(high, spans[-1][1])
            else:
                spans.append((low, high))
        windows.append(_Windows(name, rows, tuple(spans)))
    return total, windows, found


def slot_sql(value: str, windows: Sequence[tuple[float, float]]) -> str:
    """Number of the gap (even) or window (odd) that a value lies in."""
    slot = "0"
    for low, high in windows:
        # A value at or past the window's start is one further, past its end two.
        low, high = (f"CAST('{'-' if x < 0 else ''}Infinity' AS DOUBLE)" if math.isinf(x) else f"CAST('{x!r}' AS DOUBLE)" for x in (low, high))
        slot += f" + CASE WHEN {value} > {high} THEN 2 WHEN {value} >= {low} THEN 1 ELSE 0 END"
    return slot


def _counted(df: DataFrame, windows: Sequence[_Windows], categories: Sequence[str]) -> list | None:
    """One scan: rows ``(ix, slot, value, text, n)``; odd slots are windows, even ones gaps.

    None if there are more than the driver should take.
    """
    # Every position is computed once, then compared.
    plain = df.select(
        *[as_position(df, w.name).alias(f"v{i}") for i, w in enumerate(windows)],
        *[column(name).cast("string").alias(f"t{i}") for i, name in enumerate(categories)],
    )
    rows = []
    for i, w in enumerate(windows):
        rows.append(f"{i}, CASE WHEN v{i} IS NOT NULL THEN {slot_sql(f'v{i}', w.bounds)} END, v{i}, CAST(NULL AS STRING)")
    for i in range(len(categories)):
        rows.append(f"{-1 - i}, CASE WHEN t{i} IS NOT NULL THEN 0 END, CAST(NULL AS DOUBLE), t{i}")
    long = plain.select(F.expr(f"stack({len(rows)}, {', '.join(rows)}) AS (ix, slot, value, text)")).filter("slot IS NOT NULL")
    long = long.withColumn("value", F.when(F.col("slot") % 2 == 1, F.col("value")))
    found = long.groupBy("ix", "slot", "value", "text").agg(F.count(F.lit(1)).alias("n")).limit(DRIVER_ROWS + 1).collect()
    return found if len(found) <= DRIVER_ROWS else None


def ranks(rows: int, share: float) -> tuple[int, int, float]:
    place = (rows - 1) * share
    return math.floor(place), math.ceil(place), place - math.floor(place)


def _looked_up(w: _Windows, shares: set[float], counts: Sequence) -> dict[float, tuple[float, float, float]] | None:
    """Values about every share, or None if one is in no window."""
    line = sorted(((r["slot"], -math.inf if r["value"] is None else r["value"], r["n"]) for r in counts))
    wanted = sorted({rank for q in shares for rank in ranks(w.rows, q)[:2]})
    found, upto, at = {}, 0, 0
    for slot, value, n in line:
        upto += n
        while at < len(wanted) and wanted[at] < upto:
            if slot % 2 == 0:
                return None
            found[wanted[at]] = value
            at += 1
    return {q: (found[low], found[high], part) for q in shares for low, high, part in [ranks(w.rows, q)]}


def _by_cells(df: DataFrame, shares: Mapping[str, set[float]]) -> dict[str, dict[float, tuple[float, float, float]]]:
    """The same by cells, for tables of any size: two more scans for all columns."""
    names = list(shares)
    every = sorted(set().union(*shares.values()))
    grid = build_grid(df, names)

    def around(rows: int) -> list[int]:
        return [rank for q in every for rank in ranks(rows, q)[:2]]

    out = {}
    for ix, (rows, values) in _driver_values(df, grid, around).items():
        out[names[ix]] = {q: (values[2 * i], values[2 * i + 1], ranks(rows, q)[2]) for i, q in enumerate(every)}
    return out


def answer(df: DataFrame, asked: Asked) -> Answers:
    """Everything that ``asked`` names, from two scans of ``df`` where the driver can take the counts."""
    require(df, [*asked.shares, *asked.moments, *asked.categories])
    if any(not 0.0 <= q <= 1.0 for shares in asked.shares.values() for q in shares):
        raise ValueError("quantile shares must lie in [0, 1]")
    result = Answers()
    windows: list[_Windows] = []
    if asked.shares or asked.moments:
        result.rows, windows, result.moments = _sketched(df, asked.shares, sorted(asked.moments))
    texts = sorted(asked.categories)
    expected = sum(w.rows * len(w.bounds) * (2 * REACH + 1) / INTERVALS for w in windows)
    counts = None
    if texts or windows:
        near = windows if expected <= DRIVER_ROWS else []
        counts = _counted(df, near, texts) if near or texts else None
        windows_asked = near if counts is not None else []
    else:
        windows_asked = []
    by_ix: dict[int, list] = {}
    for row in counts or []:
        by_ix.setdefault(row["ix"], []).append(row)
    missed = {w.name: asked.shares[w.name] for w in windows if w not in windows_asked}
    for i, w in enumerate(windows_asked):
        found = _looked_up(w, asked.shares[w.name], by_ix.get(i, []))
        if found is None:
            missed[w.name] = asked.shares[w.name]
        else:
            result.around[w.name] = found
    if missed:
        result.around.update(_by_cells(df, missed))
    for i, name in enumerate(texts):
        known = counts is not None
        result.categories[name] = {r["text"]: r["n"] for r in by_ix.get(-1 - i, [])} if known else None
    return result


def quantiles_of(df: DataFrame, columns: Sequence[str], *shares: float) -> dict[str, list[float | None]]:
    """Exact quantiles of a few columns on the driver, from two scans."""
    asked = Asked()
    for name in columns:
        asked.share(name, *shares)
    found = answer(df, asked)
    return {c: [found.quantile(c, q) for q in shares] for c in columns}
