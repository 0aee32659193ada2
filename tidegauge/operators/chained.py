"""Quantile bounds of a chain of columns, each among the rows inside the bounds before it.

Two scans answer a chain. The first sketches all columns. Filtering by the earlier columns
takes a known share of the rows, so a rank of a later column can move only so far: that gives
the windows in which its bounds must lie. The second scan counts rows by the windows they meet
in *all* columns at once, with their values inside windows. From this joint table the driver
follows the chain exactly: it finds the first column's bounds, leaves out the rows beyond
them, finds the next column's bounds among the rest, and so on.

Counts check the windows: a rank outside its window, or more rows than the driver should take,
give no answer, and the caller goes column by column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.order_stats import INTERVALS, as_position
from tidegauge.operators.scans import DRIVER_ROWS, REACH, ranks, sketches, slot_sql

EVERYTHING = ((-math.inf, math.inf),)


@dataclass(frozen=True)
class _Link:
    """One column of the chain; ``wide``: it surely has more values than are asked for."""

    name: str
    wide: bool
    windows: tuple[tuple[float, float], ...]
    listed: float  # expected rows in the windows; of a narrow column, its known values


def _links(df: DataFrame, names: Sequence[str], lower: float, upper: float, min_distinct: int) -> list[_Link]:
    """What the second scan looks at, from one sketch of all columns."""
    total, found, _ = sketches(df, names, ())
    links, gone = [], 0.0
    for name in names:
        rows, edges = found.get(name, (0, []))
        values = len(set(edges))
        # Largest share of this column's rows that the columns before it may take.
        share = min(1.0, gone / rows) if rows else 1.0
        # Each interval between two edges holds half of its due at least, so some value of
        # more than ``min_distinct`` intervals is left.
        if values - 2 - min_distinct >= share * 2 * INTERVALS:
            spans: list[tuple[float, float]] = []
            width = 0.0
            for q in sorted((lower, upper)):
                first = math.floor(q * (1 - share) * INTERVALS) - 1 - REACH
                last = math.ceil((q * (1 - share) + share) * INTERVALS) - 1 + REACH
                low = edges[first] if 0 <= first < len(edges) else -math.inf
                high = edges[last] if 0 <= last < len(edges) else math.inf
                width += (min(last, INTERVALS) - max(first, 0)) / INTERVALS
                if spans and low <= spans[-1][1]:
                    spans[-1] = spans[-1][0], max(high, spans[-1][1])
                else:
                    spans.append((low, high))
            links.append(_Link(name, True, tuple(spans), rows * min(width, 1.0)))
        else:
            links.append(_Link(name, False, EVERYTHING, values + 1))
        gone += total - rows + rows * (1 - abs(upper - lower)) + 2
    return links


def _fitting(links: Sequence[_Link]) -> list[_Link]:
    """The longest start of the chain whose joint table the driver should take."""
    near, kinds = 0.0, 1.0
    for i, link in enumerate(links):
        if link.wide:
            near += link.listed
        else:
            kinds *= link.listed
        if near + kinds > DRIVER_ROWS:
            return list(links[:i])
    return list(links)


def _joint(df: DataFrame, links: Sequence[_Link]) -> list | None:
    """One scan: rows ``(s0, x0, s1, x1, ..., n)``; odd slots are windows, with the value."""
    made = df.select(*[as_position(df, link.name).alias(f"v{i}") for i, link in enumerate(links)])
    made = made.withColumns({f"s{i}": F.expr(f"CASE WHEN v{i} IS NOT NULL THEN {slot_sql(f'v{i}', link.windows)} END") for i, link in enumerate(links)})
    # Rows that a column surely takes away need not be told apart by later ones.
    out = F.lit(False)
    keys = []
    for i, link in enumerate(links):
        slot = F.when(~out, F.col(f"s{i}"))
        keys += [slot.alias(f"s{i}"), F.when(slot % 2 == 1, F.col(f"v{i}")).alias(f"x{i}")]
        if link.wide:
            out = out | F.col(f"s{i}").isNull() | F.col(f"s{i}").isin(0, 2 * len(link.windows))
    rows = made.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).limit(DRIVER_ROWS + 1).collect()
    return rows if len(rows) <= DRIVER_ROWS else None


def chained_bounds(
    df: DataFrame, names: Sequence[str], lower: float, upper: float, min_distinct: int
) -> tuple[int, dict[str, tuple[float, float]]]:
    """How many columns from the start are answered, and the bounds of those that count.

    Columns with at most ``min_distinct`` values among the rows left have no bounds. Zero
    columns: the chain has to be followed in another way.
    """
    links = _fitting(_links(df, names, lower, upper, min_distinct))
    rows = _joint(df, links) if links else None
    if rows is None:
        return 0, {}
    n = np.array([r["n"] for r in rows], dtype=np.int64)
    left = np.ones(len(rows), dtype=bool)
    bounds: dict[str, tuple[float, float]] = {}
    for i, link in enumerate(links):
        slot = np.array([-1 if r[f"s{i}"] is None else r[f"s{i}"] for r in rows], dtype=np.int64)
        value = np.array([-math.inf if r[f"x{i}"] is None else r[f"x{i}"] for r in rows], dtype=float)
        here = np.flatnonzero(left & (slot >= 0))
        if not link.wide and len(np.unique(value[here])) <= min_distinct:
            continue
        here = here[np.lexsort((value[here], slot[here]))]
        upto = np.cumsum(n[here])
        if not len(here):
            return i, bounds
        ends, places = [], []
        for q in (lower, upper):
            low, high, part = ranks(int(upto[-1]), q)
            at = here[np.searchsorted(upto, [low, high], side="right")]
            below, above = value[at]
            if (slot[at] % 2 == 0).any() or not np.isfinite(value[at]).all():
                return i, bounds
            ends.append(float(below if below == above else below + (above - below) * part))
            places.append(slot[at])
        bounds[link.name] = ends[0], ends[1]
        within = (value >= ends[0]) & (value <= ends[1])
        between = (slot > places[0][0]) & (slot < places[1][1])
        left &= (slot >= 0) & np.where(slot % 2 == 1, within, between)
    return len(links), bounds
