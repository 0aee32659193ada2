"""A reference kept as a table, and drift tests that never read its rows again.

``keep_reference`` reduces the reference once: a table of distinct values with running counts,
range-partitioned by column and value, a small table of counts per cell of the value line, and
the counts of categories. A Kolmogorov-Smirnov test of new rows takes the distance at the cell
borders from the small table; only for cells that may hold a larger one are distinct values
looked up, and the reader skips the files and row groups of all others.

``History`` keeps what periods add: counts per period and value, appended under the name of
their increment. Counts of increments add up, so a period may arrive in pieces and in any
order, and an increment that is written again replaces itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.functions.names import column, require
from tidegauge.operators.drift import (
    ALPHA,
    _complete,
    _gap,
    _settled,
    _texts,
    _upto,
    chi_squared_of_counts,
    drift_summary,
    judged,
    ks_rows,
)
from tidegauge.operators.order_stats import Grid, build_grid, in_cells, long_cells
from tidegauge.session import broadcast_if_small, checkpointed

#: Neighbouring cells that are stored together.
CELLS_TOGETHER = 16
META = (
    "columns array<string>, edges array<array<double>>, frequent array<array<double>>, fine array<array<double>>, "
    "splits int, rows bigint, categorical array<string>"
)


def _grid(columns, edges, frequent, fine, rows: int, splits: int) -> Grid:
    """A grid that only places values: what the sketch said of ranges and moments is not kept."""
    zeros = (0.0,) * len(columns)
    return Grid(columns, edges, frequent, zeros, zeros, rows, splits, 1, (0,) * len(columns), ((0, 0.0, 0.0),) * len(columns), fine)


@dataclass(frozen=True)
class Reference:
    """A stored reference: ``values`` and ``cells`` of numbers, ``categories`` of texts."""

    path: str
    grid: Grid
    categorical: tuple[str, ...]
    values: DataFrame
    cells: DataFrame
    categories: DataFrame

    @property
    def numeric(self) -> list[str]:
        return list(self.grid.columns)


def keep_reference(reference: DataFrame, path: str, numeric: Sequence[str] = (), categorical: Sequence[str] = ()) -> Reference:
    """Write the distribution of ``reference`` under ``path`` and return it as a stored one."""
    require(reference, [*numeric, *categorical])
    spark, path = reference.sparkSession, path.rstrip("/")
    grid = build_grid(reference, numeric) if numeric else _grid((), (), (), (), 0, 1)
    counts = long_cells(reference, grid).groupBy("ix", "cell", "part", "value").agg(F.count(F.lit(1)).alias("n")) if numeric else None
    schema = "ix int, cell int, part int, value double, n bigint, upto bigint"
    ran = _upto(counts, ["ix"], "n", "upto").select(*[c.split()[0] for c in schema.split(", ")]) if numeric else spark.createDataFrame([], schema)
    # The grid knows the ranges, so no row is sampled for them: neighbouring cells share a file.
    ran = ran.repartition("ix", F.floor(F.col("cell") / CELLS_TOGETHER)).sortWithinPartitions("ix", "value")
    ran.write.mode("overwrite").parquet(f"{path}/values")
    values = spark.read.parquet(f"{path}/values")
    # All cells of all columns, empty ones too: at most one per sketch interval and column.
    frame = [(i, cell) for i, e in enumerate(grid.edges) for cell in range(len(e) + 1)]
    every = spark.createDataFrame(frame, "ix int, cell int")
    held = values.groupBy("ix", "cell").agg(F.sum("n").alias("n"))
    line = Window.partitionBy("ix").orderBy("cell")
    rows = F.coalesce("n", F.lit(0).cast("bigint"))
    cells = every.join(held, ["ix", "cell"], "left").select(
        "ix", "cell", (F.sum(rows).over(line) - rows).alias("r0"), F.sum(rows).over(line).alias("r1"), F.sum(rows).over(Window.partitionBy("ix")).alias("nr")
    )
    cells.write.mode("overwrite").parquet(f"{path}/cells")
    _texts(reference, categorical).write.mode("overwrite").parquet(f"{path}/categories") if categorical else spark.createDataFrame(
        [], "column string, value string, n bigint"
    ).write.mode("overwrite").parquet(f"{path}/categories")
    lists = [[list(map(float, e)) for e in part] for part in (grid.edges, grid.frequent, grid.fine)]
    row = (list(grid.columns), *lists, grid.splits, grid.rows, list(categorical))
    spark.createDataFrame([row], META).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    return stored_reference(spark, path)


def stored_reference(spark: SparkSession, path: str) -> Reference:
    """The reference under ``path``, as any later job finds it."""
    path = path.rstrip("/")
    meta = spark.read.parquet(f"{path}/meta").first()
    edges, frequent, fine = (tuple(map(tuple, meta[c])) for c in ("edges", "frequent", "fine"))
    grid = _grid(tuple(meta["columns"]), edges, frequent, fine, meta["rows"], meta["splits"])
    tables = (spark.read.parquet(f"{path}/{name}") for name in ("values", "cells", "categories"))
    return Reference(path, grid, tuple(meta["categorical"]), *tables)


def _looked_up(kept: Reference, asked: DataFrame, cells: DataFrame) -> DataFrame:
    """``asked`` (ix, cell, part, value) with reference rows below (``r_before``) and up to (``r_upto``) it.

    Only values in the cells of ``asked`` are read; a window sorts the values of one part.
    """
    # The reader gets the cells as a filter on its sorted columns: a cell per interval at most.
    wanted = [(r["ix"], r["cell"]) for r in cells.select("ix", "cell").distinct().collect()]
    by_ix: dict[int, list[int]] = {}
    for ix, cell in wanted:
        by_ix.setdefault(ix, []).append(cell)
    near: Column = F.lit(False)
    for ix, listed in sorted(by_ix.items()):
        near = near | ((F.col("ix") == ix) & F.col("cell").isin(listed))
    values = kept.values.filter(near)
    # Rows of the reference before each part that is asked about.
    parts = values.groupBy("ix", "cell", "part").agg(F.max("upto").alias("end"))
    both = parts.unionByName(asked.select("ix", "cell", "part", F.lit(None).cast("bigint").alias("end")).distinct())
    earlier = Window.partitionBy("ix", "cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    merged = both.groupBy("ix", "cell", "part").agg(F.max("end").alias("end"))
    starts = merged.withColumn("start", F.max("end").over(earlier)).join(broadcast_if_small(kept.cells, len(wanted) * 2, 64), ["ix", "cell"])
    starts = starts.select("ix", "cell", "part", F.coalesce("start", "r0").alias("start"))
    own = values.select("ix", "cell", "part", "value", "n", "upto", F.lit(False).alias("met"))
    new = asked.select("ix", "cell", "part", "value").distinct()
    new = new.select("*", F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("upto"), F.lit(True).alias("met"))
    spot = ["ix", "cell", "part", "value"]
    line = own.unionByName(new).groupBy(*spot).agg(F.sum("n").alias("n"), F.max("upto").alias("upto"), F.max("met").alias("met"))
    walk = Window.partitionBy("ix", "cell", "part").orderBy("value")
    line = line.withColumn("ran", F.max("upto").over(walk)).filter("met").join(starts, ["ix", "cell", "part"])
    upto = F.coalesce("ran", "start")
    return line.select(*spot, upto.alias("r_upto"), (upto - F.col("n")).alias("r_before"))


def _distances(kept: Reference, cell_rows: DataFrame, rows_in, by: Sequence[str]) -> DataFrame:
    """Largest gap per (``by``, ix): ``cell_rows`` has current rows ``c`` per cell.

    ``rows_in(cells)`` gives current rows ``c`` per value inside those cells, with the columns
    of ``cells``.
    """
    k = [*by, "ix"]
    keys = [column(c) for c in k]
    line = Window.partitionBy(*keys)
    upto = F.sum("c").over(line.orderBy("cell"))
    ran = cell_rows.select(*keys, "cell", upto.alias("c1"), (upto - F.col("c")).alias("c0"), F.sum("c").over(line).alias("nc"))
    # At most a row per interval and column.
    settled = checkpointed(_settled(ran.join(F.broadcast(kept.cells.filter("nr > 0")), ["ix", "cell"]), k))
    found = settled.groupBy(*keys).agg(F.max("best").alias("d"))
    single = [(i, kept.grid.one_value_cells(i)) for i in range(len(kept.grid.columns))]
    listed = [f"(ix = {i} AND cell IN ({', '.join(map(str, c))}))" for i, c in single if c]
    inner = ~F.expr(" OR ".join(listed)) if listed else F.lit(True)
    opened = settled.filter((F.col("most") > F.col("best")) & inner).select(*keys, "cell", "c0", "nr", "nc")
    opened = checkpointed(opened)
    if opened.isEmpty():
        return found
    held = rows_in(opened).groupBy(*keys, "cell", "part", "value", "c0", "nr", "nc").agg(F.sum("c").alias("c"))
    parts = held.groupBy(*keys, "cell", "part").agg(F.sum("c").alias("_n"))
    inside = Window.partitionBy(*keys, "cell").orderBy("part")
    parts = parts.select(*keys, "cell", "part", (F.sum("_n").over(inside) - F.col("_n")).alias("_start"))
    walk = Window.partitionBy(*keys, "cell", "part").orderBy("value")
    held = held.withColumn("_ran", F.sum("c").over(walk)).join(parts, [*k, "cell", "part"])
    held = held.withColumn("c_upto", F.col("c0") + F.col("_start") + F.col("_ran"))
    met = held.join(_looked_up(kept, held, opened), ["ix", "cell", "part", "value"])
    # Between two current values only the reference moves: the ends are at, or just before, one.
    gap = F.greatest(_gap(F.col("r_upto"), F.col("c_upto")), _gap(F.col("r_before"), F.col("c_upto") - F.col("c")))
    more = met.groupBy(*keys).agg(F.max(gap).alias("d"))
    return found.unionByName(more).groupBy(*keys).agg(F.max("d").alias("d"))


def _ks(kept: Reference, cell_rows: DataFrame, rows_in, groups: DataFrame | None, by: Sequence[str]) -> DataFrame:
    found = _distances(kept, cell_rows, rows_in, by)
    ref_sizes = kept.cells.groupBy("ix").agg(F.max("nr").alias("nr")).filter("nr > 0")
    cur_sizes = cell_rows.groupBy(*[column(c) for c in by], "ix").agg(F.sum("c").alias("nc"))
    return ks_rows(_complete(found, ref_sizes, cur_sizes, groups, kept.grid.columns, by), kept.grid, by)


def ks_against(kept: Reference, current: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``drift.ks`` of ``current`` against a stored reference: the same rows, without its table."""
    by = list(by)
    require(current, [*kept.numeric, *by])
    if by:
        current = current.dropna(subset=by)
    keys = [column(c) for c in by]
    long = long_cells(current, kept.grid, keys)
    one = F.lit(1).cast("bigint").alias("c")
    cell_rows = checkpointed(long.groupBy(*keys, "ix", "cell").agg(F.count(F.lit(1)).alias("c")))
    groups = current.select(*keys).distinct() if by else None
    return _ks(kept, cell_rows, lambda cells: in_cells(long.select("*", one), cells, [*by, "ix", "cell"], None), groups, by)


def drift_against(kept: Reference, current: DataFrame, by: Sequence[str] = (), alpha: float = ALPHA) -> DataFrame:
    """``drift.column_drift`` of ``current`` against a stored reference."""
    parts = [ks_against(kept, current, by)] if kept.numeric else []
    if kept.categorical:
        rows = current.dropna(subset=list(by)) if by else current
        groups = rows.select(*[column(c) for c in by]).distinct() if by else None
        parts.append(chi_squared_of_counts(kept.categories, _texts(rows, kept.categorical, by), groups, kept.categorical, by))
    if not parts:
        raise ValueError("no column to compare")
    return judged(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), alpha)


@dataclass(frozen=True)
class History:
    """Drift of periods against one reference, built up by increments under ``path``."""

    kept: Reference
    path: str

    def add(self, current: DataFrame, period: str | Column, increment: str) -> None:
        """Add the counts of ``current``; only its own rows are read.

        Values per period are counted before they are stored. Rows without a period are left
        out. An increment that is run again after a failure replaces what it wrote.
        """
        require(current, [*self.kept.numeric, *self.kept.categorical])
        name = column(period) if isinstance(period, str) else period
        rows = current.withColumn("period", name.cast("string")).dropna(subset=["period"])
        at = f"increment={increment}"
        one = F.count(F.lit(1)).alias("n")
        if self.kept.numeric:
            values = long_cells(rows, self.kept.grid, [F.col("period")]).groupBy("period", "ix", "cell", "part", "value").agg(one)
            values.repartition("period", "ix", "cell").write.mode("overwrite").partitionBy("period").parquet(f"{self.path}/values/{at}")
        if self.kept.categorical:
            texts = _texts(rows, self.kept.categorical, ["period"])
            texts.repartition("period").write.mode("overwrite").partitionBy("period").parquet(f"{self.path}/texts/{at}")
        rows.select("period").distinct().write.mode("overwrite").parquet(f"{self.path}/periods/{at}")

    def _read(self, name: str, periods: Sequence[str] | None, schema: str) -> DataFrame:
        spark = self.kept.values.sparkSession
        table = spark.read.schema(f"{schema}, increment string, period string").parquet(f"{self.path}/{name}")
        return table.filter(F.col("period").isin(list(periods))) if periods is not None else table

    def rows(self, periods: Sequence[str] | None = None, alpha: float = ALPHA) -> DataFrame:
        """Test rows per (period, column) of all periods, or of ``periods``: others are not read."""
        by = ["period"]
        groups = self._read("periods", periods, "_ int").select("period").distinct()
        parts = []
        if self.kept.numeric:
            values = self._read("values", periods, "ix int, cell int, part int, value double, n bigint").withColumnRenamed("n", "c")
            cell_rows = checkpointed(values.groupBy("period", "ix", "cell").agg(F.sum("c").alias("c")))
            held = values.select("period", "ix", "cell", "part", "value", "c")
            parts.append(_ks(self.kept, cell_rows, lambda cells: in_cells(held, cells, ["period", "ix", "cell"], None), groups, by))
        if self.kept.categorical:
            texts = self._read("texts", periods, "column string, value string, n bigint")
            texts = texts.groupBy("period", "column", "value").agg(F.sum("n").alias("n"))
            parts.append(chi_squared_of_counts(self.kept.categories, texts, groups, self.kept.categorical, by))
        return judged(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), alpha)

    def summary(self, periods: Sequence[str] | None = None, alpha: float = ALPHA) -> DataFrame:
        """``drift.drift_history`` of what was added so far."""
        return drift_summary(self.rows(periods, alpha), ["period"])
