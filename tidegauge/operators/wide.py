"""Correlation of many columns: masked cross-products in blocks of columns.

A pair of columns is one aggregate in plain SQL, which is half a million for a thousand
columns. Here every task multiplies matrices of its rows and hands on one row per column, so
what is shuffled depends on columns and tasks, not on rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.names import column
from tidegauge.functions.values import nan_to_null

#: Columns whose cross-products with all others one pass over the table adds up.
BLOCK = 512
#: Rows that are multiplied at once.
ROWS = 4096
#: A pair's spread below this share of its distance from the column's mean is rounding.
FLAT = 1e-13


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Values with zero for null, and which are there."""
    there = np.column_stack([np.asarray(c.is_valid()) for c in batch.columns]).astype(np.float64)
    values = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
    return values, there


def _partial(first: int, last: int):
    """Sums over the rows of a task for the pairs of columns ``first`` to ``last`` with all."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                x, m = _matrix(whole.slice(at, ROWS))
                square = x * x
                mine, here = x[:, first:last].T, m[:, first:last].T
                part = np.stack([here @ m, mine @ m, square[:, first:last].T @ m, here @ x, here @ square, mine @ x], axis=1)
                sums = part if sums is None else sums + part
        if sums is not None:
            rows = sums.reshape(len(sums), -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(first, last), pa.int32()), pa.array(list(rows), pa.list_(pa.float64()))], names=["i", "sums"])

    return summed


def _coefficients(sums: np.ndarray, n: int) -> np.ndarray:
    """Coefficients of one column with all: NaN where a side has no spread."""
    count, x, xx, y, yy, xy = sums.reshape(6, n)
    with np.errstate(all="ignore"):
        a, b = xx - x * x / count, yy - y * y / count
        r = (xy - x * y / count) / np.sqrt(a * b)
        return np.where((a > FLAT * xx) & (b > FLAT * yy), np.clip(r, -1.0, 1.0), np.nan)


def wide_correlation(df: DataFrame, names: Sequence[str], block: int = BLOCK) -> DataFrame:
    """Rows (a, b, r) of all ordered pairs of ``names`` over the rows where both are present.

    One scan takes the means (values are measured from them, so that large offsets cost no
    digits), one more per ``block`` columns their products: a task holds six sums for each of
    ``block`` times all columns. r is null where a side is constant, absent or infinite, and
    for all pairs of an empty table.
    """
    names, n = list(names), len(names)
    numbers = df.select(*[nan_to_null(column(c).cast("double")).alias(f"c{i}") for i, c in enumerate(names)])
    middle = numbers.agg(*[F.avg(f"c{i}").alias(f"c{i}") for i in range(n)]).first()
    near = [v if v is not None and np.isfinite(v) else 0.0 for v in middle]
    moved = numbers.select(*[(F.col(f"c{i}") - F.lit(v)).alias(f"c{i}") for i, v in enumerate(near)])
    # A row without sums for every column, so that an empty table has its pairs too.
    parts = df.sparkSession.range(n).select(F.col("id").cast("int").alias("i"), F.array().cast("array<double>").alias("sums"))
    for first in range(0, n, block):
        parts = parts.unionByName(moved.mapInArrow(_partial(first, min(first + block, n)), "i int, sums array<double>"))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, sums in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held = total.setdefault(i, np.zeros(6 * n))
                if len(sums.values):
                    held += sums.values.to_numpy()
        for i, sums in total.items():
            r = _coefficients(sums, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i]] * n), pa.array(names), pa.array(r, mask=~np.isfinite(r))], names=["a", "b", "r"]
            )

    return parts.repartition(max(1, min(64, n // 8)), "i").mapInArrow(added, "a string, b string, r double")
