"""Linear regression that also solves singular normal equations exactly.

A full set of category slots beside an intercept makes the normal equations singular. Spark's
solver then iterates until the gradient falls below 1e-8, which leaves residual sums that grow
with the rows. Here one pass gathers centred cross-products per partition, and the small system
is solved by its eigenvectors; of all exact solutions the one with the smallest coefficients
is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.names import column
from tidegauge.session import findable

#: Features up to which the cross-products are gathered here; beyond, Spark's solver is used.
MOST_FEATURES = 1_000
#: Blocks that the driver merges at most, and numbers of a batch that are multiplied at a time.
BLOCKS = 16
AT_ONCE = 1 << 20
#: Share of the largest eigenvalue below which a direction is taken as dependent on others.
DEPENDENT = 1e-12

Moments = tuple[float, np.ndarray, np.ndarray]


def _joined(a: Moments | None, b: Moments) -> Moments:
    """Rows, means and centred cross-products of two disjoint groups of rows."""
    if a is None:
        return b
    n = a[0] + b[0]
    shift = b[1] - a[1]
    return n, a[1] + shift * (b[0] / n), a[2] + b[2] + np.outer(shift, shift) * (a[0] * b[0] / n)


def _packed(found: Moments | None, width: int) -> pa.RecordBatch:
    whole = [] if found is None else [np.concatenate(([found[0]], found[1], found[2].ravel())).tobytes()]
    return pa.RecordBatch.from_arrays([pa.array(whole, pa.binary())], names=["part"])


def _unpacked(part: bytes, width: int) -> Moments:
    flat = np.frombuffer(part)
    return float(flat[0]), flat[1 : width + 1], flat[width + 1 :].reshape(width, width)


def cross_products(df: DataFrame, features: str, label: str, size: int) -> Moments | None:
    """Rows, means and centred cross-products of a vector of ``size`` numbers and the label."""
    width = size + 1
    findable(df.sparkSession)

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            step = max(1, AT_ONCE // width)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                x = np.column_stack((x, part.column(1).to_numpy(zero_copy_only=False)))
                mean = x.mean(axis=0)
                x = x - mean
                total = _joined(total, (float(len(x)), mean, x.T @ x))
        yield _packed(total, width)

    def merged(table: pa.Table) -> pa.Table:
        total = None
        for part in table.column("part"):
            total = _joined(total, _unpacked(part.as_py(), width))
        return pa.Table.from_batches([_packed(total, width)])

    rows = df.select(vector_to_array(column(features)).alias("x"), column(label).cast("double").alias("y"))
    parts = rows.mapInArrow(gathered, "part binary").groupBy(F.pmod(F.spark_partition_id(), F.lit(BLOCKS)).alias("block"))
    total = None
    # At most ``BLOCKS`` rows.
    for row in parts.applyInArrow(merged, "part binary").collect():
        total = _joined(total, _unpacked(bytes(row["part"]), width))
    return total


def least_squares(found: Moments, intercept: bool) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of the exact line; the shortest if several are exact."""
    n, mean, square = found
    if not np.isfinite(square).all():
        raise ValueError("features and label must not be null, NaN or infinite")
    if not intercept:
        square = square + n * np.outer(mean, mean)
    # A column whose spread is rounding error is constant.
    spread = np.sqrt(np.diag(square)[:-1])
    spread[spread <= 1e-13 * np.sqrt(n) * np.abs(mean[:-1])] = 0.0
    used = spread > 0
    scale = np.where(used, spread, 1.0)
    a = np.where(used[:, None] & used, square[:-1, :-1] / np.outer(scale, scale), 0.0)
    b = np.where(used, square[:-1, -1] / scale, 0.0)
    values, vectors = np.linalg.eigh(a)
    own = values > DEPENDENT * max(values.max(initial=0.0), 1e-300)
    basis, inverse = vectors[:, own], 1 / values[own]
    w = np.zeros(len(b))
    for _ in range(3):  # refined by what is left
        w = w + basis @ (inverse * (basis.T @ (b - a @ w)))
    w = w / scale
    free = vectors[:, ~own] / scale[:, None]
    if free.shape[1]:
        free = np.linalg.qr(free)[0]
        w = w - free @ (free.T @ w)
    return w, float(mean[-1] - mean[:-1] @ w) if intercept else 0.0


class LeastSquares(LinearRegression):
    """``LinearRegression`` whose plain fits are exact; the model is the ordinary one."""

    def _fit(self, dataset: DataFrame) -> LinearRegressionModel:
        plain = self.getRegParam() == 0 and self.getSolver() in ("auto", "normal") and self.getLoss() == "squaredError"
        first = dataset.select(column(self.getFeaturesCol())).first() if plain and not self.isDefined("weightCol") else None
        if first is None or first[0].size > MOST_FEATURES:
            return super()._fit(dataset)
        size = first[0].size
        found = cross_products(dataset, self.getFeaturesCol(), self.getLabelCol(), size)
        w, b = least_squares(found, self.getFitIntercept())
        # The line through size + 1 points off any common plane, as far apart as the rows, is the model itself.
        far = np.sqrt(np.diag(found[2])[:-1] / found[0] + found[1][:-1] ** 2)
        far = np.where(far > 0, far, 1.0)
        points = [(Vectors.sparse(size, {}), b), *((Vectors.sparse(size, {i: float(far[i])}), b + float(w[i] * far[i])) for i in range(size))]
        return super()._fit(dataset.sparkSession.createDataFrame(points, [self.getFeaturesCol(), self.getLabelCol()]))
