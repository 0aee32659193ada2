"""Logistic models fitted on all rows of a table.

Each Newton step is one pass: every partition adds up gradient and curvature of its own rows,
Spark adds up the partitions, and the driver solves for as many unknowns as a model has weights.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidegauge.llm.store import cleaned

#: Rows that are added up at a time, numbers of a part of the sum, most steps.
ROWS = 1024
PART = 1 << 14
STEPS = 25
#: A fit ends once a step promises less than this of the mean loss.
ENOUGH = 1e-6

Examples = list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def totals(rows: DataFrame, part: Callable[[pa.RecordBatch], np.ndarray], n: int) -> np.ndarray:
    """Sum of the ``n`` numbers that ``part`` makes of a batch, over all rows."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                total += part(batch.slice(at, ROWS))
        if total.any():
            at = range(0, n, PART)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([total[a : a + PART].tobytes() for a in at], pa.binary())], names=["at", "part"])

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p.as_buffer()) for p in table.column("part"))
        return pa.table({"at": table.column("at")[:1], "part": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(n)
    # As many rows as the sum has parts.
    with cleaned(rows.sparkSession):
        parts = rows.mapInArrow(own, "at int, part binary").groupBy("at").applyInArrow(added, "at int, part binary").collect()
    for r in parts:
        some = np.frombuffer(r["part"])
        out[r["at"] : r["at"] + len(some)] = some
    return out


def logistic(rows: DataFrame, examples: Callable[[pa.RecordBatch], Examples], start: list[np.ndarray], penalty: Callable[[int, float], np.ndarray]) -> list[np.ndarray]:
    """Weights of logistic models, the intercept last; all models take their steps in the same passes.

    ``examples`` gives features, classes and weights of a batch for each model, ``penalty`` the
    ridge of each weight by the number of weights and the total weight of the examples.
    """
    models = [np.asarray(w, dtype=float) for w in start]
    ends = np.cumsum([len(w) * (len(w) + 1) // 2 + len(w) + 1 for w in models])

    for _ in range(STEPS):

        def part(batch: pa.RecordBatch, models=tuple(models)) -> np.ndarray:
            out = []
            for (x, y, weight), w in zip(examples(batch), models, strict=True):
                use = weight > 0
                x = np.hstack((x[use], np.ones((int(use.sum()), 1), dtype=x.dtype)))
                y, weight = y[use], weight[use]
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                bent = x * np.sqrt(weight * np.maximum(p * (1 - p), 1e-4)).astype(x.dtype)[:, None]
                out += [(bent.T @ bent)[np.triu_indices(len(w))], (weight * (y - p)) @ x, [weight.sum()]]
            return np.concatenate(out)

        done = True
        sums = np.split(totals(rows, part, int(ends[-1])), ends[:-1])
        for k, (own, w) in enumerate(zip(sums, models, strict=True)):
            h = np.zeros((len(w), len(w)))
            h[np.triu_indices(len(w))] = own[: -len(w) - 1]
            ridge = penalty(len(w), own[-1])
            g = own[-len(w) - 1 : -1] - ridge * w
            step = np.linalg.solve(h + np.triu(h, 1).T + np.diag(ridge), g)
            models[k] = w + step
            done &= bool(g @ step <= ENOUGH * own[-1])
        if done:
            break
    return models


def scaled(ridge: float) -> Callable[[int, float], np.ndarray]:
    """A ridge that grows with the examples and leaves the intercept out."""
    return lambda n, weight: np.append(np.full(n - 1, ridge * weight), 1e-6)
