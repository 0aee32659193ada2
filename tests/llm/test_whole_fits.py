"""Models are fitted on all rows that they may learn from, not on a sample."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidegauge.llm import quality, toxicity
from tidegauge.llm.newton import logistic, scaled, totals


def last_by_hash(spark, n: int, rare: int):
    """``n`` ids; ``late`` tells the ``rare`` last ones in the order of the former sample."""
    ids = spark.range(n).select(F.col("id").alias("doc_id"), F.pmod(F.xxhash64("id"), F.lit(2**40)).alias("place"))
    bound = sorted(r.place for r in ids.collect())[-rare]
    return ids.withColumn("late", F.col("place") >= bound)


def test_totals_and_logistic_over_partitions(spark):
    rng = np.random.default_rng(3)
    x, y = rng.standard_normal((900, 2)), rng.random(900) < 0.4
    rows = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y, strict=True)], "a double, b double, y double").repartition(5)

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        return np.stack([batch.column(c).to_numpy() for c in ("a", "b", "y")], axis=1)

    assert np.allclose(totals(rows, lambda batch: matrix(batch).sum(axis=0), 3), [*x.sum(axis=0), y.sum()])
    assert totals(rows.limit(0), lambda batch: matrix(batch).sum(axis=0), 3).tolist() == [0, 0, 0]
    (w,) = logistic(rows, lambda batch: [(matrix(batch)[:, :2], matrix(batch)[:, 2], np.ones(batch.num_rows))], [np.zeros(3)], scaled(1e-3))
    full = np.hstack((x, np.ones((900, 1))))
    slope = full.T @ (y - 1 / (1 + np.exp(-full @ w))) - np.array([0.9, 0.9, 1e-6]) * w
    assert np.abs(slope).max() < 0.01


def test_quality_learns_from_every_label(spark):
    # Only labels behind the first 6,000 by hash tell that this text is bad.
    ids = last_by_hash(spark, 8000, 1500)
    plain = F.when(F.col("doc_id") % 10 == 0, "xyxyxyxy").otherwise("abcdabcd")
    docs = ids.select("doc_id", F.when(F.col("late"), "zqzqzqzq").otherwise(plain).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(8).alias("n_chars"))
    labels = docs.select("doc_id", (F.col("text") == "abcdabcd").cast("int").alias("quality"))
    left = {r.text: r["count"] for r in quality.kept(docs, labels).groupBy("text").count().collect()}
    assert set(left) == {"abcdabcd"}


def test_toxicity_learns_from_every_label(spark):
    # Only labels behind the first 20,000 by hash have this word.
    ids = last_by_hash(spark, 30000, 1500).withColumn("toxic", (F.col("late") & (F.col("doc_id") % 2 == 0)).cast("int"))
    filler = F.concat(F.col("doc_id").cast("string"), F.lit(" plain words"))
    docs = ids.select("doc_id", F.when(F.col("toxic") == 1, F.concat(filler, F.lit(" vrazzle "), filler)).otherwise(filler).alias("text"))
    found, _ = toxicity.train(toxicity.labelled(docs, ids, "doc_id", "text", "toxic"))
    assert (b"vrazzle", False) in found
