"""Length buckets that pad least, and batches of a token budget inside them.

The global histogram of lengths goes to the driver: lengths up to 2^16 as they are, longer ones
rounded up to 16 significant bits, so it has at most about 100,000 rows for texts below 2^32
tokens. A dynamic program over it finds the boundaries with the least padding; because the cost of a
bucket is its boundary times a count, each layer is a lower envelope of lines and takes one
pass.

Contract: null and empty texts have the length of the end mark alone; a text longer than the
budget makes a batch of its own; ties between boundaries fall to the fewer and smaller ones;
repeated rows are packed separately; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.numbering import running
from tidegauge.llm.store import written

BUCKETS = 12
BUDGET = 16_384
EXACT_BITS = 16


def tokens(text):
    """Words between white space plus one end mark."""
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")


def coarse(length):
    """Round lengths above 2^16 up to 16 significant bits."""
    step = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), F.floor(F.log2(length.cast("double"))) - EXACT_BITS + 1))
    return (F.ceil(length / step) * step).cast("long")


def boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` buckets that minimise the padding over the histogram.

    Padding of lengths ``i..j`` is ``v[j] * (C[j] - C[i - 1])`` less a constant, so the best
    start for ``v[j]`` lies on a lower envelope of lines with slopes ``-C[i - 1]``.
    """
    values = sorted(histogram)
    if not values:
        return []
    count = [0]
    for v in values:
        count.append(count[-1] + histogram[v])
    n = len(values)
    best = [0] + [None] * n  # best[j]: least padded total of the first j lengths
    back: list[list[int]] = []
    totals = []
    for _ in range(min(buckets, n)):
        hull: list[tuple[int, int, int]] = []  # slope, intercept, start
        top, now, came = 0, [None] * (n + 1), [0] * (n + 1)
        for j in range(1, n + 1):
            if best[j - 1] is not None:
                m, b = -count[j - 1], best[j - 1]
                while len(hull) >= 2 and (b - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - m):
                    hull.pop()
                hull.append((m, b, j - 1))
            if not hull:
                continue
            v, top = values[j - 1], min(top, len(hull) - 1)
            while len(hull) - top >= 2 and hull[top + 1][0] * v + hull[top + 1][1] < hull[top][0] * v + hull[top][1]:
                top += 1
            m, b, i = hull[top]
            now[j], came[j] = m * v + b + v * count[j], i
        best = now
        back.append(came)
        totals.append(now[n])
    k = min((k for k in range(len(totals)) if totals[k] is not None), key=lambda k: (totals[k], k))
    ends, j = [], n
    for layer in range(k, -1, -1):
        ends.append(values[j - 1])
        j = back[layer][j]
    return sorted(ends)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """One row per document: key, n_tokens, bucket, bucket_tokens, batch, slot, padding."""
    rows = docs.select(F.col(key), tokens(F.col(text)).alias("n_tokens"))
    rows = written(rows.withColumn("_length", coarse(F.col("n_tokens"))), "lengths")
    histogram = {r["_length"]: r["count"] for r in rows.groupBy("_length").count().collect()}
    ends = boundaries(histogram, buckets)
    # A bucket's number is how many buckets end below the length.
    upper = F.array(*[F.lit(end) for end in ends]) if ends else F.array().cast("array<bigint>")
    placed = rows.withColumn("bucket", F.size(F.filter(upper, lambda end: end < F.col("_length"))))
    placed = placed.withColumn("bucket_tokens", F.get(upper, F.col("bucket")))
    placed = placed.withColumn("_capacity", F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_tokens"))))
    most = max((sum(c for v, c in histogram.items() if bisect_left(ends, v) == i) for i in range(len(ends))), default=0)
    at = running(placed, "bucket", [key, "n_tokens"], F.lit(1).cast("long"), most, "_at")
    return at.select(
        key,
        "n_tokens",
        "bucket",
        "bucket_tokens",
        F.floor(F.col("_at") / F.col("_capacity")).alias("batch"),
        (F.col("_at") % F.col("_capacity")).alias("slot"),
        (F.col("bucket_tokens") - F.col("n_tokens")).alias("padding"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of at most 16,384 padded tokens for all of ``documents``."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
