"""Streaming forms: hourly roll-up with a watermark, drift check per micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidegauge.functions.names import column, require
from tidegauge.functions.values import nan_to_null
from tidegauge.operators.drift import Profile, alert_tier, psi_against

PSI_LIMIT = 0.2


def stream_rollup(
    stream: DataFrame,
    time: str,
    sums: Sequence[str] = (),
    means: Sequence[str] = (),
    maxes: Sequence[str] = (),
    window: str = "1 hour",
    lateness: str = "2 hours",
) -> DataFrame:
    """Window sums, means and maxima; a window is final once the watermark has passed.

    The time column becomes ``timestamp`` in the session zone, which a watermark needs.
    State holds one row per open window.
    """
    require(stream, [time, *sums, *means, *maxes])
    number = lambda c: nan_to_null(column(c).cast("double"))
    aggregates = [F.sum(number(c)).alias(c) for c in sums]
    aggregates += [F.avg(number(c)).alias(c) for c in means]
    aggregates += [F.max(number(c)).alias(c) for c in maxes]
    timed = stream.withColumn(time, column(time).cast("timestamp")).withWatermark(time, lateness)
    grouped = timed.groupBy(F.window(column(time), window).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), *aggregates
    )
    return grouped.select(F.col("w.start").alias("window_start"), "n", *[column(a) for a in (*sums, *means, *maxes)])


def monitor_batch(batch: DataFrame, profile: Profile, limit: float = PSI_LIMIT) -> DataFrame:
    """Stability index per column of one micro-batch, with the verdict of the batch."""
    rows = psi_against(profile, batch)
    # Values where the reference had none are drift; a column without any value has vanished.
    known = F.coalesce(F.col("psi") > limit, (F.col("n_reference") > 0) | (F.col("n_outside") > 0))
    rows = rows.withColumn("drifted", known)
    # One row per watched column.
    share = F.avg(F.col("drifted").cast("int")).over(Window.partitionBy(F.lit(0)))
    return rows.withColumn("share", share).withColumn("tier", alert_tier(F.col("share")))


def monitor_stream(
    stream: DataFrame, profile: Profile, path: str, limit: float = PSI_LIMIT
) -> DataStreamWriter:
    """Check every micro-batch against the profile and store the rows.

    A batch overwrites its own folder, so a batch that is run again after a failure leaves
    one copy of its rows.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        rows = monitor_batch(batch, profile, limit)
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(check)
