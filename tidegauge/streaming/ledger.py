"""Event-time windows of a stream with every row accounted for.

Each micro-batch is reduced to partial results per window, which add up, and written to a
folder of its own number; so are its largest event time and the rows that came too late. A
batch that is run again after a failure overwrites its own folders and sees the same
watermark, which follows from the batches before it. A row is either in a window or in the
table of late rows; the windows that the watermark has passed are final, and at the end of a
stream the rest can be taken too. What a batch stores is a row per window (and column), so
hot windows are pre-aggregated where their rows are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidegauge.functions.names import column, require
from tidegauge.functions.values import nan_to_null
from tidegauge.operators.drift import Profile, alert_tier, bucket_counts, psi_of_counts

START = "window_start"


@dataclass(frozen=True)
class Ledger:
    """Partial results of the windows of ``time`` under ``path``.

    ``partial`` reduces rows that have a ``window_start`` to one row, or a few, per window.
    """

    path: str
    time: str
    partial: Callable[[DataFrame], DataFrame]
    window: str = "1 hour"
    lateness: str = "2 hours"

    def _at(self, name: str, batch_id: int) -> str:
        return f"{self.path.rstrip('/')}/{name}/batch_id={batch_id}"

    def _table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.path.rstrip('/')}/{name}")

    def watermark(self, spark: SparkSession, before: int | None = None):
        """Time up to which rows are final, after all batches or those ``before`` one."""
        if before == 0:
            return None
        seen = self._table(spark, "seen")
        seen = seen if before is None else seen.filter(F.col("batch_id") < before)
        # A row per batch.
        return seen.agg((F.max("high") - F.expr(f"INTERVAL {self.lateness}")).alias("w")).first()["w"]

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """Account for one micro-batch."""
        require(batch, [self.time])
        spark = batch.sparkSession
        mark = self.watermark(spark, batch_id)
        moment = column(self.time).cast("timestamp")
        # A window is made of times only: rows without one are counted by themselves.
        rows = batch.filter(moment.isNotNull()).withColumn(START, F.window(moment, self.window)["start"])
        end = F.col(START) + F.expr(f"INTERVAL {self.window}")
        late = F.lit(False) if mark is None else end <= F.lit(mark)
        self.partial(rows.filter(~late)).write.mode("overwrite").parquet(self._at("parts", batch_id))
        counted = F.count(F.lit(1)).alias("n_late")
        untimed = batch.filter(moment.isNull()).select(F.lit(None).cast("timestamp").alias(START)).groupBy(START).agg(counted)
        behind = rows.filter(late).groupBy(START).agg(counted).unionByName(untimed)
        behind.write.mode("overwrite").parquet(self._at("late", batch_id))
        # The next batches' watermark appears last: a batch without it is run again as a whole.
        batch.agg(F.max(moment).alias("high")).write.mode("overwrite").parquet(self._at("seen", batch_id))

    def start(self, stream: DataFrame) -> DataStreamWriter:
        return stream.writeStream.foreachBatch(self.take)

    def late(self, spark: SparkSession) -> DataFrame:
        """Rows that came behind the watermark, per window; without a time the window is null."""
        return self._table(spark, "late").groupBy(START).agg(F.sum("n_late").alias("n_late"))

    def parts(self, spark: SparkSession, flush: bool = False) -> DataFrame:
        """Partial rows of final windows, or of all windows at the end of the stream."""
        found = self._table(spark, "parts").drop("batch_id")
        if flush:
            return found
        mark = self.watermark(spark)
        end = F.col(START) + F.expr(f"INTERVAL {self.window}")
        return found.filter(F.lit(False) if mark is None else end <= F.lit(mark))


def _number(name: str) -> Column:
    return nan_to_null(column(name).cast("double"))


@dataclass(frozen=True)
class Rollup:
    """Sums, means and maxima per window, as ``live.stream_rollup``, with late rows counted."""

    ledger: Ledger
    sums: tuple[str, ...]
    means: tuple[str, ...]
    maxes: tuple[str, ...]

    @staticmethod
    def of(path: str, time: str, sums: Sequence[str] = (), means: Sequence[str] = (), maxes: Sequence[str] = (), window: str = "1 hour", lateness: str = "2 hours") -> Rollup:
        made = [F.sum(_number(c)).alias(f"s{i}") for i, c in enumerate(sums)]
        for i, c in enumerate(means):
            made += [F.sum(_number(c)).alias(f"t{i}"), F.count(_number(c)).alias(f"k{i}")]
        made += [F.max(_number(c)).alias(f"m{i}") for i, c in enumerate(maxes)]

        def partial(rows: DataFrame) -> DataFrame:
            return rows.groupBy(START).agg(F.count(F.lit(1)).alias("n"), *made)

        return Rollup(Ledger(path, time, partial, window, lateness), tuple(sums), tuple(means), tuple(maxes))

    def windows(self, spark: SparkSession, flush: bool = False) -> DataFrame:
        merged = [F.sum("n").alias("n")]
        merged += [F.sum(f"s{i}").alias(c) for i, c in enumerate(self.sums)]
        merged += [(F.sum(f"t{i}") / F.nullif(F.sum(f"k{i}"), F.lit(0).cast("bigint"))).alias(c) for i, c in enumerate(self.means)]
        merged += [F.max(f"m{i}").alias(c) for i, c in enumerate(self.maxes)]
        return self.ledger.parts(spark, flush).groupBy(START).agg(*merged)


@dataclass(frozen=True)
class WindowMonitor:
    """Drift of each event-time window against a stored profile.

    Bucket counts add up over micro-batches, so the verdict on a window does not depend on how
    the stream was cut.
    """

    ledger: Ledger
    profile: Profile
    limit: float

    @staticmethod
    def of(path: str, profile: Profile, time: str, window: str = "1 day", lateness: str = "2 hours", limit: float = 0.2) -> WindowMonitor:
        def partial(rows: DataFrame) -> DataFrame:
            require(rows, profile.columns)
            # A row with ix null stands for the window itself, which may have no values.
            every = rows.groupBy(START).agg(F.count(F.lit(1)).alias("n"))
            counts = bucket_counts(profile, rows, [START])
            return counts.unionByName(every.select(START, F.lit(None).cast("int").alias("ix"), F.lit(None).cast("int").alias("bucket"), "n"))

        return WindowMonitor(Ledger(path, time, partial, window, lateness), profile, limit)

    def verdicts(self, spark: SparkSession, flush: bool = False) -> DataFrame:
        """Rows of ``psi_against`` per window and column, ``drifted``, and share and tier of the window."""
        parts = self.ledger.parts(spark, flush)
        counts = parts.filter("ix IS NOT NULL").groupBy(START, "ix", "bucket").agg(F.sum("n").alias("n"))
        rows = psi_of_counts(self.profile, counts, parts.select(START).distinct(), [START])
        drifted = F.coalesce(F.col("psi") > self.limit, (F.col("n_reference") > 0) | (F.col("n_outside") > 0))
        rows = rows.withColumn("drifted", drifted)
        shares = rows.groupBy(START).agg(F.avg(F.col("drifted").cast("int")).alias("share"))
        return rows.join(shares, START).withColumn("tier", alert_tier(F.col("share")))
