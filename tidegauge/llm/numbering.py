"""Gapless numbers within a few large groups, without one task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block, about; a block is what one window sorts.
BLOCK_ROWS = 20_000
#: Blocks of a group at least, so that small tables are spread as well.
LEAST_BLOCKS = 64


def blocks(rows: int) -> int:
    """Number of blocks that a group of at most ``rows`` rows is cut into."""
    return max(LEAST_BLOCKS, -(-rows // BLOCK_ROWS))


def running(df: DataFrame, group: str, order: list[str], amount, rows: int, name: str, counted: DataFrame | None = None) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over the rows before this one in its group.

    The rows of a group are ordered by a hash block of ``order``, then by ``order``. Every
    block is summed on its own; block totals, far fewer than rows, give the offsets. They come
    from ``counted`` if it is given: the same rows in a stored table without the wide columns.
    """

    def in_blocks(of: DataFrame) -> DataFrame:
        return of.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks(rows)))).withColumn("_amount", amount)

    cut = in_blocks(df)
    totals = (cut if counted is None else in_blocks(counted)).groupBy(group, "_block").agg(F.sum("_amount").alias("_total"))
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(group, "_block", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(group, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("_inside", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
    return cut.join(totals, [group, "_block"]).withColumn(name, F.col("_offset") + F.col("_inside")).drop(
        "_block", "_amount", "_offset", "_inside"
    )
