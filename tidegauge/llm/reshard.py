"""Resharding with the fewest bytes moved, by a minimum-cost flow.

The flow has one source per old shard (its bytes) and one sink per new shard (its capacity);
bytes that stay cost nothing, bytes that move cost one each. The network has as many nodes as
there are shards, so it is solved on the driver; documents never go there. Each old shard is a
line of bytes, cut into the blocks that the flow sends to each new shard. Only shards that
send or get a block are rewritten (``moved``): their documents go to a folder per shard, through
one shuffle; those of other shards stay where they are.

Contract: a null text has no bytes and a size of 1; null ids are placed like others; repeated
rows are separate rows; an empty table gives an empty result; equal texts are not kept
together, since one group may exceed a shard. Rows of a block keep no order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.numbering import running
from tidegauge.llm.store import cleaned, folder, written

SHARDS = 16


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Cheapest flow that sends all of ``supply`` within ``capacity`` (successive shortest paths)."""
    n, m = len(supply), len(capacity)
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    if sum(left) > sum(room):
        raise ValueError("the new shards are too small")
    while any(left):
        # Distances from all old shards with bytes left; going back along a flow refunds it.
        far = float("inf")
        old = [0 if x else far for x in left]
        new = [far] * m
        came_new, came_old = [-1] * m, [-1] * n
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    if old[i] + cost[i][j] < new[j]:
                        new[j], came_new[j], changed = old[i] + cost[i][j], i, True
                    if flow[i][j] and new[j] - cost[i][j] < old[i]:
                        old[i], came_old[i], changed = new[j] - cost[i][j], j, True
        end = min((j for j in range(m) if room[j]), key=lambda j: new[j])
        path, j, most = [], end, room[end]
        while True:
            i = came_new[j]
            path.append((i, j, 1))
            if came_old[i] < 0:
                break
            j = came_old[i]
            path.append((i, j, -1))
            most = min(most, flow[i][j])
        most = min(most, left[i])
        for a, b, sign in path:
            flow[a][b] += sign * most
        left[i] -= most
        room[end] -= most
    return flow


def sized(docs: DataFrame, key: str, text: str, old, *more) -> DataFrame:
    """One small row per document: its key, size in bytes, checksum and old shard."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        old.cast("int").alias("old_shard"),
        *more,
    )


def planned(rows: DataFrame, shards: int, capacity: list[int] | None) -> tuple[list[tuple[int, int, int, int]], int, int]:
    """Blocks (old shard, new shard, first byte, end) of the old shards' lines; rows of the
    largest old shard; a bound of those of a new one."""
    # One row per old shard.
    olds = {r["old_shard"]: (r["bytes"], r["n"]) for r in rows.groupBy("old_shard").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()}
    total = sum(b for b, _ in olds.values())
    most = max((n for _, n in olds.values()), default=0)
    # A shard whose number goes on to exist keeps what it may.
    names = sorted(olds)
    capacity = capacity or [total // shards + (j < total % shards) for j in range(shards)]
    flow = min_cost_flow([olds[i][0] for i in names], capacity, [[int(i != j) for j in range(shards)] for i in names])
    cuts = []
    for i, sent in zip(names, flow, strict=True):
        at = 0
        for j in sorted(range(shards), key=lambda j: (j != i, j)):
            if sent[j]:
                cuts.append((i, j, at, at + sent[j]))
                at += sent[j]
    return cuts, most, 2 * max(most, sum(n for _, n in olds.values()) // shards)


def _placed(rows: DataFrame, key: str, cuts: list[tuple[int, int, int, int]], most: int, counted: DataFrame | None = None) -> DataFrame:
    """Add ``shard``: that of the block which holds the middle of the row."""
    # At most shards x old shards rows.
    blocks = rows.sparkSession.createDataFrame(cuts, "_old int, shard int, _from long, _to long")
    line = running(rows, "old_shard", [key, "text_crc32", "size"], F.col("size"), most, "_at", counted)
    middle = F.col("_at") + (F.col("size") / 2).cast("long")
    return line.join(
        F.broadcast(blocks), (F.col("old_shard") == F.col("_old")) & (middle >= F.col("_from")) & (middle < F.col("_to"))
    ).drop("_old", "_from", "_to", "_at")


def _slots(rows: DataFrame, key: str, largest: int) -> DataFrame:
    return running(rows, "shard", [key, "text_crc32", "size"], F.lit(1).cast("long"), largest, "slot")


def reshard(rows: DataFrame, key: str, shards: int = SHARDS, capacity: list[int] | None = None) -> DataFrame:
    """Place rows of ``sized``; adds ``shard``, ``slot``. ``rows`` must be a stored table."""
    cuts, most, largest = planned(rows, shards, capacity)
    return _slots(_placed(rows, key, cuts, most), key, largest)


def moved(docs: DataFrame, key: str, text: str, old, path: str, shards: int = SHARDS, capacity: list[int] | None = None) -> DataFrame:
    """Move documents between shards: write those of all shards that send or get a block to
    ``path``, one folder per shard, and read back what every shard then holds.

    Returns rows of ``sized`` with ``shard`` and ``slot``; those of rewritten shards come from
    the written files. ``docs`` has no columns named ``shard`` or ``old_shard``.
    """
    spark = docs.sparkSession
    rows = written(sized(docs, key, text, old), "sizes")
    cuts, most, largest = planned(rows, shards, capacity)
    touched = sorted({shard for i, j, _, _ in cuts if i != j for shard in (i, j)})
    sent = sized(docs.filter(old.isin(touched)), key, text, old, F.struct(*docs.columns).alias("_whole"))
    sent = _placed(sent, key, cuts, most, rows.filter(F.col("old_shard").isin(touched))).select("_whole.*", "old_shard", "shard")
    with cleaned(spark):
        sent.write.partitionBy("shard").parquet(path)
    now = sized(spark.read.schema(sent.schema).parquet(path), key, text, F.col("old_shard"), "shard")
    stay = sized(docs.filter(~old.isin(touched)), key, text, old, old.cast("int").alias("shard"))
    return _slots(written(now.unionByName(stay), "placed"), key, largest)


def rewrite(docs: DataFrame, placed: DataFrame, key: str, path: str) -> None:
    """Write the documents of all shards that send or get a block, one folder per shard.

    Other shards' files stay as they are. ``key`` must name a row.
    """
    moved = placed.filter("shard <> old_shard")
    touched = moved.select(F.explode(F.array("shard", "old_shard")).alias("shard")).distinct()
    place = placed.join(touched, "shard", "left_semi").select(F.col(key).alias("_key"), "shard")
    out = docs.join(place, docs[key].eqNullSafe(place["_key"])).drop("_key")
    out.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def op4_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents``, which lie in one old shard per source hash, in 16 shards of near equal bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    old = F.pmod(F.xxhash64(F.col("source")), F.lit(SHARDS))
    return moved(docs, "doc_id", "text", old, folder(spark, "shards")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
    )
