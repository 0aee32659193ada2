"""Merkle manifest of a table: a digest per row, per group and of the whole.

Every row is a leaf; the leaves of a group, in order of their key, make a tree, and the roots of
the groups make one more tree above them. A level is one equijoin of its nodes with themselves:
each node looks up the computed indices of its siblings (index XOR 1 in binary trees, slot
offsets modulo the arity otherwise), and the rows at slot zero emit the parents. Texts never
leave the task that reads them; what is shuffled are 32-byte digests, half as many rows at each
level. Positions come from a range partitioning and one offset per partition, so neither a
group that holds most rows nor one repeated key meets in one task.

Going down again, a row learns its siblings up to the root from its parent. With them any leaf
can be checked against the root alone.

Contract: fields are hashed as ``-`` (null) or UTF-8 byte count, ``:``, value, so empty and null
differ and no two rows run together; texts of any length are hashed whole; null keys come
first; rows that share a key are ordered by their leaf, and repeated rows, whose leaves are
equal, get neighbouring places; a null group is a group of its own and comes first; an empty
table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm.store import written
from tidegauge.session import broadcast_if_small

#: Fields of a leaf of ``documents``, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bytes of one step of a path: up to ``arity - 1`` digests and their frame.
STEP_BYTES = 96
#: Levels up to this many bytes are sent to all tasks on the way down.
SENT_BYTES = 8 << 20


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256."""
    return F.sha2(text, 256)


def shown(digests: Column) -> Column:
    """Concatenated digests as lower-case hex; null is none."""
    return F.coalesce(F.lower(F.hex(digests)), F.lit(""))


def field(value: Column) -> Column:
    """One field of a leaf: ``-`` for null, else its length in bytes and its text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def placed(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Rows with ``at``, their gapless position in ``order``; equal rows stand in any order.

    The table is written sorted by ranges; a position is the row number in its range plus the
    rows of the ranges before it, of which there are as many as shuffle partitions.
    """
    spread = df.withColumn("_tie", F.monotonically_increasing_id())
    spread = spread.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    rows = written(spread.withColumn("_at", F.monotonically_increasing_id()), name)
    rows = rows.withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("_part").agg(F.count("*").alias("_rows"))
    bases = bases.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    return rows.join(F.broadcast(bases), "_part").withColumn("at", F.col("_base") + F.col("_at")).drop("_part", "_base", "_at")


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes with the digests of their run's other members: those ``before`` and ``after``."""
    slot = F.col("idx") % arity
    if arity == 2:
        others = nodes.select("tree", F.col("idx").bitwiseXOR(F.lit(1)).alias("idx"), F.col("digest").alias("_other"))
        joined = nodes.join(others, ["tree", "idx"], "left")
        return joined.select(
            "tree",
            "idx",
            "n",
            "digest",
            F.when(slot == 1, F.col("_other")).alias("before"),
            F.when(slot == 0, F.col("_other")).alias("after"),
        )
    joined = nodes
    for step in range(1, arity):
        # The node that looks ``step`` slots on, round its run.
        looking = F.col("idx") - slot + (slot - step + arity) % arity
        joined = joined.join(nodes.select("tree", looking.alias("idx"), F.col("digest").alias(f"_{step}")), ["tree", "idx"], "left")
    none = F.lit(b"")

    def member(at: int) -> Column:
        found = [F.when((slot + step) % arity == at, F.col(f"_{step}")) for step in range(1, arity)]
        return F.coalesce(*found, none)

    def those(keep) -> Column:
        return F.concat(*[F.when(keep(at), member(at)).otherwise(none) for at in range(arity)])

    return joined.select("tree", "idx", "n", "digest", those(lambda at: slot > at).alias("before"), those(lambda at: slot < at).alias("after"))


def climb(leaves: DataFrame, largest: int, arity: int, name: str) -> list[DataFrame]:
    """Tables of all levels (tree, idx, n, digest, before, after), from ``leaves`` up.

    ``n`` is the number of nodes of the tree at that level; a tree ends where it is one.
    """
    out, nodes = [], leaves.select("tree", "idx", "n", "digest")
    while True:
        level = written(_with_siblings(nodes, arity), name)
        out.append(level)
        if largest <= 1:
            return out
        largest = -(-largest // arity)
        run = F.concat(shown(F.col("before")), shown(F.col("digest")), shown(F.col("after")))
        nodes = level.filter((F.col("n") > 1) & (F.col("idx") % arity == 0)).select(
            "tree",
            F.floor(F.col("idx") / arity).alias("idx"),
            F.ceil(F.col("n") / arity).alias("n"),
            F.unhex(digest(run)).alias("digest"),
        )


def roots(levels: Sequence[DataFrame]) -> DataFrame:
    """tree and digest of its root."""
    ends = [level.filter("n = 1").select("tree", "digest") for level in levels]
    return reduce(DataFrame.unionByName, ends)


def paths(levels: Sequence[DataFrame], rows: int, trees: int, arity: int) -> DataFrame:
    """tree, idx and ``path`` of every leaf: siblings at each level, from below."""
    above = None
    for up in range(len(levels) - 1, -1, -1):
        step = F.array(F.struct("before", "after"))
        level = levels[up]
        if above is None:
            above = level.select("tree", "idx", F.slice(step, 1, 0).alias("path"))
            continue
        held = -(-rows // arity ** (up + 1)) + trees
        size = STEP_BYTES * (arity - 1) * (len(levels) - up)
        parents = above.select("tree", F.col("idx").alias("_up"), F.col("path").alias("_path"))
        if held * size <= SENT_BYTES:
            parents = F.broadcast(parents)
        joined = level.withColumn("_up", F.floor(F.col("idx") / arity)).join(parents, ["tree", "_up"], "left")
        # A root has no parent row: its path is empty.
        path = F.when(F.col("_path").isNull(), F.slice(step, 1, 0)).otherwise(F.concat(step, F.col("_path")))
        above = joined.select("tree", "idx", path.alias("path"))
    return above


def folded(start: Column, path: Column) -> Column:
    """Root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, step: digest(F.concat(shown(step["before"]), node, shown(step["after"]))))


def proof(path: Column) -> Column:
    """Digest of all siblings of a path."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(shown(step["before"]), shown(step["after"]))), ""))


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    key: str = "doc_id",
    group: str = "lang",
    arity: int = 2,
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: key, group, leaf, subroot, root, path, and what ``carry`` names.

    ``carry`` holds expressions over ``docs``; they are evaluated where the row is read.
    """
    if arity < 2:
        raise ValueError("a run has two nodes or more")
    carry = dict(carry or {})
    kept = [e.alias(f"carry_{i}") for i, e in enumerate(carry.values())]
    rows = docs.select(
        F.col(group).alias("grp"),
        F.col(key).alias("key"),
        F.unhex(leaf([F.col(f) for f in fields])).alias("digest"),
        *kept,
    )
    order = [F.col("grp").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("digest").asc()]
    rows = placed(rows, order, "leaves")
    sizes = rows.groupBy("grp").agg(F.min("at").alias("start"), F.count("*").alias("n"))
    trees = placed(sizes, [F.col("grp").asc_nulls_first()], "trees").withColumnRenamed("at", "tree")
    count, largest, total = trees.agg(F.count("*"), F.max("n"), F.sum("n")).first()
    trees = trees.withColumnRenamed("grp", "_grp")
    leaves = rows.join(broadcast_if_small(trees, count, 256), F.col("grp").eqNullSafe(F.col("_grp")))
    leaves = leaves.withColumn("idx", F.col("at") - F.col("start")).drop("_grp", "at", "start")
    if count > 1:
        leaves = written(leaves, "places")
    low = climb(leaves, largest or 0, arity, "level")
    top = roots(low).select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(count).cast("long").alias("n"), "digest")
    high = climb(top, count, arity, "crown")
    crown = high[0].select("tree", "idx", "digest").join(paths(high, count, 1, arity).withColumnRenamed("path", "top"), ["tree", "idx"])
    whole = roots(high).withColumnRenamed("digest", "whole")
    ends = crown.join(F.broadcast(whole), "tree").select(F.col("idx").alias("tree"), F.col("digest").alias("sub"), "top", "whole")
    ends = broadcast_if_small(written(ends, "ends"), count, 256 + STEP_BYTES * (arity - 1) * len(high))
    climbed = paths(low, total or 0, count, arity)
    found = leaves.join(climbed, ["tree", "idx"]).join(ends, "tree")
    return found.select(
        F.col("key").alias(key),
        F.col("grp").alias("tree_of"),
        shown(F.col("digest")).alias("leaf"),
        shown(F.col("sub")).alias("subroot"),
        shown(F.col("whole")).alias("root"),
        F.concat("path", "top").alias("path"),
        *[F.col(f"carry_{i}").alias(name) for i, name in enumerate(carry)],
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of ``documents`` and its check after some rows were tampered with."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    seen = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    offered = F.unhex(leaf([seen if f == "n_chars" else F.col(f) for f in FIELDS]))
    found = manifest(docs, carry={"offered": offered})
    found = found.withColumn("folded_root", folded(shown(F.col("offered")), F.col("path")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


SQL = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail,
         xor(4294967295, list_reduce(
           list_prepend(4294967295, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0]))),
           lambda r, b: CASE WHEN xor(r, b) & 1 = 1 THEN xor(xor(r, b) >> 1, 3988292384) ELSE xor(r, b) >> 1 END)) AS crc
  FROM (SELECT doc_id::BIGINT AS doc_id, source, lang, n_chars::BIGINT AS n_chars, text FROM documents)
), leaves AS (
  SELECT doc_id, lang,
         sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || coalesce(strlen((n_chars + (crc % 7 = 0)::BIGINT)::VARCHAR) || ':' || (n_chars + (crc % 7 = 0)::BIGINT), '-') || tail) AS offered
  FROM fields
), low AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
  FROM leaves
), nodes AS (
  SELECT tree, 0 AS lvl, idx, n, leaf AS digest FROM low
  UNION ALL
  SELECT tree, lvl + 1, idx // 2, any_value((n + 1) // 2), sha256(string_agg(digest, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY tree, lvl, idx // 2
), subs AS (
  SELECT tree, digest AS subroot, tree AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1
), crown AS (
  SELECT 0 AS lvl, idx, n, subroot AS digest FROM subs
  UNION ALL
  SELECT lvl + 1, idx // 2, any_value((n + 1) // 2), sha256(string_agg(digest, '' ORDER BY idx))
  FROM crown WHERE n > 1 GROUP BY lvl, idx // 2
), up AS (
  SELECT doc_id, tree, idx AS at, n AS left_n, 0 AS lvl, FALSE AS above, offered AS node, '' AS proof FROM low
  UNION ALL
  SELECT u.doc_id, u.tree, CASE WHEN u.left_n = 1 THEN u.tree ELSE u.at // 2 END,
         CASE WHEN u.left_n = 1 THEN (SELECT count(*) FROM subs) ELSE (u.left_n + 1) // 2 END,
         CASE WHEN u.left_n = 1 THEN 0 ELSE u.lvl + 1 END, u.above OR u.left_n = 1,
         CASE WHEN u.left_n = 1 THEN u.node
              WHEN u.at % 2 = 0 THEN sha256(u.node || coalesce(s.digest, c.digest, '')) ELSE sha256(coalesce(s.digest, c.digest, '') || u.node) END,
         CASE WHEN u.left_n = 1 THEN u.proof ELSE u.proof || coalesce(s.digest, c.digest, '') END
  FROM up u
  LEFT JOIN nodes s ON NOT u.above AND u.left_n > 1 AND s.tree = u.tree AND s.lvl = u.lvl AND s.idx = xor(u.at, 1)
  LEFT JOIN crown c ON u.above AND u.left_n > 1 AND c.lvl = u.lvl AND c.idx = xor(u.at, 1)
  WHERE NOT (u.above AND u.left_n = 1)
)
SELECT l.doc_id, l.leaf, s.subroot, r.digest AS root, sha256(u.proof) AS proof_sha256, u.node AS folded_root, u.node = r.digest AS verified
FROM low l JOIN subs s USING (tree) JOIN (SELECT digest FROM crown WHERE n = 1) r ON TRUE
JOIN (SELECT * FROM up WHERE above AND left_n = 1) u ON u.doc_id IS NOT DISTINCT FROM l.doc_id
"""
