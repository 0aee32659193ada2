"""Exact Jaccard join on word n-grams: a size-aware heavy-light join.

Documents with equal sets are one *node*. Two nodes of sizes ``s`` and ``t`` link when they
share ``need(s, t)`` shingles.

* **Light** sets (few shingles) list their subsets: for each size a partner may have, all
  subsets of the size that both must share. Two sets of the right sizes under one subset are
  linked; no check is needed.
* **Heavy** sets stand in inverted lists, under the first shingles of their hash order, and
  from 40 shingles on under whole *blocks* of shingles (hash classes of 2.5 to 5 each): two
  linked sets differ in fewer shingles than there are blocks, so some block is the same. A
  list under a block holds sets that agree in all of it, so that a passage that very many
  documents share does not make a list. Two sets might agree in empty blocks only; then both
  have no more full blocks than linked sets may differ in, and all such sets stand under
  their first shingles besides. So no link is lost up to 64 blocks (below 225 shingles at
  0.8, 319 at 0.85). Of more blocks the first 96 are listed: at the threshold a block is the
  same and not empty with a chance of 0.39 or more, so none is with one of 3e-21 at most,
  less than that of two equal 64-bit hashes (5e-20).
* The boundary between both is the size from which the subsets of a set cost more than its
  places in lists, each of which may lead to a check.

Lists are scanned in two steps, without making all pairs of a list. First every member is
checked against the list's *pivot*, the member with the most company over all its lists. Only
lists whose members still lie in several components are scanned further, by their members'
rarest shingles: a pair is checked where the place of a common shingle in both orders leaves
room for enough others.

Contract: null and empty texts have no set (size 0) and link with nothing; texts of fewer
words than a shingle are one shingle; repeated rows are linked; ids may be null (nulls are
larger than all); an empty table gives an empty result; other columns are ignored. Shingles
and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.graph import components
from tidegauge.llm.store import checkpointed, dropped, written
from tidegauge.llm.words import BLANKS, lists, long_column, mix, spans, split
from tidegauge.session import broadcast_if_small

WORDS = 4
PERCENT = 85
BLOCKED = 40
BLOCKS = 96
#: At the lower end of a level linked sets differ in up to this share of the blocks, at the
#: upper end in up to twice of it.
SPREAD = 0.44
#: A place in a list counts as this many subsets.
LIST_COST = 8


def need(s: int, t: int, percent: int) -> int:
    """Shingles that sets of these sizes must share: 100 i >= percent (s + t - i)."""
    return -(-percent * (s + t) // (100 + percent))


def partners(s: int, percent: int) -> range:
    """Sizes that a set of size ``s`` may link with."""
    return range(-(-percent * s // 100), 100 * s // percent + 1)


def prefix(s: int, percent: int) -> int:
    """So many first shingles of any common order hold one that both sets have."""
    return s - -(-percent * s // 100) + 1


def boundary(percent: int) -> int:
    """Largest size up to which listing subsets costs less than places in inverted lists."""
    s = 1
    while sum(comb(s, need(s, t, percent)) for t in partners(s, percent)) <= LIST_COST * prefix(s, percent):
        s += 1
    return s - 1


def shingles(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per slice: first row, rows and sorted distinct shingle hashes (by row, then hash), row count."""
    for words in split(texts, BLANKS, lower=True):
        code, count = words.hashes(), np.diff(words.first)
        full = np.maximum(count - n + 1, 0)
        start = np.repeat(words.first[:-1], full) + np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
        short = np.flatnonzero((count > 0) & (count < n))
        start = np.concatenate((start, words.first[short]))
        end = np.concatenate((start[: full.sum()] + n, words.first[short + 1]))
        row = np.concatenate((np.repeat(np.arange(words.rows), full), short))
        value = spans(code, start, end)
        order = np.lexsort((value, row))
        row, value = row[order], value[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        yield words.row0, words.rows, row[new], value[new]


def differing(percent: int) -> float:
    """Most shingles in which linked sets differ, as a share of the smaller set's size.

    Linked sets of sizes ``a <= b <= a / p`` differ in ``a (1 + 1 / p) (1 - p) / (1 + p)``
    shingles at most.
    """
    p = percent / 100
    return (1 + 1 / p) * (1 - p) / (1 + p)


def block_level(size: np.ndarray, percent: int) -> np.ndarray:
    """Number of blocks of a set as a power of two: more than its larger linked partners differ in."""
    return np.floor(np.log2(np.maximum(size, 3) * differing(percent) / SPREAD)).astype(np.int64)


def list_keys(rows: int, row: np.ndarray, value: np.ndarray, light: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the inverted lists of heavy sets: (row, key)."""
    size = np.bincount(row, minlength=rows)
    first = np.concatenate(([0], np.cumsum(size)))
    place = np.arange(len(row)) - first[row]
    least = -(-percent * size // 100)  # the smallest partner
    out_row, out_key = [], []
    # Blocks: at the level of the smaller set, which lies between this one's and that of its
    # smallest partner.
    own, lower = block_level(size, percent), block_level(np.maximum(least, BLOCKED), percent)
    thin = np.zeros(rows, dtype=bool)
    for back in range(int((own - lower).max(initial=0)) + 1):
        level = own - back
        here = (size >= BLOCKED) & (level >= lower)
        use = np.flatnonzero(here[row])
        if not len(use):
            continue
        owner = row[use]
        last = (np.left_shift(1, level) - 1)[owner].astype(np.uint64)
        block = (mix(value[use] ^ np.uint64(0xB10C)) & last).astype(np.int64)
        use, owner, block = use[block < BLOCKS], owner[block < BLOCKS], block[block < BLOCKS]
        order = np.lexsort((block, owner))
        owner, block = owner[order], block[order]
        start = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (block[1:] != block[:-1]))))
        total = np.add.reduceat(mix(value[use][order]), start)
        owner, block = owner[start], block[start]
        out_row.append(owner)
        out_key.append(mix(total ^ mix(((level[owner] << 40) + block).astype(np.uint64))))
        # Sets with so few full blocks that a linked one may differ in all of them.
        differ = np.floor(np.minimum(size * differing(percent), 2 * SPREAD * np.left_shift(1, level)) + 1e-9)
        whole = here & (np.left_shift(1, level) <= BLOCKS)
        thin |= whole & (np.bincount(owner, minlength=rows) <= differ)
    # Single shingles: pairs whose smaller set has fewer than BLOCKED, and thin sets.
    short = (size > light) & (least < BLOCKED) | thin
    use = short[row] & (place <= (size - least)[row])
    out_row.append(row[use])
    out_key.append(mix(value[use] ^ np.uint64(0x5151)))
    return np.concatenate(out_row), np.concatenate(out_key)


def subset_keys(values: np.ndarray, light: int, percent: int) -> list[int]:
    """Keys of a set's subsets, one list for each size its partner may have.

    The lowest bit tells whether both sizes are the same.
    """
    s = len(values)
    keys = []
    for t in partners(s, percent):
        if min(s, t) <= light:
            tag = mix(np.array([min(s, t) * 1000 + max(s, t)], dtype=np.uint64))[0]
            subsets = np.array(list(combinations(values.tolist(), need(s, t, percent))), dtype=np.uint64)
            key = mix(mix(subsets).sum(axis=1, dtype=np.uint64) ^ tag)
            keys += ((key & ~np.uint64(1)) | np.uint64(s == t)).view(np.int64).tolist()
    return keys


def sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Per row: doc, node (hash of its set; null without one), size, list keys, subset keys."""
    light = boundary(percent)
    top = 100 * light // percent
    kind = docs.schema["doc"].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row0, rows, row, value in shingles(batch.column(1), n):
                size = np.bincount(row, minlength=rows)
                total = np.zeros(rows, dtype=np.uint64)
                np.add.at(total, row, mix(value ^ np.uint64(0x5E7)))
                owner, key = list_keys(rows, row, value, light, percent)
                order = np.argsort(owner, kind="stable")
                first = np.concatenate(([0], np.cumsum(size)))
                small = [subset_keys(value[first[r] : first[r + 1]], light, percent) if 0 < size[r] <= top else [] for r in range(rows)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row0, rows),
                        pa.array(mix(total + size.astype(np.uint64)).view(np.int64), mask=size == 0),
                        pa.array(size.astype(np.int64)),
                        lists(long_column(key[order]), np.searchsorted(owner[order], np.arange(rows + 1))),
                        pa.array(small, pa.list_(pa.int64())),
                    ],
                    names=["doc", "node", "size", "keys", "subsets"],
                )

    return docs.mapInArrow(made, f"doc {kind}, node long, size long, keys array<long>, subsets array<long>")


def checked(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                parts = []
                for column in (2, 3):
                    got = list(shingles(batch.column(column), n))
                    row = np.concatenate([r0 + r for r0, _, r, _ in got])
                    parts.append((row, np.concatenate([v for _, _, _, v in got])))
                row, value = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
                order = np.lexsort((value, row))
                row, value = row[order], value[order]
                same = (row[1:] == row[:-1]) & (value[1:] == value[:-1])
                both = np.bincount(row[1:][same], minlength=batch.num_rows)
                total = np.bincount(row, minlength=batch.num_rows) - both
                link = pa.array((100 * both >= percent * total) & (both > 0))
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(link) for i in (0, 1)], names=["a", "b"])

    left = pairs.join(texts.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
    both = left.join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(counted, "a long, b long")


def subset_links(made: DataFrame) -> DataFrame:
    """Links of light sets: in each subset list, sets of one size with those of the other."""
    listed = made.select("node", "size", F.explode("subsets").alias("key")).distinct()
    heads = listed.groupBy("key").agg(
        F.min(F.struct("size", "node")).alias("low"), F.min(F.struct((-F.col("size")).alias("size"), "node")).alias("high")
    )
    same = F.col("key").bitwiseAND(1) == 1
    heads = heads.filter("low.node <> high.node" + " or low.size <> -high.size or (key & 1) = 1")
    joined = listed.join(heads, "key")
    other = F.when(same | (F.col("size") == -F.col("high.size")), F.col("low.node")).otherwise(F.col("high.node"))
    fits = same | (F.col("low.size") < -F.col("high.size"))
    return joined.filter(fits).select(F.col("node").alias("a"), other.alias("b")).filter("a <> b").distinct()


def rare_pairs(open_: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs of nodes (node, component) in different components that may link.

    Shingles are ordered by how many of these nodes have them. Sets that share ``need``
    shingles have a common one at places that leave room for the others in both.
    """

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row0, rows, row, value in shingles(batch.column(2), n):
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(row0, rows) for i in (0, 1)), lists(long_column(value), np.searchsorted(row, np.arange(rows + 1)))],
                    names=["node", "component", "values"],
                )

    with_text = open_.join(texts, "node").select("node", "component", "text")
    held = written(with_text.mapInArrow(taken, "node long, component long, values array<long>"), "open")
    single = held.select("node", "component", F.explode("values").alias("value"))
    often = single.groupBy("value").agg(F.count("*").alias("often"), (F.min("component") != F.max("component")).alias("open"))
    # The shingles of one document, rarest first. Those that no other has come before all
    # others; only their number matters, so they are not shipped.
    # What a node has once comes back by a join, so that each shingle ships as two numbers.
    shared = single.select("node", "value").join(often.filter("often > 1"), "value").groupBy("node")
    ordered = shared.agg(F.sort_array(F.collect_list(F.struct("often", "value", "open"))).alias("order"))
    ordered = ordered.join(held.select("node", "component", F.size("values").alias("size")), "node")
    ordered = ordered.withColumn("own", F.col("size") - F.size("order"))
    length = F.col("size") - F.ceil(F.col("size") * F.lit(percent) / 100).cast("int") + 1
    rest = F.slice("order", F.lit(1), F.greatest(length - F.col("own"), F.lit(0)))
    front = ordered.select("node", "component", "size", "own", F.posexplode(rest).alias("at", "s")).filter("s.open")
    place = (F.col("own") + F.col("at")).alias("place")
    front = written(front.select("node", "component", "size", place, F.col("s.value").alias("value")), "front")
    dropped(held)
    a = front.withColumnsRenamed({c: f"{c}_a" for c in ("node", "component", "size", "place")})
    b = front.withColumnsRenamed({c: f"{c}_b" for c in ("node", "component", "size", "place")})
    least = F.ceil(F.lit(percent) * (F.col("size_a") + F.col("size_b")) / (100 + percent))
    room = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    met = a.join(b, "value").filter((F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b")) & (room >= least))
    pairs = checkpointed(met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct())
    dropped(front)
    return pairs


def links(made: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Edges between nodes that give the components of all links. ``made``: a stored ``sets``,
    deleted once its lists are read."""
    stored, made = made, made.filter("node is not null")
    listed = made.select("node", F.explode("keys").alias("key"))
    several = listed.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1").select("key")
    met = written(listed.join(several, "key").distinct(), "shared")
    company = met.groupBy("key").agg(F.count("*").alias("company")).filter("company > 1")
    shared = written(met.join(company, "key"), "lists")
    dropped(met)
    weight = shared.groupBy("node").agg(F.sum("company").alias("weight"))
    heads = shared.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("pivot"))
    arms = written(shared.join(heads, "key").filter("node <> pivot").select("key", "node", "pivot"), "arms")
    stars = checkpointed(arms.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct())
    texts = node_texts(made, docs, shared.select("node").distinct(), n)
    dropped(shared)
    edges = checked(stars, texts, n, percent).unionByName(subset_links(made))
    edges = checkpointed(edges)
    dropped(stored)
    labels = components(edges)
    # A list's pivot has been checked against all others, so only those may link further.
    placed = arms.select("key", "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = checkpointed(placed)
    dropped(arms)
    mixed = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
    open_ = checkpointed(placed.join(mixed.select("key"), "key", "left_semi").select("node", "component").distinct())
    if open_.isEmpty():
        dropped(texts)
        return edges
    rest = rare_pairs(open_, texts, n, percent)
    more = checkpointed(checked(rest, texts, n, percent))
    dropped(texts)
    return edges.unionByName(more)


def node_texts(made: DataFrame, docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """One text for each of ``nodes``, stored."""
    first = made.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc").alias("_doc"))
    first = checkpointed(first)
    # Rows with one id may hold several texts; the set tells which one is meant.
    found = docs.join(broadcast_if_small(first, first.count(), 24), F.col("doc").eqNullSafe(F.col("_doc")))

    def meant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row0, rows, row, value in shingles(batch.column(1), n):
                size = np.bincount(row, minlength=rows)
                total = np.zeros(rows, dtype=np.uint64)
                np.add.at(total, row, mix(value ^ np.uint64(0x5E7)))
                own = mix(total + size.astype(np.uint64)).view(np.int64) == batch.column(0).slice(row0, rows).to_numpy()
                yield batch.slice(row0, rows).filter(pa.array(own))

    return written(found.select("node", "text").mapInArrow(meant, "node long, text string").dropDuplicates(["node"]), "texts")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: key, n_shingles and component_id (smallest id of its group)."""
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    listed = written(sets(rows, n, percent), "sets")
    made = written(listed.select("doc", "size", "node"), "nodes")
    labels = components(links(listed, rows, n, percent))
    first = made.filter("node is not null").groupBy("node").agg(F.min("doc").alias("first"))
    linked = labels.join(first, "node")
    least = checkpointed(linked.groupBy("component").agg(F.min("first").alias("least")))
    least = labels.join(least, "component").select("node", "least")
    # Stored, so that the last join is a plain one, whose large sides Spark can split.
    least = written(first.join(least, "node", "left").select("node", F.coalesce("least", "first").alias("least")), "least")
    return made.select("doc", "size", "node").join(least, "node", "left").select(
        F.col("doc").alias(key),
        F.col("size").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc")).otherwise(F.col("least")).alias("component_id"),
    )


def kept(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group, that with the smallest id; the columns stay as they are.

    Rows with a null id, and rows that share an id, stay if their group's smallest id is theirs.
    """
    gone = groups(docs, key, text, n, percent).filter(~F.col("component_id").eqNullSafe(F.col(key))).select(F.col(key).alias("_gone")).distinct()
    gone = checkpointed(gone)
    whole = docs.select(F.struct(*docs.columns).alias("_whole"), F.col(key).alias("_key"))
    stay = whole.join(broadcast_if_small(gone, gone.count(), 16), F.col("_key").eqNullSafe(F.col("_gone")), "left_anti")
    return stay.select("_whole.*")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of ``documents``: 4-word shingles, similarity 0.85."""
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i + 1, i + 4), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(greatest(1, len(w) - 3))) AS i FROM d WHERE len(w) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2
), e AS MATERIALIZED (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.n + nb.n - i)
), around AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT r.a, around.b FROM r JOIN around ON r.b = around.a
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
"""
