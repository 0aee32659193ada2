"""Phrase collocations from a weighted de Bruijn graph.

Nodes are three words, an edge is the four words of two overlapping nodes, and its weight is how
often they occur. Every position of a piece gives one edge; the last three positions of a piece
give shorter ones, the piece-end corrections. Everything else is derived from these rows: a
phrase of three words occurs as often as the edges that leave its node and the pieces that end
in it, a phrase of two as often as the three-word phrases it begins and the pieces it ends, a
word likewise. Unary paths of frequent edges, where one edge of a weight runs into one of the
same weight, are compacted to one row; repeated passages shrink to what they are.

Most edges occur once. A first pass counts hashed phrases of two, three and four words in
tables of fixed size, whatever the corpus. A cell only overstates, so where it stays below
``least`` no phrase in it is frequent and the edge is shortened to its longest prefix that may
be; that prefix and all shorter ones keep their exact counts, and nothing else is needed.

Contract: null and empty texts have no words; a text of any length is read whole, in slices
that overlap; a null group counts as ``und``; ties in a score go to the higher count, then to
the phrase in byte order; repeated rows count as often as they occur; keys play no part; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm.store import checkpointed, written
from tidegauge.llm.words import UPPER, mix

LONGEST, LEAST, COVERED, TOP = 4, 30, 80, 2000
#: Score: this times the count, over the counts of both parts.
SCALE = 2_000_000
#: Cells of the count table of each phrase length, in bits of their number; a documented bound.
CELL_BITS, BLOCK_BITS = 23, 16
#: Positions that one step of a task handles at once.
STEP = 1 << 20
#: Edges of a stored path at most; longer unary paths are several rows.
PATH = 256
#: Parts of a group that keep their own first rows before they meet, and copies of word counts.
PARTS, COPIES = 64, 16
STOPS = b".,;:!?\n\x0b\x0c\r"

_FOLD = bytes.maketrans(bytes(range(65, 91)) + STOPS, bytes(range(97, 123)) + b"\n" * len(STOPS))


class _Positions:
    """Words of a run of texts as numbers, with a zero after each piece."""

    def __init__(self):
        self.words: dict[bytes, int] = {b"": 0}
        self.groups: dict[str, int] = {}
        self.ids: list[int] = []
        self.of: list[tuple[int, int]] = []  # group, positions up to here

    def add(self, text: str, group: str) -> None:
        ids, words = self.ids, self.words
        for piece in text.encode().translate(_FOLD).split(b"\n"):
            found = piece.split()
            if found:
                ids.extend([words.setdefault(w, len(words)) for w in found])
                ids.append(0)
        self.of.append((self.groups.setdefault(group, len(self.groups)), len(ids)))

    def steps(self) -> Iterator[tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]]:
        """Group, word numbers and hashes of the phrases of 1 to ``LONGEST`` words at each position.

        A word number is zero, and the hash without meaning, where the piece has ended.
        """
        ids = np.array(self.ids + [0] * LONGEST, dtype=np.int64)
        group = np.repeat([g for g, _ in self.of], np.diff([0, *[end for _, end in self.of]]))
        word = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.words), np.uint64, len(self.words))
        salt = mix(np.fromiter((xxhash.xxh3_64_intdigest(g) for g in self.groups), np.uint64, len(self.groups)))
        for at in range(0, len(group), STEP):
            here = ids[at : at + STEP][: len(group) - at]
            real = here > 0
            x = [here[real]]
            for k in range(1, LONGEST):
                ahead = ids[at + k : at + k + len(here)][real]
                x.append(np.where(x[-1] > 0, ahead, 0))
            of = group[at : at + len(here)][real]
            h = [salt[of] ^ word[x[0]]]
            for k in range(1, LONGEST):
                h.append(mix(h[-1]) + word[x[k]])
            yield of, x, h


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[_Positions]:
    """Texts gathered to about ``STEP`` positions; one text at least."""
    held = _Positions()
    for batch in batches:
        for text, group in zip(batch.column("body"), batch.column("grp"), strict=True):
            held.add(text.as_py() or "", group.as_py())
            if len(held.ids) >= STEP:
                yield held
                held = _Positions()
    if held.ids:
        yield held


def _cells(h: np.ndarray, bits: int) -> np.ndarray:
    return (mix(h) >> np.uint64(64 - bits)).astype(np.int64)


def frequent_cells(rows: DataFrame, least: int, bits: int) -> dict[int, np.ndarray]:
    """For 2 to ``LONGEST`` words, the cells with ``least`` or more phrases, as packed bits.

    Tasks count in bytes that stop at ``least``, and send the blocks that are not empty;
    sums of stopped counts still reach ``least`` where the true count does.
    """
    block = 1 << min(BLOCK_BITS, bits)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {k: np.zeros(1 << bits, dtype=np.uint8) for k in range(2, LONGEST + 1)}
        for run in _runs(batches):
            for _, x, h in run.steps():
                for k, table in tables.items():
                    cells, n = np.unique(_cells(h[k - 1][x[k - 1] > 0], bits), return_counts=True)
                    table[cells] = np.minimum(table[cells] + n, least)
        for k, table in tables.items():
            cells = table.reshape(-1, block)
            full = np.flatnonzero(cells.any(axis=1))
            packed = [pa.compress(cells[at].tobytes(), "lz4", asbytes=True) for at in full]
            yield pa.RecordBatch.from_pydict({"words": [k] * len(full), "block": full, "counts": packed}, schema=sent)

    sent = pa.schema([("words", pa.int32()), ("block", pa.int32()), ("counts", pa.binary())])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k, at, data in zip(*batch.columns, strict=True):
                key = k.as_py(), at.as_py()
                new = np.frombuffer(pa.decompress(data.as_py(), block, "lz4", asbytes=True), np.uint8)
                old = totals.get(key)
                totals[key] = new.copy() if old is None else np.minimum(old.astype(np.uint16) + new, least).astype(np.uint8)
        for (k, at), table in totals.items():
            bits_of = np.packbits(table >= least).tobytes()
            yield pa.RecordBatch.from_pydict({"words": [k], "block": [at], "counts": [bits_of]}, schema=sent)

    shape = "words int, block int, counts binary"
    blocks = rows.mapInArrow(counted, shape).repartition("words", "block").mapInArrow(summed, shape)
    out = {k: np.zeros((1 << bits) // 8, dtype=np.uint8) for k in range(2, LONGEST + 1)}
    for row in blocks.collect():  # at most one bit for each cell
        out[row["words"]][row["block"] * block // 8 : (row["block"] + 1) * block // 8] = np.frombuffer(row["counts"], np.uint8)
    return out


def edges(rows: DataFrame, least: int, bits: int) -> DataFrame:
    """grp, phrase, words, n: all positions by their phrase, cut where it cannot be frequent."""
    marks = rows.sparkSession.sparkContext.broadcast(frequent_cells(rows, least, bits))
    schema = pa.schema([("grp", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64())])

    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            names = pa.array(list(run.words), pa.binary()).cast(pa.string())
            groups = pa.array(list(run.groups), pa.string())
            for of, x, h in run.steps():
                length = np.ones(len(of), dtype=np.int64)
                for k in range(2, LONGEST + 1):
                    cells = _cells(h[k - 1], bits)
                    may = (marks.value[k][cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1
                    length[(x[k - 1] > 0) & (may > 0) & (length == k - 1)] = k
                code = np.zeros(len(of), dtype=np.int64)
                for part in (of, *[np.where(length > k, x[k], 0) for k in range(LONGEST)]):
                    # Both numbers are below 2^31: the pair is coded exactly, then numbered anew.
                    code = pd.factorize(code * (int(part.max(initial=0)) + 1) + part)[0]
                first = np.unique(code, return_index=True)[1]
                n = np.bincount(code)
                columns = [names.take(pa.array(x[k][first])) for k in range(LONGEST)]
                columns = [c if k == 0 else pc.if_else(pa.array(length[first] > k), c, None) for k, c in enumerate(columns)]
                phrase = pc.binary_join_element_wise(*columns, " ", null_handling="skip")
                arrays = [groups.take(pa.array(of[first])), phrase, pa.array(length[first], pa.int32()), pa.array(n)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    partial = rows.mapInArrow(shortened, "grp string, phrase string, words int, n long")
    return partial.groupBy("grp", "phrase", "words").agg(F.sum("n").alias("n"))


def _head(phrase: Column, words: int) -> Column:
    return F.substring_index(phrase, " ", words)


def _tail(phrase: Column, words: int) -> Column:
    return F.substring_index(phrase, " ", -words)


def _ends(links: DataFrame) -> DataFrame:
    """For every edge with a predecessor ``back``: the ``first`` edge of its path and the ``steps`` to it.

    Pointers double, so a path of any length takes the logarithm of it in rounds. An edge that
    is on no path with a beginning is on a ring; ``first`` is null there and ``low`` the
    smallest edge of the ring.
    """
    rows = checkpointed(links.select("grp", "edge", "back", F.lit(1).cast("long").alias("steps"), F.col("back").alias("low"), F.lit(False).alias("done")))
    before = None
    while True:
        ahead = rows.select("grp", F.col("edge").alias("back"), F.col("back").alias("_back"), F.col("steps").alias("_steps"), F.col("low").alias("_low"), F.col("done").alias("_done"))
        joined = rows.filter("not done").join(ahead, ["grp", "back"], "left")
        moved = joined.select(
            "grp",
            "edge",
            F.coalesce("_back", "back").alias("back"),
            (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
            F.least("low", "_low").alias("low"),
            (F.col("_back").isNull() | F.col("_done")).alias("done"),
        )
        rows = checkpointed(rows.filter("done").unionByName(moved))
        state = rows.filter("not done").agg(F.count("*"), F.sum(F.xxhash64("edge", "low").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            break
        before = state
    return rows.select("grp", "edge", F.when(F.col("done"), F.col("back")).alias("first"), "steps", "low")


def compacted(heavy: DataFrame) -> DataFrame:
    """Unary paths of ``heavy`` edges (grp, phrase, n): grp, phrase, n and how many ``edges``.

    Two edges are joined where the node between them has no other edge in or out and their
    weights are the same. Edges of a ring start at its smallest one; a row holds at most
    ``PATH`` edges.
    """
    heavy = heavy.select("grp", F.col("phrase").alias("edge"), "n")
    into = heavy.groupBy("grp", _tail(F.col("edge"), LONGEST - 1).alias("node"), F.lit(True).alias("into")).agg(F.count("*").alias("k"), F.max("edge").alias("edge"), F.max("n").alias("n"))
    out = heavy.groupBy("grp", _head(F.col("edge"), LONGEST - 1).alias("node"), F.lit(False).alias("into")).agg(F.count("*").alias("k"), F.max("edge").alias("edge"), F.max("n").alias("n"))
    met = into.unionByName(out).filter("k = 1").groupBy("grp", "node").agg(
        F.count("*").alias("sides"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.when(F.col("into"), F.col("edge"))).alias("back"), F.max(F.when(~F.col("into"), F.col("edge"))).alias("edge")
    )
    links = checkpointed(met.filter("sides = 2 and lo = hi and back <> edge").select("grp", "edge", "back"))
    if links.isEmpty():
        return heavy.select("grp", F.col("edge").alias("phrase"), "n", F.lit(1).cast("long").alias("edges"))
    found = _ends(links)
    ring = found.filter("first is null")
    if not ring.isEmpty():
        opened = checkpointed(links.join(ring.select("grp", "edge", "low"), ["grp", "edge"]).filter("edge <> low").select("grp", "edge", "back"))
        found = found.filter("first is not null").unionByName(_ends(opened))
    found = found.select("grp", "edge", "first", "steps")
    rows = heavy.join(found, ["grp", "edge"], "left")
    rows = rows.select("grp", F.coalesce("first", "edge").alias("first"), F.coalesce("steps", F.lit(0).cast("long")).alias("steps"), "edge", "n")
    paths = rows.groupBy("grp", "first", F.floor(F.col("steps") / PATH).alias("row")).agg(
        F.array_sort(F.collect_list(F.struct("steps", "edge"))).alias("walk"), F.max("n").alias("n"), F.count("*").alias("edges")
    )
    rest = F.transform(F.slice("walk", 2, PATH), lambda step: F.substring_index(step["edge"], " ", -1))
    return paths.select("grp", F.array_join(F.concat(F.array(F.col("walk")[0]["edge"]), rest), " ").alias("phrase"), "n", "edges")


def _opened(paths: DataFrame) -> DataFrame:
    """Edges of compacted paths: grp, phrase, n."""
    words = F.split("phrase", " ")
    starts = F.sequence(F.lit(1), F.size(words) - (LONGEST - 1))
    every = F.transform(starts, lambda at: F.array_join(F.slice(words, at, LONGEST), " "))
    return paths.select("grp", F.explode(every).alias("phrase"), "n")


def _node_flow(longer: DataFrame, ends: DataFrame, words: int, least: int) -> DataFrame:
    """Counts of phrases of ``words`` words: grp, phrase, n, and ``cover``.

    The count is the flow out of the node, that is of the longer phrases that begin with it,
    plus what ended or was cut there. ``cover`` is the largest count of a frequent longer
    phrase that holds it.
    """
    frequent = F.when(F.col("n") >= least, F.col("n"))
    begins = longer.select("grp", _head(F.col("phrase"), words).alias("phrase"), "n", frequent.alias("cover"))
    holds = longer.filter(F.col("n") >= least).select("grp", _tail(F.col("phrase"), words).alias("phrase"), F.lit(0).cast("long").alias("n"), F.col("n").alias("cover"))
    ended = ends.filter(F.col("words") == words).select("grp", "phrase", "n", F.lit(None).cast("long").alias("cover"))
    rows = begins.unionByName(holds).unionByName(ended)
    return rows.groupBy("grp", "phrase").agg(F.sum("n").alias("n"), F.max("cover").alias("cover"))


def _parted(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Add ``l`` and ``r`` of the cut with the lowest score, and that score.

    Counts of single words are copied, so that a word that begins or ends a share of all
    candidates is looked up in ``COPIES`` places.
    """
    words = F.split("phrase", " ")
    size = F.size(words)

    def part(side: str, cut: Column, first: Column, length: Column) -> Column:
        return F.struct(cut.alias("cut"), F.lit(side).alias("side"), F.array_join(F.slice(words, first, length), " ").alias("part"))

    one = F.lit(1)
    cuts = F.transform(F.sequence(one, size - 1), lambda k: F.array(part("l", k, one, k), part("r", k, k + 1, size - k)))
    copy = F.pmod(F.xxhash64("phrase"), F.lit(COPIES)).cast("int")
    asked = candidates.select("grp", "phrase", "a", F.explode(F.flatten(cuts)).alias("ask"))
    asked = asked.select("grp", "phrase", "a", "ask.*").withColumn("copy", F.when(F.instr("part", " ") == 0, copy).otherwise(0))
    copies = F.when(F.instr("part", " ") == 0, F.sequence(F.lit(0), F.lit(COPIES - 1))).otherwise(F.array(F.lit(0)))
    known = counts.select("grp", F.col("phrase").alias("part"), F.col("n").alias("of_part"))
    known = known.withColumn("copy", F.explode(copies))
    joined = asked.join(known, ["grp", "part", "copy"])
    sides = joined.groupBy("grp", "phrase", "a", "cut").agg(
        F.max(F.when(F.col("side") == "l", F.col("of_part"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("of_part"))).alias("r")
    )
    whole = "cast({} as decimal(20,0))"
    score = F.expr(f"cast(({SCALE}BD * {whole.format('a')}) div ({whole.format('l')} + {whole.format('r')}) as bigint)")
    best = sides.withColumn("score", score).groupBy("grp", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return best.select("grp", "phrase", "a", "best.l", "best.r", "best.score")


def first_rows(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each group with their ``rank``; parts of a group choose first."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = Window.partitionBy("grp", "part").orderBy(*order)
    some = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).withColumn("rank", F.row_number().over(part))
    some = some.filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).drop("part")


def graph(docs: DataFrame, text: str = "text", group: str = "lang", least: int = LEAST, bits: int = CELL_BITS) -> tuple[DataFrame, DataFrame]:
    """Compacted paths of frequent edges, and what else begins at a position: shorter phrases."""
    if least < 1 or least > 127:
        raise ValueError("least is 1 to 127")
    rows = docs.select(F.coalesce(F.col(group).cast("string"), F.lit("und")).alias("grp"), F.col(text).alias("body"))
    found = written(edges(rows, least, bits), "edges")
    heavy = (F.col("words") == LONGEST) & (F.col("n") >= least)
    paths = written(compacted(found.filter(heavy)), "paths")
    cut = F.when(F.col("words") == LONGEST, _head(F.col("phrase"), LONGEST - 1)).otherwise(F.col("phrase"))
    ends = found.filter(~heavy).select("grp", cut.alias("phrase"), F.least("words", F.lit(LONGEST - 1)).alias("words"), "n")
    return paths, ends


def collocations(
    docs: DataFrame, text: str = "text", group: str = "lang", least: int = LEAST, covered: int = COVERED, top: int = TOP, bits: int = CELL_BITS
) -> DataFrame:
    """grp, rank, phrase, a, l, r, n, score: the first ``top`` phrases of 2 to 4 words of each group."""
    paths, ends = graph(docs, text, group, least, bits)
    level = written(_opened(paths), "phrases").withColumn("cover", F.lit(None).cast("long"))
    levels = {LONGEST: level}
    for words in range(LONGEST - 1, 0, -1):
        level = written(_node_flow(level, ends, words, least), "phrases")
        levels[words] = level
    total = checkpointed(levels[1].groupBy("grp").agg(F.sum("n").alias("n")))
    counts, candidates = None, None
    for words, level in levels.items():
        often = level.filter(F.col("n") >= least)
        if words < LONGEST:
            part = often.select("grp", "phrase", "n")
            counts = part if counts is None else counts.unionByName(part)
        if words > 1:
            exact = [F.col(c).cast("decimal(20,0)") for c in ("cover", "n")]
            free = often.filter(F.col("cover").isNull() | (exact[0] * 100 < exact[1] * covered))
            free = free.select("grp", "phrase", F.col("n").alias("a"))
            candidates = free if candidates is None else candidates.unionByName(free)
    ranked = first_rows(_parted(candidates, counts), top)
    return ranked.join(total, "grp").select("grp", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of every language of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text")
    return collocations(docs).withColumnRenamed("grp", "lang")


SQL = f"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, words FROM (
    SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(body, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS words
    FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS body FROM documents)
  ) WHERE len(words) > 0
), places AS (
  SELECT lang, piece, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM pieces
), ahead AS (
  SELECT lang, w AS w1, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4
  FROM places WINDOW p AS (PARTITION BY piece ORDER BY pos)
), phrases AS MATERIALIZED (
  SELECT lang, 1 AS k, w1 AS phrase, count(*) AS a FROM ahead GROUP BY ALL
  UNION ALL SELECT lang, 2, concat_ws(' ', w1, w2), count(*) FROM ahead WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, concat_ws(' ', w1, w2, w3), count(*) FROM ahead WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, concat_ws(' ', w1, w2, w3, w4), count(*) FROM ahead WHERE w4 IS NOT NULL GROUP BY ALL
), totals AS (
  SELECT lang, sum(a)::BIGINT AS n FROM phrases WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM phrases WHERE k > 1 AND a >= {LEAST}
), inside AS (
  SELECT lang, a AS longer, array_to_string(list_slice(w, s, s + m - 1), ' ') AS phrase
  FROM candidates, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS s)
  WHERE m < k AND s + m - 1 <= k
), covers AS (
  SELECT lang, phrase, max(longer) AS longer FROM inside GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, l.a AS l, r.a AS r,
         ({SCALE}::HUGEINT * c.a) // (l.a::HUGEINT + r.a) AS score
  FROM candidates c
  JOIN (SELECT unnest([1, 2, 3]) AS cut) ON cut < c.k
  JOIN phrases l ON l.lang = c.lang AND l.k = cut AND l.phrase = array_to_string(list_slice(c.w, 1, cut), ' ')
  JOIN phrases r ON r.lang = c.lang AND r.k = c.k - cut AND r.phrase = array_to_string(list_slice(c.w, cut + 1, c.k), ' ')
  LEFT JOIN covers v ON v.lang = c.lang AND v.phrase = c.phrase
  WHERE v.longer IS NULL OR 100::HUGEINT * v.longer < {COVERED}::HUGEINT * c.a
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}
"""
