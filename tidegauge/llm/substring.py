"""Repeated passages by compressed FM-indexes, one per shard of the text.

A window is ``WIDTH`` consecutive words of one document; a word goes if a window over it occurs
anywhere else too. Shards are made by content, so that a window has to be looked up in one of
them only: a window belongs to its *anchor*, the 8-word sequence in it with the smallest hash.
Neighbouring windows with the same anchor form a *piece* (62 words at most). An anchor that
occurs in one place of the corpus cannot lie in a repeated window, so only pieces of the
others are shipped. A shard holds all pieces of its anchors; it builds an FM-index (wavelet
matrix) over them and streams them through it by backward search, which reports the intervals
that occur at least twice.

An anchor of a passage that very many documents share (more than ``HOT`` places) is taken
apart: its windows become pieces of their own, routed by all their words, so that equal ones
meet (and merge before the shuffle) and others go to other shards.

Contract: null is an empty text: no words, nothing removed, the digest of the empty text;
texts shorter than a window keep all words; repeated rows repeat each other's windows, all of
them; ties between anchors fall to the smaller hash; an empty table gives an empty result;
other columns are ignored. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.fm_index import FMIndex
from tidegauge.llm.store import dropped, released, written
from tidegauge.llm.words import BLANKS, Words, lists, long_column, mix, spans, split

WIDTH = 35
ANCHOR = 8
#: Windows of a piece at most.
REACH = WIDTH - ANCHOR + 1
HOT = 1000
#: Words in the index of a shard, about.
SHARD_WORDS = 300_000


def pieces_of(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of a slice: first word, number of windows, anchor, does it hold its anchor again."""
    code = words.hashes()
    none = np.zeros(0, dtype=np.int64)
    per_row = np.maximum(np.diff(words.first) - width + 1, 0)
    if not per_row.sum():
        return none, none, none.astype(np.uint64), none.astype(bool)
    at = np.arange(len(code) - ANCHOR + 1)
    low = gram = spans(code, at, at + ANCHOR)
    # Smallest of ``reach`` neighbours, by doubling.
    reach, have = width - ANCHOR + 1, 1
    while have < reach:
        step = min(have, reach - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    # Windows that lie in one row.
    start = np.repeat(words.first[:-1], per_row) + np.arange(per_row.sum()) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    anchor = low[start]
    row_first = np.zeros(len(start), dtype=bool)
    row_first[(np.cumsum(per_row) - per_row)[per_row > 0]] = True
    new = row_first.copy()
    new[1:] |= anchor[1:] != anchor[:-1]
    # Runs of one anchor are cut after ``reach`` windows.
    run = np.flatnonzero(new)
    inside = np.arange(len(start)) - np.repeat(run, np.diff(np.append(run, len(start))))
    cut = np.flatnonzero(inside % reach == 0)
    first, count, anchor = start[cut], np.diff(np.append(cut, len(start))), anchor[cut]
    # An anchor that a piece holds twice may come from a window that it holds twice.
    length = count + reach - 1
    piece = np.repeat(np.arange(len(first)), length)
    inner = np.arange(length.sum()) - (np.cumsum(length) - length)[piece] + first[piece]
    again = np.bincount(piece[gram[inner] == anchor[piece]], minlength=len(first)) > 1
    return first, count, anchor, again


def joined(words: Words, keep: np.ndarray) -> list[str]:
    """SHA-256 of each row's kept words, joined by one space."""
    change = np.zeros(len(words.data) + 1, dtype=np.int8)
    kept = np.flatnonzero(keep)
    row = np.searchsorted(words.first, kept, side="right") - 1
    last = np.append(row[1:] != row[:-1], True) if len(kept) else np.zeros(0, dtype=bool)
    # The byte after a kept word stands for the space; there is one unless it is the row's last.
    end = words.ends[kept] + ~last
    change[words.starts[kept]] += 1
    np.subtract.at(change, end, 1)
    taken = np.cumsum(change[:-1], dtype=np.int8) > 0
    data = words.data.copy()
    data[words.ends[kept[~last]]] = 32
    data = data[taken]
    length = np.concatenate(([0], np.cumsum(taken)))[words.bounds]
    return [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(length[:-1], length[1:], strict=True)]


def places(docs: DataFrame, width: int) -> DataFrame:
    """Per row: doc, text hash, n_words, digest of all words, anchors of its pieces with place."""
    kind = docs.schema["doc"].dataType.simpleString()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in split(batch.column(2), BLANKS, lower=False):
                start, count, anchor, again = pieces_of(words, width)
                bounds = np.searchsorted(start, words.first)
                start = start - words.first[:-1][np.searchsorted(words.first, start, side="right") - 1]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(words.row0, words.rows) for i in (0, 1)),
                        pa.array(np.diff(words.first).astype(np.int64)),
                        pa.array(joined(words, np.ones(len(words.starts), dtype=bool))),
                        lists(long_column(anchor), bounds),
                        lists(pa.array(start.astype(np.int32)), bounds),
                        lists(pa.array(count.astype(np.int32)), bounds),
                        lists(pa.array(again), bounds),
                    ],
                    names=["doc", "body", "n_words", "whole", "anchor", "start", "n", "again"],
                )

    return docs.mapInArrow(
        placed, f"doc {kind}, body long, n_words long, whole string, anchor array<long>, start array<int>, n array<int>, again array<boolean>"
    )


def _extracted(marked: DataFrame, width: int, with_words: bool) -> DataFrame:
    """The pieces of marked documents: (core, piece, codes) or (doc, body, start, piece, n).

    ``hot`` pieces are split into their windows, which are routed by all their words.
    """
    kind = marked.schema["doc"].dataType.simpleString()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            seg = named["seg"]
            at, flat = seg.offsets.to_numpy() - seg.offsets[0].as_py(), seg.flatten()
            start, n, anchor, hot = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            for words in split(named["text"], BLANKS, lower=False):
                code = words.hashes()
                a, b = at[words.row0], at[words.row0 + words.rows]
                owner = np.repeat(np.arange(words.rows), np.diff(at[words.row0 : words.row0 + words.rows + 1]))
                first, count, core, split_ = words.first[owner] + start[a:b], n[a:b].astype(np.int64), anchor[a:b].view(np.uint64), hot[a:b]
                # Windows of hot pieces, one by one.
                times = np.where(split_, count, 1)
                part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                first, owner, single = np.repeat(first, times) + part, np.repeat(owner, times), np.repeat(split_, times)
                count = np.where(single, 1, np.repeat(count, times))
                end = first + count + width - 1
                piece = spans(code, first, end)
                core = np.where(single, piece, np.repeat(core, times))
                if with_words:
                    length = end - first
                    take = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(first, length)
                    offsets = np.concatenate(([0], np.cumsum(length * 8))).astype(np.int32)
                    body = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(code[take].tobytes())])
                    yield pa.RecordBatch.from_arrays([long_column(core), long_column(piece), pa.array(single), body], names=["core", "piece", "single", "codes"])
                else:
                    rows = pa.array(owner + words.row0)
                    yield pa.RecordBatch.from_arrays(
                        [named["doc"].take(rows), named["body"].take(rows), pa.array((first - words.first[owner]).astype(np.int32)), long_column(piece)],
                        names=["doc", "body", "start", "piece"],
                    )

    schema = "core long, piece long, single boolean, codes binary" if with_words else f"doc {kind}, body long, start int, piece long"
    return marked.mapInArrow(extracted, schema)


def search_shards(pieces: DataFrame, width: int, shards: int) -> DataFrame:
    """(piece, windows): which windows of a piece occur at least twice in its shard, as bits."""

    def searched(table: pa.Table) -> pa.Table:
        codes = table.column("codes").combine_chunks()
        codes = codes.chunk(0) if isinstance(codes, pa.ChunkedArray) else codes
        offsets = np.frombuffer(codes.buffers()[1], dtype=np.int32)[codes.offset : codes.offset + len(codes) + 1]
        data = np.frombuffer(codes.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].view(np.uint64)
        index = FMIndex(data, (offsets.astype(np.int64) - offsets[0]) // 8, table.column("weight").to_numpy())
        found = index.repeated_windows(width)
        bits = np.array([int(np.dot(f, 1 << np.arange(len(f), dtype=np.int64))) if f.any() else 0 for f in found], dtype=np.int64)
        return pa.table({"piece": table.column("piece"), "windows": bits}).filter(pa.array(bits != 0))

    sharded = pieces.withColumn("shard", F.pmod(F.xxhash64("core"), F.lit(shards))).select("shard", "piece", "codes", "weight")
    return sharded.groupBy("shard").applyInArrow(searched, "piece long, windows long")


def _removed(hit: DataFrame, width: int) -> DataFrame:
    """Per document with repeated windows: words removed and the digest of the rest."""
    kind = hit.schema["doc"].dataType.simpleString()

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            seg = named["found"]
            at, flat = seg.offsets.to_numpy() - seg.offsets[0].as_py(), seg.flatten()
            start, windows = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2))
            for words in split(named["text"], BLANKS, lower=False):
                a, b = at[words.row0], at[words.row0 + words.rows]
                owner = np.repeat(np.arange(words.rows), np.diff(at[words.row0 : words.row0 + words.rows + 1]))
                first = words.first[owner] + start[a:b]
                change = np.zeros(len(words.starts) + 1, dtype=np.int64)
                for k in range(width):
                    on = first[(windows[a:b] >> k) & 1 == 1] + k
                    np.add.at(change, on, 1)
                    np.add.at(change, on + width, -1)
                gone = np.cumsum(change[:-1]) > 0
                total = np.concatenate(([0], np.cumsum(gone)))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(named[c].slice(words.row0, words.rows) for c in ("doc", "body")),
                        pa.array((total[words.first[1:]] - total[words.first[:-1]]).astype(np.int64)),
                        pa.array(joined(words, ~gone)),
                    ],
                    names=["doc", "body", "n_removed", "left"],
                )

    return hit.mapInArrow(removed, f"doc {kind}, body long, n_removed long, left string")



def repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """One row per document: key, n_words, n_removed, kept_sha256.

    ``width`` is 9 to 62 + ANCHOR words.
    """
    rows = docs.select(F.col(key).alias("doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("body"), F.col(text).alias("text"))
    spread = written(places(rows, width), "places")
    zipped = F.explode(F.arrays_zip("anchor", "start", "n")).alias("p")
    several = spread.select(F.explode(F.arrays_zip("anchor", "again")).alias("p")).select("p.*")
    several = several.groupBy("anchor").agg(F.sum(F.when(F.col("again"), 2).otherwise(1)).alias("places")).filter("places > 1")
    # Stored, so that the join with it is a plain one: Spark can then split the rows of an
    # anchor that very many documents share.
    several = written(several, "several")
    released(docs.sparkSession)
    # A row that is there twice has each of its pieces twice: distinct keeps one of them.
    segments = spread.select("doc", "body", zipped).select("doc", "body", "p.*").join(several, "anchor")
    segments = segments.groupBy("doc", "body").agg(F.collect_set(F.struct("start", "n", "anchor", (F.col("places") > hot).alias("hot"))).alias("seg"))
    segments = segments.withColumnsRenamed({"doc": "_doc", "body": "_body"})
    marked = rows.join(segments, rows["doc"].eqNullSafe(segments["_doc"]) & (rows["body"] == segments["_body"])).select(*rows.columns, "seg")
    marked = written(marked, "marked")
    dropped(several)
    pieces = _extracted(marked, width, True).groupBy("core", "piece", "single").agg(F.count("*").alias("weight"), F.first("codes").alias("codes"))
    # A window that came alone and once occurs nowhere else.
    pieces = written(pieces.filter("not single or weight > 1"), "pieces")
    released(docs.sparkSession)
    size = pieces.agg(F.sum(F.octet_length("codes"))).first()[0] or 0
    found = written(search_shards(pieces, width, max(12, -(-size // (8 * SHARD_WORDS)))), "found")
    dropped(pieces)
    where = _extracted(marked, width, False).join(found, "piece")
    where = where.groupBy("doc", "body").agg(F.collect_set(F.struct("start", "windows")).alias("found"))
    where = where.withColumnsRenamed({"doc": "_doc", "body": "_body"})
    texts = marked.select("doc", "body", "text")
    hit = texts.join(where, texts["doc"].eqNullSafe(where["_doc"]) & (texts["body"] == where["_body"])).select(*texts.columns, "found")
    changed = _removed(hit, width).groupBy("doc", "body").agg(F.first("n_removed").alias("n_removed"), F.first("left").alias("left"))
    changed = changed.withColumnsRenamed({"doc": "_doc", "body": "_body"})
    plain = spread.select("doc", "body", "n_words", "whole")
    return plain.join(changed, plain["doc"].eqNullSafe(changed["_doc"]) & (plain["body"] == changed["_body"]), "left").select(
        F.col("doc").alias(key),
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("left", "whole").alias("kept_sha256"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` that no repeated 35-word window covers."""
    return repeated(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), win AS (
  SELECT r, i, md5(array_to_string(list_slice(w, i + 1, i + 35), ' ')) AS h
  FROM (SELECT r, w, unnest(range(len(w) - 34)) AS i FROM d WHERE len(w) >= 35)
), rep AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS n FROM win) WHERE n > 1
), gone AS (
  SELECT DISTINCT r, i + k AS p FROM rep, (SELECT unnest(range(35)) AS k)
), lists AS (
  SELECT r, list(p) AS ps FROM gone GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(
         CASE WHEN ps IS NULL THEN w
              ELSE list_transform(list_filter(range(len(w)), lambda i: NOT list_contains(ps, i)), lambda i: w[i + 1]) END,
         ' ')) AS kept_sha256
FROM d LEFT JOIN lists USING (r)
"""
