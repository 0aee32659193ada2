"""Benchmark decontamination by latent semantic retrieval.

1. How many passages each (hashed) word occurs in is counted over all documents: the idf.
2. A randomised SVD of TF-IDF passages gives a latent space. It is fitted on the passages of
   all documents and on the benchmark items, which weigh more; products with the matrix are
   sums over Spark partitions.
3. Every document's overlapping windows are projected; benchmark items whose cosine with a
   window reaches ``NEAR`` are candidates. The items are the query set, searched in blocks.
4. A candidate counts if the longest common subsequence of the item's words and the window's
   neighbourhood holds ``SURE`` of the item, or ``LIKELY`` of it together with the item's last
   sentence (its answer) word for word.
5. The space has a fixed rank, so its cosines fade as items outnumber its directions. What
   they miss is looked up by words (``Lookup``), without loss at any number or length of items:
   every stretch of up to ``reach`` words that 4. accepts is found.

Contract: each distinct pair of item id and text is an item of its own, also with an id that
others share or a null one; null texts and items are empty and match nothing; documents shorter than a window
are one window; every item that a document holds is reported, the best one first (ties fall to
the smaller id); repeated rows are reported separately; without documents or items nothing matches; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tidegauge.llm.store import cleaned, dropped, written
from tidegauge.llm.words import MARKS, Words, split

HASHED = 1 << 14
RANK = 128
PASSAGE = 64
STEP = 16
NEAR = 0.35
SURE = 0.7
LIKELY = 0.5
#: Items of a block of the query set.
ITEMS = 10_000
#: Items that are compared at a time, and hits of their words.
AT_ONCE = 1_000
#: Passages that are multiplied at a time, and their words.
AT_TIME = 4_096
TERMS = 1_024
PAIRS = 4_000_000
#: Places that are looked at together, and words of candidates that are compared at a time.
PLACES = 1 << 14
COMPARED = 1 << 18
#: Tells the words of one item from those of others.
APART = np.uint64(0x9E3779B97F4A7C15)
MATCH = "struct<item:long,cosine:double,share:double,answer:boolean>"
FOUND = pa.list_(pa.struct([("item", pa.int64()), ("cosine", pa.float64()), ("share", pa.float64()), ("answer", pa.bool_())]))


def folded(code: np.ndarray) -> np.ndarray:
    return (code >> np.uint64(40)).astype(np.int64) & (HASHED - 1)


def dims(words: Words) -> np.ndarray:
    return folded(words.hashes())


def stored_passages(texts: DataFrame) -> DataFrame:
    """Hashed words of the passages of all texts, a row per slice: distinct words of each
    passage, the words, and how often each occurs there, as a stored table."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in split(batch.column(0), MARKS, lower=True):
                if not len(words.starts):
                    continue
                row = words.row_of()
                inside = np.arange(len(row)) - words.first[row]
                new = inside % PASSAGE == 0
                at, times = np.unique((np.cumsum(new) - 1) * HASHED + dims(words), return_counts=True)
                size = np.bincount(at // HASHED, minlength=int(new.sum()))
                parts = (size.astype(np.uint8), (at % HASHED).astype(np.uint16), times.astype(np.uint8))
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in parts], names=["sizes", "dims", "times"])

    return written(texts.select("text").mapInArrow(made, "sizes binary, dims binary, times binary"), "passages")


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sizes, words and frequencies of the passages of each slice."""
    for sizes, where, times in zip(*(batch.column(n) for n in ("sizes", "dims", "times")), strict=True):
        yield (np.frombuffer(x.as_buffer(), kind) for x, kind in ((sizes, np.uint8), (where, np.uint16), (times, np.uint8)))


def passage_counts(stored: DataFrame) -> tuple[np.ndarray, int]:
    """In how many passages each hashed word occurs; passages."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(HASHED + 1, dtype=np.int64)
        for batch in batches:
            for sizes, where, _ in unpacked(batch):
                total[:HASHED] += np.bincount(where, minlength=HASHED)
                total[HASHED] += len(sizes)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["dim", "n"])

    # One row per hashed word.
    rows = stored.mapInArrow(counted, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(HASHED + 1, dtype=np.int64)
    for r in rows:
        out[r["dim"]] = r["n"]
    return out[:HASHED], int(out[HASHED])


def summed(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Sum of the (at, part) rows of all partitions: float32 parts of an array, added up per part."""

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p.as_buffer(), np.float32).astype(np.float64) for p in table.column("part"))
        return pa.table({"at": table.column("at")[:1], "part": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    out = np.zeros(shape, dtype=np.float32)
    # As many rows as the array has parts.
    with cleaned(parts.sparkSession):
        rows = parts.groupBy("at").applyInArrow(added, "at int, part binary").collect()
    for r in rows:
        part = np.frombuffer(r["part"], np.float32).reshape(-1, shape[1])
        out[r["at"] : r["at"] + len(part)] = part
    return out


def add_products(out: np.ndarray, to: np.ndarray, of: np.ndarray, x: np.ndarray, block: np.ndarray) -> None:
    """Add the rows ``of`` of ``block``, each times its ``x``, to the rows ``to`` of ``out``.

    ``to`` ascends. Rows that get equally many are multiplied together, so memory is read once
    per word; a dense matrix of passages reads far more than there is in it.
    """
    n = np.bincount(to, minlength=len(out))
    first = np.cumsum(n) - n
    order = np.argsort(n, kind="stable")[np.count_nonzero(n == 0) :]
    sizes, begin = np.unique(n[order], return_index=True)
    bounds = [*begin.tolist(), len(order)]
    for size, a, b in zip(sizes.tolist(), bounds[:-1], bounds[1:], strict=True):
        step = max(1, TERMS // size)
        for c in range(a, b, step):
            own = order[c : min(c + step, b)]
            at = first[own][:, None] + np.arange(size)
            out[own] += np.matmul(x[at][:, None], block.take(of[at], 0))[:, 0]


def randomised_svd(stored: DataFrame, idf: np.ndarray, rank: int, rounds: int = 2, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors of the TF-IDF passages, in rows as long as their ``weight``.

    Every round multiplies a block of vectors by A'A: each partition multiplies with its own
    passages, and the partitions' results are summed part by part. The space is that of the last
    product, and its directions are those in which that product is longest.
    """

    def product(block: np.ndarray) -> np.ndarray:
        """A'A ``block``."""

        def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(block.shape, dtype=np.float32)
            for batch in batches:
                for (sizes, where, times), weight in zip(unpacked(batch), batch.column("weight").to_numpy(), strict=True):
                    bounds = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
                    x = times * idf[where]
                    x *= np.repeat(weight / np.maximum(np.sqrt(np.add.reduceat(x * x, bounds[:-1])), 1e-9), sizes)
                    for a in range(0, len(sizes), AT_TIME):
                        b = min(a + AT_TIME, len(sizes))
                        at, own = where[bounds[a] : bounds[b]], x[bounds[a] : bounds[b]].astype(np.float32)
                        passage = np.repeat(np.arange(b - a), sizes[a:b])
                        latent = np.zeros((b - a, block.shape[1]), dtype=np.float32)
                        add_products(latent, passage, at, own, block)
                        order = np.argsort(at, kind="stable")
                        add_products(total, at[order], passage[order], own[order], latent)
            step = -(-len(total) // 32)
            at = list(range(0, len(total), step))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array([total[a : a + step].tobytes() for a in at], pa.binary())], names=["at", "part"]
            )

        return summed(stored.mapInArrow(multiplied, "at int, part binary"), block.shape)

    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((HASHED, rank), dtype=np.float32))[0]
    for _ in range(rounds):
        basis = np.linalg.svd(product(basis), full_matrices=False)[0]
    return basis


@dataclass
class Item:
    id: int | None
    words: list[int]
    answer: list[int]


@dataclass
class Space:
    """Latent space with the items of one block."""

    word: np.ndarray  # projected idf vector of each hashed word
    norm: np.ndarray  # squared idf of each hashed word
    items: list[Item]
    wide: np.ndarray  # which items are searched with windows of PASSAGE words
    vectors: np.ndarray  # projected items, of length 1


def word_list(text: str) -> list[int]:
    (words,) = split(pa.array([text]), MARKS, lower=True)
    return words.hashes().tolist()


def answer(text: str) -> str:
    """The last sentence."""
    return next((s for s in reversed(re.split(r"[.!?\n]", text)) if s.strip()), "")


def common(masks: dict[int, int], length: int, words: list[int]) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    full = (1 << length) - 1
    v = full
    for mask in filter(None, map(masks.get, words)):
        u = v & mask
        v = ((v + u) | (v - u)) & full
    return length - v.bit_count()


def holds(words: list[int], part: list[int]) -> bool:
    return bool(part) and any(words[i : i + len(part)] == part for i, w in enumerate(words) if w == part[0])


def reach(n: int) -> int:
    """Longest stretch of a document that is looked up for an item of ``n`` words."""
    return n + max(2 * STEP, n // 2)


class Codes:
    """Places of some words in a text."""

    def __init__(self, words: np.ndarray):
        self.words = words  # ascending
        self.mask = np.uint64((1 << max(16, (8 * len(words)).bit_length())) - 1)
        self.low = np.zeros(int(self.mask) + 1, dtype=bool)
        self.low[words & self.mask] = True

    def places(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where ``code`` has one of the words, and which."""
        at = np.flatnonzero(self.low[code & self.mask])
        word = np.minimum(np.searchsorted(self.words, code[at]), max(len(self.words) - 1, 0))
        hit = self.words[word] == code[at]
        return at[hit], word[hit]


class Lookup:
    """Stretches that may hold an item, by its rarest words.

    An accepted stretch lacks at most ``n - ceil(LIKELY * n)`` of the ``n`` words of an item. So
    of its that many and ``need`` more rarest words at least ``need`` are there, and ``sure`` if
    the stretch holds ``SURE`` of the item; if not, the rarest word of its answer is there.
    """

    def __init__(self, items: list[Item], norm: np.ndarray):
        size = np.array([len(i.words) for i in items], dtype=np.int64)
        self.need = np.maximum(1, size // 4)
        self.reach = np.array([reach(n) for n in size.tolist()], dtype=np.int64)
        self.sure = np.zeros(len(items), dtype=np.int64)
        marks: list[int | None] = []
        words, owner = [], []
        for k, item in enumerate(items):
            code = np.array(item.words, dtype=np.uint64)
            rare = norm[(code >> np.uint64(40)).astype(np.int64) & (HASHED - 1)]
            lacks = len(code) - math.ceil(LIKELY * len(code) - 1e-9)
            words.append(np.unique(code[np.lexsort((code, -rare))[: lacks + self.need[k]]]))
            self.sure[k] = lacks + self.need[k] - (len(code) - math.ceil(SURE * len(code) - 1e-9))
            marks.append(max(item.answer, key=lambda w: norm[(w >> 40) & (HASHED - 1)], default=None))
            owner.append(np.full(len(words[-1]), k))
        code = np.concatenate(words) if words else np.zeros(0, np.uint64)
        order = np.argsort(code, kind="stable")
        self.owner = np.concatenate(owner)[order] if owner else np.zeros(0, np.int64)
        words, self.first = np.unique(code[order], return_index=True)
        self.words = Codes(words)
        self.first = np.append(self.first, len(code))
        # The rarest word of each answer, by its place among those of all; -1 without an answer.
        self.marks = Codes(np.unique(np.array([m for m in marks if m is not None], dtype=np.uint64)))
        self.mark = np.array([-1 if m is None else int(np.searchsorted(self.marks.words, np.uint64(m))) for m in marks], dtype=np.int64)

    def places(self, code: np.ndarray, row: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, first word, last word): a stretch that begins between the two words may hold the item."""
        if not len(self.words.words) or not len(code):
            return
        at, word = self.words.places(code)
        n = np.diff(self.first)[word]
        rows = np.searchsorted(at, first)
        total = np.append(0, np.cumsum(n))[rows]
        said, which = self.marks.places(code) if len(self.marks.words) else (at[:0], at[:0])
        said = np.sort(which * (len(code) + 1) + said)
        a = 0
        while a < len(first) - 1:  # whole rows of about ``PAIRS`` hits
            b = max(a + 1, int(np.searchsorted(total, total[a] + PAIRS, side="right")) - 1)
            own = slice(rows[a], rows[b])
            k, begin, end, sure = self._near(at[own], word[own], n[own], row)
            begin = np.maximum(begin, first[row[end]])
            low, high = (self.mark[k] * (len(code) + 1) + x for x in (begin, np.minimum(end + self.reach[k], len(code))))
            use = sure | ((self.mark[k] >= 0) & (np.searchsorted(said, low) < np.searchsorted(said, high)))
            yield from zip(k[use].tolist(), begin[use].tolist(), end[use].tolist(), strict=True)
            a = b

    def _near(self, at: np.ndarray, word: np.ndarray, n: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        owner = self.owner[np.repeat(self.first[word] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        # Far enough apart that no stretch goes from one item into the next.
        shift = int(len(row) + self.reach.max()).bit_length()
        hit = np.sort((owner << shift) + np.repeat(at, n))
        item = hit >> shift
        last = np.arange(len(hit)) + self.need[item] - 1
        ok = hit.take(last, mode="clip") - hit < self.reach[item]
        own = np.flatnonzero(ok & (last < len(hit)))
        last = last[own]
        place = hit & ((1 << shift) - 1)
        same = row[place[last]] == row[place[own]]
        own, last = own[same], last[same]
        if not len(own):
            return own, own, own, own > 0
        k, end = item[own], place[own]
        begin = place[last] - self.reach[k] + 1
        sure = np.searchsorted(hit, hit[own] + self.reach[k]) - own >= self.sure[k]
        new = np.ones(len(k), dtype=bool)
        new[1:] = (k[1:] != k[:-1]) | (row[end[1:]] != row[end[:-1]]) | (end[1:] > end[:-1] + STEP)
        a = np.flatnonzero(new)
        end = end[np.append(a[1:], len(k)) - 1]
        return k[a], begin[a], end, np.logical_or.reduceat(sure, a)


class Matcher:
    """Items that each text of a batch holds; made on the executors from a ``Space``."""

    def __init__(self, space: Space):
        self.space = space
        self.masks: list[dict[int, int]] = []
        for item in space.items:
            masks: dict[int, int] = {}
            for i, w in enumerate(item.words):
                masks[w] = masks.get(w, 0) | (1 << i)
            self.masks.append(masks)
        self.length = np.array([len(item.words) for item in space.items], dtype=np.int64)
        self.reach = np.array([reach(n) for n in self.length.tolist()], dtype=np.int64)
        # Places of each word in the items whose places fit a number.
        short = [(k, w, mask) for k, masks in enumerate(self.masks) if self.length[k] <= 64 for w, mask in masks.items()]
        k, w, mask = (np.array(x, dtype=np.uint64) for x in (zip(*short) if short else ((), (), ())))
        pair, at = np.unique(w + APART * k, return_index=True)
        self.pairs, self.bits = Codes(pair), mask[at]
        self.lookups = [(a, Lookup(space.items[a : a + AT_ONCE], space.norm)) for a in range(0, len(space.items), AT_ONCE)]

    def windows(self, words: Words, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """First word and row of each chunk; for two window sizes the projections and norms."""
        n = np.diff(words.first)
        chunks = -(-n // STEP)
        row = np.repeat(np.arange(words.rows), chunks)
        start = words.first[row] + STEP * (np.arange(len(row)) - (np.cumsum(chunks) - chunks)[row])
        d = folded(code)
        total = np.empty((len(start), self.space.word.shape[1]), dtype=np.float32)
        size = np.diff(np.append(start, len(d)))
        # Full chunks first, so that the ones that have a next word are the first ones.
        order = np.argsort(-size, kind="stable")
        for a in range(0, len(start), 512):
            own = order[a : a + 512]
            at, more = start[own], size[own]
            part = self.space.word.take(d[at], 0)
            for j, n_more in enumerate(np.searchsorted(-more, -np.arange(1, more[0])).tolist(), 1):
                part[:n_more] += self.space.word.take(d[at[:n_more] + j], 0)
            total[own] = part
        norm = np.add.reduceat(self.space.norm[d], start) if len(start) else np.zeros(0)
        out = []
        for shift in (1, 2):
            same = row[shift:] == row[:-shift]
            total, norm = total.copy(), norm.copy()
            more, wider = total[shift:] * same[:, None], norm[shift:] * same
            total[:-shift] += more
            norm[:-shift] += wider
            out.append((total, norm))
        return start, row, out

    def shares(self, code: np.ndarray, k: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """``common`` as a share of each item ``k``, for the words ``low:high``."""
        out = np.zeros(len(k), dtype=np.int64)
        for i in np.flatnonzero(self.length[k] > 64).tolist():
            out[i] = common(self.masks[k[i]], int(self.length[k[i]]), code[low[i] : high[i]].tolist())
        short = np.flatnonzero(self.length[k] <= 64)
        ends = np.cumsum((high - low)[short])
        a = 0
        while a < len(short):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + COMPARED, side="right")))
            own = short[a:b]
            out[own] = self._common(code, k[own], low[own], high[own])
            a = b
        return out / self.length[k]

    def _common(self, code: np.ndarray, k: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """``common`` of many items at a time, which have 64 words at most."""
        size = high - low
        own = np.repeat(np.arange(len(k)), size)
        at = np.arange(len(own)) + (low - np.cumsum(size) + size)[own]
        at, pair = self.pairs.places(code[at] + (APART * k.astype(np.uint64))[own])
        mask = self.bits[pair]
        n = np.bincount(own[at], minlength=len(k))
        order = np.argsort(-n, kind="stable")
        first, n = (np.cumsum(n) - n)[order], n[order]
        full = np.uint64(2**64 - 1) >> (64 - self.length[k[order]]).astype(np.uint64)
        v = full.copy()
        # All take their next word that the item has.
        for j, more in enumerate(np.searchsorted(-n, -np.arange(n.max(initial=0))).tolist()):
            u = v[:more] & mask[first[:more] + j]
            v[:more] = (v[:more] + u) | (v[:more] - u)
        out = np.empty(len(k), dtype=np.int64)
        out[order] = self.length[k[order]] - np.bitwise_count(v & full)
        return out

    def match(self, texts: pa.Array) -> list[list[dict]]:
        found: list[list[dict]] = []
        for words in split(texts, MARKS, lower=True):
            held: list[dict[int, dict]] = [{} for _ in range(words.rows)]
            if len(words.starts) and self.space.items:
                self._slice(words, held)
            found += [list(of.values()) for of in held]
        return found

    def _slice(self, words: Words, held: list[dict[int, dict]]) -> None:
        space = self.space
        code = words.hashes()
        start, row, sizes = self.windows(words, code)

        def offer(r: np.ndarray, k: np.ndarray, cosine: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
            """Count each item if the words ``low:high`` hold it."""
            share = self.shares(code, k, low, high)
            for i in np.flatnonzero(share >= LIKELY).tolist():
                item, of, s = space.items[k[i]], held[r[i]], float(share[i])
                said = holds(code[low[i] : high[i]].tolist(), item.answer)
                if s >= SURE or said:
                    old = of.get(int(k[i]))
                    if old is None or s > old["share"]:
                        of[int(k[i])] = {"item": item.id, "cosine": float(cosine[i]), "share": s, "answer": said}

        for (total, norm), use, length in ((sizes[0], ~space.wide, 2 * STEP), (sizes[1], space.wide, PASSAGE)):
            size = np.sqrt(np.maximum(norm, 1e-9))
            least = ((NEAR - 1e-3) * size).astype(np.float32)[:, None]
            for items in np.split(np.flatnonzero(use), np.arange(AT_ONCE, use.sum(), AT_ONCE)):
                dot = total @ space.vectors[items].T
                # Few come near, so only those are divided.
                window, column = np.divmod(np.flatnonzero(dot >= least), len(items))
                cosine = dot[window, column] / size[window]
                near = cosine >= NEAR
                if not near.any():
                    continue
                window, column, cosine = window[near], column[near], cosine[near]
                # Neighbouring windows of one item and row are one place.
                order = np.lexsort((window, column))
                window, column, cosine = window[order], column[order], cosine[order]
                new = np.ones(len(window), dtype=bool)
                new[1:] = (column[1:] != column[:-1]) | (row[window[1:]] != row[window[:-1]]) | (window[1:] > window[:-1] + 1)
                a = np.flatnonzero(new)
                r, last = row[window[a]], window[np.append(a[1:], len(window)) - 1]
                low = np.maximum(words.first[r], start[window[a]] - STEP)
                high = np.minimum(words.first[r + 1], start[last] + length + STEP)
                offer(r, items[column[a]], np.maximum.reduceat(cosine, a), low, high)
        of = words.row_of()
        places = ((k0 + k, begin, end) for k0, lookup in self.lookups for k, begin, end in lookup.places(code, of, words.first))
        for some in batched(places, PLACES):
            k, begin, end = np.array(some, dtype=np.int64).T
            r, far = of[end], self.reach[k]
            stop = np.minimum(end + far, words.first[r + 1])
            near = self.shares(code, k, begin, stop) >= LIKELY
            tried = []
            for r, k, low, end, stop, far in zip(*(x[near].tolist() for x in (r, k, begin, end, stop, far)), strict=True):
                total, norm = sizes[int(space.wide[k])]
                a, b = np.searchsorted(start, [max(int(words.first[r]), low - STEP), stop])
                cosine = float((total[a:b] @ space.vectors[k] / np.sqrt(np.maximum(norm[a:b], 1e-9))).max(initial=0.0))
                tried += [(r, k, cosine, at, min(at + far + STEP, int(words.first[r + 1]))) for at in range(low, end + 1, STEP)]
            if tried:
                offer(*(np.array(x) for x in zip(*tried, strict=True)))


def spaces(docs: DataFrame, benchmark: DataFrame, key: str, text: str, item: str, item_text: str) -> list[Space]:
    """The latent space, once for each block of benchmark items."""
    known = stored_passages(docs.select(F.col(text).alias("text")))
    count, n = passage_counts(known)
    idf = np.log((n + 1) / (count + 1)).clip(0)
    questions = benchmark.select(F.col(item).cast("long").alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    questions = written(questions.distinct(), "items")
    size = questions.count()
    asked = stored_passages(questions)
    # The items weigh about four times as much as the passages of the documents.
    heavy = max(1.0, (4 * n / max(size, 1)) ** 0.5)
    rows = known.withColumn("weight", F.lit(1.0)).unionByName(asked.withColumn("weight", F.lit(heavy)))
    vectors = randomised_svd(rows, idf, RANK)
    dropped(known, asked)
    word = (vectors * idf[:, None]).astype(np.float32)
    out = []
    blocks = -(-size // ITEMS)
    for b in range(blocks):
        items, lines = [], []
        for r in questions.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).orderBy("id", "text").collect():
            codes = word_list(r["text"])
            if codes:
                items.append(Item(r["id"], codes, word_list(answer(r["text"]))))
                d = (np.array(codes, dtype=np.uint64) >> np.uint64(40)).astype(np.int64) & (HASHED - 1)
                at, times = np.unique(d, return_counts=True)
                line = times @ word[at]
                lines.append(line / max(np.linalg.norm(line), 1e-9))
        wide = np.array([len(i.words) > 24 for i in items], dtype=bool)
        out.append(Space(word, (idf**2).astype(np.float64), items, wide, np.array(lines, dtype=np.float32).reshape(len(items), -1)))
    return out


def held_items(text, blocks: list[Space]):
    """Column expression: all items that a text holds, the best one first."""

    def column(space: Space):
        made: list[Matcher] = []

        @arrow_udf(f"array<{MATCH}>")
        def matched(texts: pa.Array) -> pa.Array:
            if not made:
                made.append(Matcher(space))
            return pa.array(made[0].match(texts), FOUND)

        # Else a condition on the result searches the texts once more, in Python workers of its own.
        return matched.asNondeterministic()(text)

    found = [column(space) for space in blocks]
    if not found:
        return F.array().cast(f"array<{MATCH}>")
    first = lambda a, b: F.coalesce(a["item"] < b["item"], a["item"].isNotNull() & b["item"].isNull())
    better = lambda a, b: (a["share"] > b["share"]) | ((a["share"] == b["share"]) & first(a, b))
    return F.array_sort(F.concat(*found), lambda a, b: F.when(better(a, b), -1).when(better(b, a), 1).otherwise(0))


def matches(docs: DataFrame, benchmark: DataFrame, key="doc_id", text="text", item="item_id", item_text="text") -> DataFrame:
    """(whole, leaks, leak) for each row of ``docs``: the row as a struct, all items that it
    holds with the best one first, and the best one or null."""
    blocks = spaces(docs, benchmark, key, text, item, item_text)
    found = docs.select(F.struct(*docs.columns).alias("whole"), held_items(F.col(text), blocks).alias("leaks"))
    return found.withColumn("leak", F.get("leaks", F.lit(0)))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a benchmark item; columns as they are."""
    return matches(docs, benchmark).filter("size(leaks) = 0").select("whole.*")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` that hold items of ``benchmark``: a row for each item that one holds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("whole", F.explode("leaks").alias("leak")).select(
        F.col("whole.doc_id").alias("doc_id"),
        F.col("leak.item").alias("item_id"),
        F.col("leak.cosine").alias("cosine"),
        F.col("leak.share").alias("lcs_share"),
        F.col("leak.answer").alias("answer_found"),
    )
