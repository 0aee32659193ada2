"""Packing by minimum bin slack.

Documents become token ids plus an end mark; longer ones than a sequence are cut. What decides
the packing is only how many pieces there are of each length, at most ``capacity`` numbers
whatever the corpus. For each bin a dynamic program over these lengths, with the reachable
sums as the bits of one integer, finds the fullest combination beside the longest piece left;
it is removed as often as the counts allow, which is what repeating the search would do. Plans
that take a combination a little less full where it has longer pieces compete. The
plan is a few thousand rows: which ranks of a length go to which run of sequences. Pieces get
their rank in a length from the order of their task and the counts of the tasks before it, so
no length, however frequent, is sorted or meets in one task.

Contract: null and empty texts are the end mark alone; a text of any length is tokenised whole,
and of a longer one than a sequence the first piece takes what whole pieces leave; repeated
rows and null ids are packed as rows of their own; ties fall to the longer lengths; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.llm.store import written

CAPACITY = 1024
END_ID = 2
#: One vocabulary for two libraries, and the mark that is a token of its own in any text.
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
MARK, MARK_ID = "<|endoftext|>", 50256

#: White space that is too long for the second library's pattern.
_LONG_BLANK = re.compile(r"\s{300}")


class Ids:
    """Token ids of texts, as little-endian 32-bit bytes.

    Both files hold the same vocabulary and both libraries split and merge alike (tested for
    every code point); the one that reads ranks is four times as fast. It knows no special
    tokens and fails on very long runs of white space, which the other one gets.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(vocabulary)
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=known, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if _LONG_BLANK.search(text):
            return np.asarray(self._whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        first, *rest = text.split(MARK)
        found = self._fast.encode_ordinary(first)
        for part in rest:
            found.append(MARK_ID)
            found += self._fast.encode_ordinary(part)
        return np.asarray(found, dtype="<u4").tobytes()


@dataclass(frozen=True)
class Vocabulary:
    """Where the files of the tokenizer are on every machine, and how it splits."""

    vocabulary: str
    ranks: str
    pattern: str

    @staticmethod
    def public() -> Vocabulary:
        import public_tokenizers

        return Vocabulary(public_tokenizers.path(VOCABULARY), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)

    def ids(self) -> Ids:
        return Ids(self.vocabulary, self.ranks, self.pattern)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document; only the first may be shorter than a sequence."""
    first = length if length <= capacity else length % capacity or capacity
    return [(0, first), *[(at, capacity) for at in range(first, length, capacity)]]


def pieces(docs: DataFrame, key: str, text: str, words: Vocabulary, capacity: int, end_id: int) -> DataFrame:
    """Pieces of all documents: key, piece, start, length, ids_crc32, and task and place in it by length."""
    schema = pa.schema(
        [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int32()), ("nth", pa.int64())]
    )
    end = int(end_id).to_bytes(4, "little")

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, task, seen = words.ids(), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            rows, source = [], []
            for i, value in enumerate(batch.column("body")):
                data = ids(value.as_py() or "") + end
                for number, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                    crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                    rows.append((number, start, length, crc, task, seen[length]))
                    seen[length] += 1
                    source.append(i)
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            keys = batch.column("key").take(pa.array(source, pa.int64()))
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays([keys, *arrays], ["key", *schema.names])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    kind = rows.schema["key"].dataType.simpleString()
    shape = f"key {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long"
    return rows.mapInArrow(tokenised, shape)


def fullest(counts: list[int], capacity: int, must: int, spare: int = 0) -> dict[int, int]:
    """The combination of available lengths that leaves least of ``capacity``, with ``must`` in it.

    ``counts[v]`` pieces of length ``v`` are available. Sums are bits of an integer; copies are
    added by doubling. Of equal sums the one with longer pieces is taken; with ``spare``, sums
    up to so much below the fullest count as equal to it.
    """
    room = capacity - must
    full = (1 << (room + 1)) - 1
    steps: list[tuple[int, int]] = []  # length, sums reachable without it
    sums = 1
    for v in range(1, room + 1):
        left = min(counts[v] - (v == must), room // v)
        if left <= 0:
            continue
        steps.append((v, sums))
        take = 1
        while left > 0:
            take = min(take, left)
            sums |= (sums << (take * v)) & full
            left -= take
            take *= 2
    best = sums.bit_length() - 1
    low = max(0, best - spare)
    wanted = sums >> low << low
    chosen = {must: 1}
    for v, without in reversed(steps):
        # The most copies of the longest length that leave a sum the shorter ones reach.
        most = min(counts[v] - (v == must), (wanted.bit_length() - 1) // v)
        for times in range(most, -1, -1):
            if (wanted >> (times * v)) & without:
                break
        wanted = (wanted >> (times * v)) & without
        if times:
            chosen[v] = chosen.get(v, 0) + times
    return chosen


@dataclass(frozen=True)
class Plan:
    """Runs of equal sequences: per length and first rank, where its pieces go."""

    length: np.ndarray
    rank: np.ndarray
    copies: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def _removed(histogram: dict[int, int], capacity: int, spare: int) -> Plan:
    """Remove fullest combinations until no piece is left."""
    counts = [0] * (capacity + 1)
    for v, n in histogram.items():
        counts[v] = n
    used, rows, sequence = [0] * (capacity + 1), [], 0
    longest = capacity
    while longest:
        if not counts[longest]:
            longest -= 1
            continue
        chosen = fullest(counts, capacity, longest, spare)
        times = min(counts[v] // m for v, m in chosen.items())
        offset = 0
        for v in sorted(chosen, reverse=True):
            m = chosen[v]
            rows.append((v, used[v], m, sequence, offset))
            counts[v] -= m * times
            used[v] += m * times
            offset += m * v
        sequence += times
    columns = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences=sequence)


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    """The shortest of the plans with growing spare, from the least slack on.

    A little slack early on saves short pieces, which later bins need, so the strict rule is
    not always the one with fewest sequences. The search ends where no plan can be shorter.
    """
    least = -(-sum(v * n for v, n in histogram.items()) // capacity)
    best, spare = None, 0
    while spare <= capacity:
        found = _removed(histogram, capacity, spare)
        best = found if best is None or found.sequences < best.sequences else best
        if best.sequences == least or spare == capacity:
            break
        spare = min(spare * 2 or 1, capacity)
    return best


def place(lengths: np.ndarray, ranks: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces by length and rank; runs are ordered by both."""
    first = np.searchsorted(plan.length, lengths)
    last = np.searchsorted(plan.length, lengths, side="right")
    # Binary search inside each length's runs, all rows at once.
    while (wide := last - first > 1).any():
        mid = (first + last) // 2
        right = wide & (plan.rank[np.minimum(mid, len(plan.rank) - 1)] <= ranks)
        first, last = np.where(right, mid, first), np.where(wide & ~right, mid, last)
    inside = ranks - plan.rank[first]
    copies = plan.copies[first]
    return plan.sequence[first] + inside // copies, plan.offset[first] + inside % copies * lengths


def pack(
    docs: DataFrame,
    words: Vocabulary,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset."""
    cutup = written(pieces(docs, key, text, words, capacity, end_id), "pieces")
    counts = written(cutup.groupBy("task", "length").agg(F.count("*").alias("n")), "counts")
    # At most ``capacity`` rows.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    order = plan(histogram, capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cutup.join(bases, ["task", "length"]).withColumn("rank", F.col("base") + F.col("nth"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = place(lengths, ranks, order)
            columns = [batch.column(c) for c in ("key", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names)

    names = [key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    kind = cutup.schema["key"].dataType.simpleString()
    quoted = "`" + key.replace("`", "``") + "`"
    shape = f"{quoted} {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select("key", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(placed, shape)


def op13_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of at most 1,024 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, Vocabulary.public())
