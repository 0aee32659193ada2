"""Toxic texts: Levenshtein automata over a lexicon trie, read in context.

The lexicon is learned from labelled documents: words and word stems that occur in toxic
documents far more often than chance allows. Its trie and the Levenshtein automata of its
terms are intersected into one automaton, so a misspelled term is found in one pass over the
bytes of a word. Every hit is read with the words around it: between quotation marks, or near
a word of reporting, it counts as quotation, else as abuse. A logistic model on the hits of a
document gives the score.

Contract: null is empty; empty texts get the score of a text without hits; a document without
a label, or with an unknown one, is not learned from; repeated rows are scored separately;
without labels of both kinds the score is the share of toxic labels (0 without any).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.automata import Automaton, determinise, run
from tidegauge.llm.newton import logistic
from tidegauge.llm.store import dropped, written
from tidegauge.llm.words import MARKS, Words, long_column, mix, spans, split
from tidegauge.llm.words import _CODE as CODES
from tidegauge.session import broadcast_if_small

#: Stems are 4 to 7 bytes long.
STEMS = range(4, 8)
#: A term must beat chance by this factor over all candidates together.
CHANCE = 0.01
#: Whole terms this long may be misspelled by one edit (bytes), in the plain automaton.
LONG = 5
#: Edits that a whole term may have from so many bytes on; a swap of neighbours is one.
BUDGET = ((4, 1),)
WINDOW = 8
LIMIT = 0.3
#: Words of reporting.
REPORTING = frozenset(b"said says saying wrote writes quote quoted quotes called calls word words term".split())
QUOTES = (b'"', b"'", "“".encode(), "”".encode(), "«".encode(), "»".encode())


# --- lexicon -------------------------------------------------------------------------------


def candidate_counts(docs: DataFrame) -> DataFrame:
    """For each word and stem: in how many clean and toxic documents (columns text, toxic)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            made = []
            for words in split(batch.column(0), MARKS, lower=True):
                row, size = words.row_of(), words.ends - words.starts
                parts = []
                for length in (*STEMS, 0):
                    use = np.flatnonzero(size > length) if length else np.flatnonzero(size >= 3)
                    end = words.starts[use] + length if length else words.ends[use]
                    code = spans(CODES[words.data], words.starts[use], end)
                    once = np.unique(mix(code ^ np.uint64(length)) ^ mix(row[use].astype(np.uint64)), return_index=True)[1]
                    named, where, count = np.unique(code[once], return_index=True, return_inverse=True)
                    bad = np.bincount(count, weights=toxic[words.row0 + row[use[once]]], minlength=len(named))
                    all_ = np.bincount(count, minlength=len(named))
                    names = [words.data[words.starts[i] : e].tobytes() for i, e in zip(use[once[where]], end[once[where]], strict=True)]
                    parts.append((names, length > 0, all_ - bad, bad))
                for names, stem, good, bad in parts:
                    kinds = pa.array([stem] * len(names), pa.bool_())
                    made.append(pa.table({"term": pa.array(names, pa.binary()), "stem": kinds, "clean": good.astype(np.int64), "toxic": bad.astype(np.int64)}))
            if made:
                # Slices of a batch share most terms.
                counts = pa.concat_tables(made).group_by(["term", "stem"]).aggregate([("clean", "sum"), ("toxic", "sum")])
                yield from counts.rename_columns(["term", "stem", "clean", "toxic"]).combine_chunks().to_batches()

    counts = docs.select("text", "toxic").mapInArrow(counted, "term binary, stem boolean, clean long, toxic long")
    return counts.groupBy("term", "stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def context_counts(docs: DataFrame, terms: list[tuple[bytes, bool]]) -> dict[int, tuple[int, int]]:
    """For each term (by place): distinct neighbourhoods in clean and in toxic documents.

    A document and its near copies have the same neighbourhoods, so a text that was copied
    often does not make its words look toxic.
    """
    code_of = lambda t: spans(CODES[np.frombuffer(t, np.uint8)], np.array([0]), np.array([len(t)]))[0]
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for length in (*STEMS, 0):
        own = [(code_of(t), k) for k, (t, stem) in enumerate(terms) if (len(t) if stem else 0) == length]
        known[length] = tuple(np.array(x, dtype=kind) for x, kind in zip(zip(*sorted(own), strict=True), (np.uint64, np.int64), strict=True)) if own else None

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for words in split(batch.column(0), MARKS, lower=True):
                row, size, code = words.row_of(), words.ends - words.starts, words.hashes()
                before = np.concatenate((np.zeros(1, np.uint64), code))[:-1] * (np.arange(len(code)) != words.first[row])
                after = np.concatenate((code, np.zeros(1, np.uint64)))[1:] * (np.arange(len(code)) + 1 != words.first[row + 1])
                around = mix(mix(before.astype(np.uint64)) ^ after.astype(np.uint64))
                for length, own in known.items():
                    if own is None:
                        continue
                    use = np.flatnonzero(size > length) if length else np.arange(len(code))
                    part = spans(CODES[words.data], words.starts[use], words.starts[use] + length) if length else code
                    at = np.minimum(np.searchsorted(own[0], part), len(own[0]) - 1)
                    hit = own[0][at] == part
                    use, at = use[hit], at[hit]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[1][at]), long_column(around[use]), pa.array(toxic[words.row0 + row[use]].astype(np.int64))], names=["term", "around", "toxic"]
                    )

    rows = docs.select("text", "toxic").mapInArrow(met, "term long, around long, toxic long").distinct()
    counts = rows.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
    # One row per term.
    return {r["term"]: (r["n"] - r["toxic"], r["toxic"]) for r in counts.collect()}


def learn_lexicon(docs: DataFrame) -> list[tuple[bytes, bool]]:
    """Terms (bytes, is it a stem) that mark toxic documents."""
    total = {r["toxic"]: r["count"] for r in docs.groupBy("toxic").count().collect()}
    bad, good = total.get(1, 0), total.get(0, 0)
    if not bad or not good:
        return []
    share = bad / (bad + good)
    counts = written(candidate_counts(docs).filter(f"toxic >= 3 and toxic > {10 * share / (1 - share)} * clean"), "terms")

    def surprise(clean: int, toxic: int) -> float:
        n = clean + toxic
        p = toxic / n if n else 0.0
        if p <= share:
            return 0.0
        return n * (p * math.log(p / share) + ((1 - p) * math.log((1 - p) / (1 - share)) if p < 1 else 0.0))

    least = math.log(max(counts.count(), 1000) / CHANCE)
    # Each is more toxic than the share, so this is ``surprise``.
    n, p = F.col("clean") + F.col("toxic"), F.col("toxic") / (F.col("clean") + F.col("toxic"))
    found = n * (p * F.log(p / share) + F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - share))).otherwise(0.0))
    # Terms that beat chance.
    rows = [(bytes(r["term"]), r["stem"]) for r in counts.filter(found >= least).collect()]
    seen = context_counts(docs, rows)
    scores = [(surprise(*seen.get(k, (0, 0))), len(w), w, stem) for k, (w, stem) in enumerate(rows)]
    terms: list[tuple[bytes, bool]] = []
    for found, _, word, stem in sorted(scores, reverse=True):
        # Only whole words may be misspelled, so a stem does not shut them out.
        if found >= least and not (stem and any(word.startswith(t) or t.startswith(word) for t, _ in terms)):
            terms.append((word, stem))
    # Forms of a stem that are too rare to stand alone.
    stems, have = [t for t, stem in terms if stem], {t for t, stem in terms if not stem}
    begins = F.lit(False)
    for length in STEMS:
        own = [F.lit(t) for t in stems if len(t) == length]
        begins = begins | (F.substring("term", 1, length).isin(*own) if own else F.lit(False))
    words = [bytes(r["term"]) for r in counts.filter(~F.col("stem") & begins).select("term").collect()]
    dropped(counts)
    return terms + [(w, False) for w in sorted(words) if w not in have]


# --- automaton -----------------------------------------------------------------------------


def allowed(term: bytes) -> int:
    """Edits that a whole term may have."""
    return next((edits for size, edits in BUDGET if len(term) >= size), 0)


def lexicon_automaton(
    terms: list[tuple[bytes, bool]], most: Callable[[bytes], int] = lambda term: int(len(term) >= LONG), swaps: bool = False
) -> tuple[Automaton, np.ndarray]:
    """Trie of the terms intersected with their Levenshtein automata, and the symbol of each byte.

    Results are the number of edits. A stem accepts any ending. ``most``: edits that a whole
    term may have; ``swaps``: a swap of neighbours is one edit, not two.
    """
    alphabet = sorted({b for t, _ in terms for b in t})
    symbol = np.zeros(256, dtype=np.int32)
    symbol[alphabet] = np.arange(1, len(alphabet) + 1)
    trie: list[dict[int, int]] = [{}]
    whole: dict[int, int] = {}  # node: edits allowed at the end of a term
    stems: dict[int, int] = {}
    budget = [0]
    for term, stem in terms:
        edits = 0 if stem else most(term)
        at = 0
        budget[0] = max(budget[0], edits)
        for b in term:
            if b not in trie[at]:
                trie[at][b] = len(trie)
                trie.append({})
                budget.append(0)
            at = trie[at][b]
            budget[at] = max(budget[at], edits)
        (stems if stem else whole)[at] = edits

    # A state is a node, the edits so far and the symbol that ends a swap (or -1).
    def closed(states) -> set[tuple[int, int, int]]:
        """With letters left out of the word."""
        seen, todo = set(), list(states)
        while todo:
            node, edits, due = todo.pop()
            if (node, edits, due) not in seen:
                seen.add((node, edits, due))
                if due < 0:
                    todo += [(child, edits + 1, -1) for child in trie[node].values() if edits < budget[child]]
        return seen

    def step(state: tuple[int, int, int], s: int) -> set[tuple[int, int, int]]:
        node, edits, due = state
        if due >= 0:
            return closed([(node, edits, -1)] if s == due else [])
        after = [(node, edits, -1)] if node in stems and edits <= stems[node] else []
        for b, child in trie[node].items():
            if s and symbol[b] == s:
                after.append((child, edits, -1))
            elif edits < budget[child]:
                after.append((child, edits + 1, -1))
            if swaps and s:
                after += [(end, edits + 1, int(symbol[b])) for c, end in trie[child].items() if symbol[c] == s and b != c and edits < budget[end]]
        if edits < budget[node]:
            after.append((node, edits + 1, -1))
        return closed(after)

    def accept(state: tuple[int, int, int]) -> int | None:
        node, edits, due = state
        fits = (node in whole and edits <= whole[node]) or (node in stems and edits <= stems[node])
        return edits if fits and due < 0 else None

    return determinise(closed([(0, 0, -1)]), step, accept, len(alphabet) + 1), symbol


# --- documents -----------------------------------------------------------------------------


def quoted(words: Words, hit: int, row: int) -> bool:
    """Is the word reported rather than said?"""
    low, high = max(words.first[row], hit - WINDOW), min(words.first[row + 1], hit + WINDOW + 1)
    before = words.data[max(words.starts[low] - 3, words.bounds[row]) : words.starts[hit]].tobytes()
    after = words.data[words.ends[hit] : min(words.ends[high - 1] + 3, words.bounds[row + 1])].tobytes()
    marked = any(q in before for q in QUOTES) and any(q in after for q in QUOTES)
    return marked or any(words.text(i) in REPORTING for i in range(low, high) if i != hit)


#: Columns of the hits of a document.
FEATURES = ("exact", "near", "quoted")


def hits(docs: DataFrame, key: str, text: str, terms: list[tuple[bytes, bool]], more: tuple[str, ...] = ()) -> DataFrame:
    """Per document: exact hits, misspelled hits and quoted hits. ``more``: columns to keep."""
    automaton, symbol = lexicon_automaton(terms, allowed, swaps=True)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(key, *more).schema)
    edits = np.array([min(x) if x else 9 for x in automaton.labels])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in split(batch.column(batch.num_columns - 1), MARKS, lower=True):
                count = np.zeros((3, words.rows))
                code = symbol[words.data]
                for index, label in run(automaton, code, words.starts, words.ends, whole=True):
                    row = np.searchsorted(words.first, index, side="right") - 1
                    for i, r, e in zip(index.tolist(), row.tolist(), edits[label].tolist(), strict=True):
                        said = quoted(words, i, r)
                        count[2 if said else min(e, 1), r] += 1
                kept = [batch.column(i).slice(words.row0, words.rows) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, count)], names=[key, *more, *FEATURES])

    return docs.select(key, *more, text).mapInArrow(found, f"{kinds}, " + ", ".join(f"{f} double" for f in FEATURES))


def features(exact, near, quoted_):
    return np.stack([np.ones(len(exact)), exact > 0, np.log1p(exact), near > 0, np.log1p(near), np.log1p(quoted_)], axis=1).astype(float)


def train(labelled: DataFrame) -> tuple[list[tuple[bytes, bool]], np.ndarray]:
    """Lexicon and weights (logistic, with a small ridge) from all (text, toxic) rows."""
    terms = learn_lexicon(labelled)
    rows = written(hits(labelled, "toxic", "text", terms), "hits")
    count = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(count) < 2:
        weights = np.zeros(6)
        bad, good = count.get(1, 0), count.get(0, 0)
        weights[0] = math.log((bad + 1e-9) / (good + 1e-9)) if count else -30.0
        return terms, weights

    def examples(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        x = features(*(batch.column(f).to_numpy() for f in FEATURES))[:, 1:]
        return [(x, batch.column("toxic").to_numpy().astype(float), np.ones(len(x)))]

    (weights,) = logistic(rows, examples, [np.zeros(6)], lambda n, _: np.full(n, 0.1))
    dropped(rows)
    return terms, np.roll(weights, 1)


def score(docs: DataFrame, key: str, text: str, terms, weights: np.ndarray) -> DataFrame:
    """One row per document: key, the hits and the score."""
    w = [float(v) for v in weights]
    parts = [F.lit(1.0), (F.col("exact") > 0).cast("double"), F.log1p("exact"), (F.col("near") > 0).cast("double"), F.log1p("near"), F.log1p("quoted")]
    z = sum((part * v for part, v in zip(parts, w, strict=True)), F.lit(0.0))
    return hits(docs, key, text, terms).withColumn("score", 1 / (1 + F.exp(-z)))


def held_out(key: str):
    """Rows that nothing is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """Texts and labels of all labelled rows that are not held out."""
    rows = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key))
    rows = rows.groupBy(key).agg(F.max(label).cast("int").alias(label))
    rows = docs.select(F.col(key), F.col(text).alias("text")).join(broadcast_if_small(rows, rows.count()), key)
    return written(rows.select("text", label), "labelled")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text of ``documents``, learned from ``labels`` that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    terms, weights = train(labelled(docs, labels, "doc_id", "text", "toxic"))
    scored = score(docs, "doc_id", "text", terms, weights)
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= LIMIT).cast("int").alias("predicted"),
        *FEATURES,
    )
