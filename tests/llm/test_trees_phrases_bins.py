"""Merkle manifest, phrase collocations and packing by bin slack against brute force and SQL."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, prose, row
from tidegauge.llm import collocation, merkle, slack_packing
from tidegauge.llm.queries import QUERIES


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


def against_sql(spark, small, name, sql):
    con = duckdb.connect()
    con.execute(f"create view documents as from '{small}/documents.parquet'")
    df = QUERIES[name](spark, small)
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert tuples(df.select(*names)) == sorted(found.fetchall(), key=repr)


# --- Merkle manifest -----------------------------------------------------------------------


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, n_chars):
    values = (r.doc_id, r.source, r.lang, n_chars, r.text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree_of(leaves, arity):
    """Root, and for every leaf the sibling digests before and after it, level by level."""
    ways, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, place in enumerate(at):
            start = place - place % arity
            ways[i].append(("".join(nodes[start:place]), "".join(nodes[place + 1 : start + arity])))
            at[i] = place // arity
        nodes = [h(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
    return nodes[0], ways


def manifest_of(rows, arity):
    groups = defaultdict(list)
    for r in rows:
        groups[r.lang].append(r)
    out, subs = [], []
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.n_chars)))
        subs.append(tree_of([leaf_of(r, r.n_chars) for r in groups[g]], arity))
    root, tops = tree_of([s for s, _ in subs], arity)
    for g, (sub, ways), top in zip(order, subs, tops, strict=True):
        for r, way in zip(groups[g], ways, strict=True):
            out.append((r.doc_id, leaf_of(r, r.n_chars), sub, root, h(*[b + a for b, a in way + top])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("arity", [2, 3])
def test_manifest_by_hand(messy, arity):
    docs = messy.withColumn("path", F.lit("clash")).withColumn("tree", F.lit("clash")).withColumn("digest", F.lit(1))
    found = merkle.manifest(docs, arity=arity)
    got = found.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("p"))
    assert tuples(got) == manifest_of(messy.collect(), arity)
    assert found.filter(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root")).isEmpty()
    assert found.filter(merkle.folded(F.lit(h("other")), F.col("path")) == F.col("root")).isEmpty()


def test_manifest_of_few_rows(spark, nothing):
    assert merkle.manifest(nothing).count() == 0
    long = "é" * 3_000_000
    one = spark.createDataFrame([row(7, long)], SCHEMA)
    got = merkle.manifest(one).first()
    assert got.leaf == got.subroot == got.root == leaf_of(one.first(), len(long)) and got.path == []


def test_manifest_of_one_key(spark):
    rows = [row(3, "same")] * 40 + [row(None, None)] * 20 + [row(i, str(i), "fr") for i in range(9)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = merkle.manifest(docs).select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("p"))
    assert tuples(found) == manifest_of(docs.collect(), 2)


def test_merkle_sql(spark, small):
    against_sql(spark, small, "op11_merkle", merkle.SQL)


def test_tampered_rows_are_the_unverified(spark, small):
    found = QUERIES["op11_merkle"](spark, small).collect()
    bad = {r.doc_id for r in found if not r.verified}
    assert bad == {r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 7 == 0} and bad


# --- collocations --------------------------------------------------------------------------

STOP, BLANK = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def counts_of(rows):
    counts = defaultdict(Counter)
    for r in rows:
        text = (r.text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in STOP.split(text):
            w = BLANK.findall(piece)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    counts[r.lang or "und"][tuple(w[i : i + k])] += 1
    return counts


def collocations_of(rows, least, covered, top):
    out = []
    for lang, f in counts_of(rows).items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, longer in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    q = p[i : i + k]
                    if 100 * longer >= covered * often[q]:
                        gone.add(q)
        best = []
        for p, a in often.items():
            if p in gone:
                continue
            s, _, left, right = min((collocation.SCALE * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            best.append((-s, -a, " ".join(p).encode(), left, right))
        best.sort()
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(best[:top])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def spoken(spark, messy):
    rng = random.Random(5)
    words = ["Alpha", "beta", "gam\x0bma", "é", "delta.", "x,y", "\x00", "omega"]
    rows = [row(100 + i, " ".join(rng.choices(words, k=rng.randint(1, 60))), rng.choice(["en", "de", None, "und"])) for i in range(120)]
    passage = prose(400, 4)
    rows += [row(300 + i, passage) for i in range(4)] + [row(320 + i, "p q r " * 30) for i in range(3)]
    rows += [row(330, "s\t\tt  u. s t u! " * 9), row(331, "one. two. three"), row(332, "?!")]
    return messy.select(*[f.name for f in messy.schema]).unionByName(spark.createDataFrame(rows, SCHEMA))


@pytest.mark.parametrize("least, bits, top", [(2, 20, 2000), (3, 4, 7), (1, 12, 2000)])
def test_collocations_by_hand(spoken, least, bits, top):
    docs = spoken.withColumn("grp", F.lit("clash")).withColumn("n", F.lit("clash")).withColumn("phrase", F.lit(1))
    found = collocation.collocations(docs, least=least, bits=bits, top=top)
    assert tuples(found.select("grp", "rank", "phrase", "a", "l", "r", "n", "score")) == collocations_of(spoken.collect(), least, 80, top)


def test_collocations_of_nothing(spark, nothing):
    assert collocation.collocations(nothing).count() == 0
    assert collocation.collocations(spark.createDataFrame([row(1, None), row(2, " .\t")], SCHEMA)).count() == 0


def test_collocations_of_a_long_text(spark):
    """More words in one piece than a step of a task takes, and several MB of text."""
    text = " ".join(f"{i % 40009}x {i % 7}" for i in range(600_000))
    docs = spark.createDataFrame([row(1, text)], SCHEMA)
    assert tuples(collocation.collocations(docs, least=14, top=300)) == collocations_of(docs.collect(), 14, 80, 300)


def test_unary_paths(spark):
    def edges(words, n):
        return [("g", " ".join(words[i : i + 4]), n) for i in range(len(words) - 3)]

    line = [f"a{i}" for i in range(700)]
    ring = [f"r{i}" for i in range(300)]
    rows = edges(line, 40) + edges(ring + ring[:3], 50) + edges(["s"] * 4, 31)
    rows += edges(["f1", "f2", "f3", "f4", "f5"], 33) + edges(["f2", "f3", "f4", "f6"], 33)
    rows += edges(["w1", "w2", "w3", "w4"], 30) + edges(["w2", "w3", "w4", "w5"], 31)
    heavy = spark.createDataFrame(rows, "grp string, phrase string, n long")
    paths = collocation.compacted(heavy)
    assert tuples(collocation._opened(paths)) == sorted(rows, key=repr)
    held = sorted(r.edges for r in paths.collect())
    # The line in three rows, the ring in two, the loop, the fork's three and the two weights apart.
    assert held == sorted([256, 256, 697 - 512, 256, 44, 1, 1, 1, 1, 1, 1])


def test_collocation_sql(spark, small):
    against_sql(spark, small, "op12_collocations", collocation.SQL)


# --- packing by bin slack ------------------------------------------------------------------


@pytest.fixture(scope="module")
def words():
    return slack_packing.Vocabulary.public()


@pytest.fixture(scope="module")
def whole(words):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(words.vocabulary)


def ids_of(whole, text):
    return [*whole.encode(text or "", add_special_tokens=False).ids, 2]


def test_ids_are_the_tokenizers(words, whole):
    ids = words.ids()
    points = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c}{c} 1{c}2,{c},  {c}  x \n{c}'s" for c in points]
    texts += ["", " ", "a<|endoftext|>b <|endoftext|><|endoftext|> ", "a <|endo", " " * 5000 + "x", "\n" * 900, "é" * 20000, "don't  DON'T"]
    for text, want in zip(texts, whole.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids(text), "<u4").tolist() == want.ids, text[:40]


@pytest.mark.parametrize("seed", range(30))
def test_fullest_combination(seed):
    rng = random.Random(seed)
    capacity = rng.randint(5, 24)
    items = [rng.randint(1, capacity) for _ in range(9)]
    counts = [items.count(v) for v in range(capacity + 1)]
    must = max(items)
    chosen = slack_packing.fullest(counts, capacity, must)
    rest = items.copy()
    rest.remove(must)
    sums = {sum(c) for k in range(len(rest) + 1) for c in itertools.combinations(rest, k)}
    assert sum(v * m for v, m in chosen.items()) == must + max(s for s in sums if s <= capacity - must)
    assert all(m <= counts[v] for v, m in chosen.items()) and chosen[must] >= 1


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    counts = {v: rng.choice([1, 2, 5, 900]) for v in rng.sample(range(1, 65), 25)}
    plan = slack_packing.plan(counts, 64)
    lengths = np.repeat(list(counts), list(counts.values()))
    ranks = np.concatenate([np.arange(n) for n in counts.values()])
    sequence, offset = slack_packing.place(lengths, ranks, plan)
    bins = defaultdict(list)
    for s, o, v in zip(sequence, offset, lengths, strict=True):
        bins[s].append((o, v))
    assert len(bins) == plan.sequences
    for held in bins.values():
        at = 0
        for o, v in sorted(held):
            assert o == at
            at += v
        assert at <= 64
    assert plan.sequences <= first_fit(lengths, 64)


def first_fit(lengths, capacity):
    """Bins of first fit, longest first."""
    room = []
    for v in sorted(map(int, lengths), reverse=True):
        for i, r in enumerate(room):
            if r >= v:
                room[i] -= v
                break
        else:
            room.append(capacity - v)
    return len(room)


def packed_rightly(rows, docs, whole, capacity):
    want, held = Counter(), defaultdict(list)
    for r in docs:
        ids = np.array(ids_of(whole, r.text), "<u4")
        first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want[r.doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for inside in held.values():
        ends = [0, *itertools.accumulate(n for _, n in sorted(inside))]
        assert [o for o, _ in sorted(inside)] == ends[:-1] and ends[-1] <= capacity
    return len(held)


@pytest.mark.parametrize("capacity", [1024, 50])
def test_packing_of_messy_rows(messy, words, whole, capacity):
    docs = messy.withColumn("length", F.lit("clash")).withColumn("task", F.lit("clash")).withColumn("body", F.lit(1))
    rows = slack_packing.pack(docs, words, capacity=capacity).collect()
    packed_rightly(rows, messy.collect(), whole, capacity)


def test_packing_of_hot_lengths_and_long_texts(spark, words, whole):
    """Half of all rows have one length; one text has several MB."""
    rows = [row(i, "alpha beta") for i in range(300)] + [row(1000 + i, prose(i % 90, i)) for i in range(300)] + [row(5000, prose(600_000, 2))]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = slack_packing.pack(docs, words).collect()
    used = packed_rightly(found, docs.collect(), whole, 1024)
    assert used == -(-sum(r.length for r in found) // 1024)


def test_packing_of_nothing(nothing, words):
    assert slack_packing.pack(nothing, words).count() == 0


def test_packing_query(spark, small, whole):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    rows = QUERIES["op13_bin_slack"](spark, small).collect()
    used = packed_rightly(rows, docs, whole, 1024)
    assert used <= first_fit([r.length for r in rows], 1024)
