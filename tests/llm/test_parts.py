"""Helpers against brute force."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidegauge.llm import decontam, jaccard, license_scan, packing, quality, reshard, substring, toxicity
from tidegauge.llm.fm_index import FMIndex, Wavelet, suffix_array
from tidegauge.llm.words import BLANKS, MARKS, mix, split

TEXTS = st.lists(st.one_of(st.none(), st.text("aB \n\x0bé.9-", max_size=12)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    for separators, lower, pattern in (
        (BLANKS, False, r"[^\x20\x09-\x0D]+"),
        (MARKS, True, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
    ):
        got = []
        for words in split(pa.array(texts, pa.string()), separators, lower):
            got += [[words.text(i).decode() for i in range(a, b)] for a, b in itertools.pairwise(words.first.tolist())]
        plain = [(t or "").translate({c: c + 32 for c in range(65, 91)} if lower else {}) for t in texts]
        assert got == [re.findall(pattern, t) for t in plain]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    (words,) = split(pa.array(["one two", None, "two  one one"]), BLANKS, False)
    h = words.hashes()
    assert h[0] == h[3] == h[4] and h[1] == h[2] and h[0] != h[1]


def test_a_slice_never_splits_a_row(monkeypatch):
    monkeypatch.setattr("tidegauge.llm.words.SLICE", 5)
    texts = pa.array(["aa bb cc dd", "", None, "e", "ff gg"])
    got = [(w.row0, w.rows, len(w.starts)) for w in split(texts, BLANKS, False)]
    assert sum(r for _, r, _ in got) == 5 and sum(n for _, _, n in got) == 7


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=60))
def test_suffix_array_and_wavelet(text):
    text = np.array(text)
    order = suffix_array(text, len(text) + 1)
    assert sorted(range(len(text)), key=lambda i: text[i:].tolist()) == order.tolist()
    wavelet = Wavelet(text, 6)
    for c in range(6):
        at = np.arange(len(text) + 1)
        want = np.concatenate(([0], np.cumsum(text == c)))
        assert wavelet.rank(np.full(len(at), c), at).tolist() == want.tolist()


def test_fm_index_finds_the_repeated_windows():
    rng = np.random.default_rng(0)
    for t in range(60):
        base = rng.integers(0, 3 + t % 7, 60)
        sequences = []
        for _ in range(rng.integers(1, 12)):
            i = rng.integers(0, 40)
            s = base[i : i + rng.integers(5, 30)].copy()
            if rng.random() < 0.5:
                s[rng.integers(0, len(s))] = rng.integers(0, 12)
            sequences.append(s)
        weight, width = rng.integers(1, 3, len(sequences)), int(rng.integers(2, 9))
        count = Counter()
        for s, k in zip(sequences, weight, strict=True):
            for i in range(len(s) - width + 1):
                count[tuple(s[i : i + width])] += int(k)
        bounds = np.concatenate(([0], np.cumsum([len(s) for s in sequences])))
        index = FMIndex(np.concatenate(sequences).astype(np.uint64) * np.uint64(7919), bounds, weight)
        for s, got in zip(sequences, index.repeated_windows(width), strict=True):
            assert list(got) == [count[tuple(s[i : i + width])] >= 2 for i in range(max(0, len(s) - width + 1))]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab \n", max_size=14), min_size=1, max_size=5), st.integers(0, 2**30))
def test_digest_of_kept_words(texts, seed):
    for words in split(pa.array(texts), BLANKS, False):
        keep = np.random.default_rng(seed).random(len(words.starts)) < 0.6
        want = []
        for a, b in itertools.pairwise(words.first.tolist()):
            left = b" ".join(words.text(i) for i in range(a, b) if keep[i])
            want.append(hashlib.sha256(left).hexdigest())
        assert substring.joined(words, keep) == want


def test_boundaries_pad_least():
    rng = np.random.default_rng(1)
    for _ in range(120):
        histogram = {int(v): int(c) for v, c in zip(rng.integers(1, 60, 9), rng.integers(1, 9, 9), strict=True)}
        buckets, values = int(rng.integers(1, 6)), sorted(histogram)

        def padding(ends, histogram=histogram):
            return sum(c * (min(e for e in ends if e >= v) - v) for v, c in histogram.items())

        best = min(padding((*c, values[-1])) for r in range(min(buckets, len(values))) for c in itertools.combinations(values[:-1], r))
        ends = packing.boundaries(histogram, buckets)
        assert len(ends) <= buckets and padding(ends) == best
    assert packing.boundaries({}, 3) == []


def test_flow_moves_the_fewest_bytes():
    rng = np.random.default_rng(2)
    for _ in range(80):
        supply = rng.integers(0, 9, rng.integers(1, 5)).tolist()
        m = int(rng.integers(1, 5))
        capacity = [sum(supply) // m + (j < sum(supply) % m) for j in range(m)]
        cost = [[int(i != j) for j in range(m)] for i in range(len(supply))]
        flow = reshard.min_cost_flow(supply, capacity, cost)
        assert [sum(row) for row in flow] == supply
        assert all(sum(row[j] for row in flow) <= capacity[j] for j in range(m))
        assert sum(flow[i][i] for i in range(min(m, len(supply)))) == sum(map(min, supply, capacity))


def test_flow_takes_a_detour_when_it_is_cheaper():
    assert reshard.min_cost_flow([3, 2], [2, 3], [[1, 5], [1, 2]]) in ([[2, 1], [0, 2]], [[2, 1], [0, 2]])
    flow = reshard.min_cost_flow([2, 2], [2, 2], [[1, 2], [1, 9]])
    assert flow == [[0, 2], [2, 0]]


def _edits(a: bytes, b: bytes) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abx", min_size=1, max_size=8), min_size=1, max_size=12))
def test_lexicon_automaton_counts_edits(words):
    terms = [(b"abab", False), (b"aabba", False), (b"xax", True)]
    automaton, symbol = toxicity.lexicon_automaton(terms)
    for word in words:
        state = 1
        for byte in word.encode():
            state = automaton.table[state, symbol[byte]]
        got = automaton.labels[automaton.label[state]]
        want = {_edits(word.encode(), t) for t, stem in terms if not stem and _edits(word.encode(), t) <= (len(t) >= 5)}
        if word.startswith("xax"):
            want.add(0)
        assert (min(got) if got else None) == (min(want) if want else None)


def test_quotation_is_told_from_abuse():
    def hit(text):
        (words,) = split(pa.array([text]), MARKS, True)
        at = next(i for i in range(len(words.starts)) if words.text(i) == b"idiot")
        return toxicity.quoted(words, at, 0)

    assert not hit("you are an idiot and that is all")
    assert hit('he was named "an idiot" by them')
    assert hit("she said idiot to the man")
    assert not hit("idiot")


def test_template_markup():
    automaton, vocabulary = license_scan.compile_templates({("x", False): "a <<beginOptional>>b c<<endOptional>> <<var;match=number;words=0-1>> d"})

    def accepts(text):
        state = 1
        for w in text.split():
            state = automaton.table[state, vocabulary.get(w, 1 if w.isdigit() else 0)]
        return bool(automaton.labels[automaton.label[state]])

    assert all(map(accepts, ["a d", "a b c d", "a 7 d", "a b c 7 d"]))
    assert not any(map(accepts, ["a", "a b d", "a 7 7 d", "a x d", "d", "a d d"]))


def test_light_and_heavy_sizes():
    for s in range(1, 200):
        for t in jaccard.partners(s, 85):
            i = jaccard.need(s, t, 85)
            assert i <= min(s, t) and 100 * i >= 85 * (s + t - i) and 100 * (i - 1) < 85 * (s + t - i + 1)
        assert 100 * (s + 1) < 85 * (jaccard.partners(s, 85)[-1] + 1) * 2
    assert 10 <= jaccard.boundary(85) <= 19


@pytest.mark.parametrize("percent", [80, 85, 90])
def test_linked_sets_differ_in_fewer_shingles_than_blocks(percent):
    sizes = np.arange(jaccard.BLOCKED, 3000)
    blocks = 2 ** jaccard.block_level(sizes, percent)
    for a, m in zip(sizes.tolist(), blocks.tolist(), strict=True):
        assert all(a + b - 2 * jaccard.need(a, b, percent) < m for b in jaccard.partners(a, percent) if b >= a)


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_heavy_sets_share_a_list(percent):
    rng = np.random.default_rng(3)
    for size in (*range(14, 90), 150, 400, 900):
        for _ in range(6):
            a = rng.integers(1, 2**63, size, dtype=np.uint64)
            t = int(rng.choice(list(jaccard.partners(size, percent))))
            if min(t, size) <= jaccard.boundary(percent):
                continue
            shared = jaccard.need(size, t, percent)
            b = np.concatenate((rng.permutation(a)[:shared], rng.integers(1, 2**63, t - shared, dtype=np.uint64)))
            rows = np.repeat([0, 1], [len(a), len(b)])
            row, key = jaccard.list_keys(2, rows, np.concatenate((np.sort(a), np.sort(b))), jaccard.boundary(percent), percent)
            assert set(key[row == 0].tolist()) & set(key[row == 1].tolist()), (size, t)


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("size", [48, 60, 100, 200])
def test_sets_that_agree_in_empty_blocks_only_share_a_list(percent, size):
    """One shingle of each full block differs, which hashed shingles hardly ever do."""
    rng = np.random.default_rng(8)
    most = int(size * jaccard.differing(percent))
    for grow in range(size // 10):
        changed = most - grow
        values = rng.integers(1, 2**63, 400 * size, dtype=np.uint64)
        blocks = 2 ** int(jaccard.block_level(np.array([size]), percent)[0])
        at = (mix(values ^ np.uint64(0xB10C)) % np.uint64(blocks)).astype(np.int64)
        few = values[at < changed // 2]
        a = few[:size]
        block = at[at < changed // 2]
        new = [int(np.flatnonzero(block[size:] == k)[0]) + size for k in range(changed // 2)]
        old = [int(np.flatnonzero(block[:size] == k)[0]) for k in range(changed // 2) if (block[:size] == k).any()]
        b = np.concatenate((np.delete(a, old), few[new]))
        both = len(np.intersect1d(a, b))
        if 100 * both < percent * (len(a) + len(b) - both):
            continue
        rows = np.repeat([0, 1], [len(a), len(b)])
        row, key = jaccard.list_keys(2, rows, np.concatenate((np.sort(a), np.sort(b))), jaccard.boundary(percent), percent)
        assert set(key[row == 0].tolist()) & set(key[row == 1].tolist())


def test_longest_common_subsequence():
    rng = np.random.default_rng(4)
    for _ in range(50):
        a, b = rng.integers(0, 5, rng.integers(1, 30)).tolist(), rng.integers(0, 5, rng.integers(0, 40)).tolist()
        masks = {}
        for i, w in enumerate(a):
            masks[w] = masks.get(w, 0) | (1 << i)
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], max(row[j], row[j - 1], last + (x == y))
        assert decontam.common(masks, len(a), b) == row[-1]


def test_lookup_loses_no_stretch():
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in range(40)]
    for _ in range(30):
        items = [" ".join(rng.choice(words, rng.integers(1, 12))) + "." * int(rng.integers(0, 2)) + " " + " ".join(rng.choice(words, rng.integers(1, 3))) for _ in range(6)]
        made = [decontam.Item(k, decontam.word_list(t), decontam.word_list(decontam.answer(t))) for k, t in enumerate(items)]
        texts = [" ".join(rng.choice(words, rng.integers(0, 130))) for _ in range(5)]
        norm = rng.random(decontam.HASHED)
        lookup = decontam.Lookup(made, norm)
        (split_,) = split(pa.array(texts), MARKS, lower=True)
        code, first = split_.hashes(), split_.first
        got = list(lookup.places(code, split_.row_of(), first))
        for k, item in enumerate(made):
            n, masks = len(item.words), {}
            for i, w in enumerate(item.words):
                masks[w] = masks.get(w, 0) | (1 << i)
            for r in range(len(texts)):
                for a in range(first[r], first[r + 1]):
                    part = code[a : min(a + decontam.reach(n), first[r + 1])].tolist()
                    share = decontam.common(masks, n, part) / n
                    if share >= decontam.SURE or (share >= decontam.LIKELY and decontam.holds(part, item.answer)):
                        assert any(k == i and low <= a <= high for i, low, high in got)


def test_views_of_odd_texts():
    content, page = quality.views(pa.array([None, "", "A b\n9!", "x" * 3000]), pa.array([None, "en", "en", None]), pa.array(["s", None, "s", "s"]), pa.array([None, 0, 6, 3000], pa.int64()))
    assert content.shape == (4, quality.PAIRS) and page.shape == (4, quality.PAGE)
    assert not content[0].any() and np.isfinite(page).all()
    assert np.allclose((content[2:] ** 2).sum(axis=1), 1)


def test_substring_search_leaves_no_finished_tables(spark, messy, tmp_path, monkeypatch):
    """Lists of anchors and pieces go as soon as what is read from them is stored."""
    from tidegauge.llm import store, substring

    monkeypatch.setattr(store, "folder", lambda spark, name: f"{tmp_path}/{name}")
    found = substring.repeated(messy).collect()
    assert len(found) == messy.count() and any(r["n_removed"] for r in found)
    assert {p.name for p in tmp_path.iterdir()} == {"places", "marked", "found"}


def test_shuffles_of_a_stored_table_go_with_its_write(spark):
    """No garbage collection of the driver is needed, and the setting is as before."""
    import time
    from pathlib import Path

    from tidegauge.llm import store

    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    there = lambda: {p.name for d in blocks.localDirs() for p in Path(d.getPath()).rglob("shuffle_*")}
    before, setting = there(), spark.conf.get(store.CLEANUP, None)
    rows = spark.range(1000).withColumnRenamed("id", "a").repartition(4, "a").groupBy("a").count()
    table = store.written(rows, "counted")
    for _ in range(50):
        if not (left := there() - before):
            break
        time.sleep(0.1)
    assert not left and table.count() == 1000
    assert spark.conf.get(store.CLEANUP, None) == setting


def test_latent_space_is_that_of_all_passages(spark):
    """The leading singular vectors are those of the whole matrix, by numpy."""
    rng = np.random.default_rng(5)
    themes = [[f"w{t}x{k}" for k in range(12)] for t in range(6)]
    texts = [" ".join(rng.choice(themes[min(i // 500, 5)], 70)) for i in range(2600)] + [None, ""]
    stored = decontam.stored_passages(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5))
    count, n = decontam.passage_counts(stored)
    passages = []
    for words in split(pa.array(texts), MARKS, lower=True):
        d = decontam.dims(words)
        for r in range(words.rows):
            own = d[words.first[r] : words.first[r + 1]].tolist()
            passages += [Counter(own[a : a + decontam.PASSAGE]) for a in range(0, len(own), decontam.PASSAGE)]
    assert n == len(passages) and count.sum() == sum(map(len, passages))
    idf = np.log((n + 1) / (count + 1)).clip(0)
    some = sorted({d for p in passages for d in p})
    at = {d: i for i, d in enumerate(some)}
    x = np.zeros((n, len(some)))
    for i, p in enumerate(passages):
        length = np.sqrt(sum((c * idf[d]) ** 2 for d, c in p.items()))
        for d, c in p.items():
            x[i, at[d]] = c * idf[d] / length
    found = decontam.randomised_svd(stored.selectExpr("*", "1D AS weight"), idf, 60)[:, :6]
    _, size, want = np.linalg.svd(x, full_matrices=False)
    # Six themes: the same six directions, those of documents that a sample of 2,000 may miss too.
    assert np.allclose(np.linalg.norm(x @ found[some], axis=0), size[:6], rtol=1e-3)
    assert np.allclose(np.linalg.norm(want[:6] @ found[some], axis=0), 1, atol=1e-2)
