"""Operators on messy rows and on the given tables, against SQL or brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import prose
from tidegauge.llm import decontam, exact_stream, jaccard, license_scan, packing, quality, reshard, substring, toxicity, url_filter
from tidegauge.llm.graph import components
from tidegauge.llm.numbering import running
from tidegauge.llm.queries import QUERIES, SQL

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def tuples(df, names=None):
    return sorted(map(tuple, (df.select(*names) if names else df).collect()), key=repr)


# --- exact dedup ---------------------------------------------------------------------------


def _exact(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[lower(text)].append(doc)
    out = []
    for docs in groups.values():
        keep = max(docs, key=lambda d: (d is not None, d or 0))
        out += [(d, keep, len(docs)) for d in docs]
    return sorted(out, key=repr), len(groups)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(messy, weak):
    digest = (lambda t: F.length(t) % 3) if weak else exact_stream.sha256
    found = exact_stream.copies(messy, digest=digest).collect()
    want, groups = _exact([(r.doc_id, r.text) for r in messy.collect()])
    assert sorted(((r.doc, r.keep.doc, r.n) for r in found), key=repr) == want
    assert sum(r.row == r.keep.row for r in found) == groups


def test_exact_state_goes_on(spark, tmp_path):
    def batch(rows, name):
        frame = spark.createDataFrame(rows, "doc long, row long, place string, digest string")
        frame.write.mode("append").parquet(str(tmp_path / "inbox"))
        return exact_stream.run_state(frame, *(str(tmp_path / x) for x in ("inbox", "state", "stream")))

    batch([(1, 1, "a", "x"), (2, 2, "a", "y")], 0)
    seen = {r.digest: (r.n, r.keep.doc) for r in batch([(5, 3, "b", "x"), (0, 4, "b", "y")], 1).collect()}
    assert seen == {"x": (2, 5), "y": (2, 2)}


def test_exact_kept(messy, nothing):
    left = exact_stream.kept(messy)
    assert left.columns == messy.columns
    _, groups = _exact([(r.doc_id, r.text) for r in messy.collect()])
    texts = [lower(r.text) for r in left.collect()]
    assert len(texts) == len(set(texts)) == groups
    assert exact_stream.kept(nothing).count() == 0 and exact_stream.copies(nothing).count() == 0


# --- substring dedup -----------------------------------------------------------------------


def _windows(rows, width):
    count, out = Counter(), []
    for _, text in rows:
        w = BLANK.findall(text or "")
        count.update(tuple(w[i : i + width]) for i in range(len(w) - width + 1))
    for doc, text in rows:
        w = BLANK.findall(text or "")
        gone = set()
        for i in range(len(w) - width + 1):
            if count[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), __import__("hashlib").sha256(left.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width, hot", [(35, 1000), (35, 1), (12, 2)])
def test_repeated_windows(messy, width, hot):
    want = _windows([(r.doc_id, r.text) for r in messy.collect()], width)
    assert tuples(substring.repeated(messy, width=width, hot=hot)) == want


def test_repeated_windows_of_nothing(nothing):
    assert substring.repeated(nothing).count() == 0


# --- Jaccard join --------------------------------------------------------------------------


def _linked(rows, n=4, percent=85):
    sets = []
    for _, text in rows:
        w = BLANK.findall(lower(text))
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted(((doc, len(s), least.get(top(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def test_jaccard_on_messy_rows(messy, nothing):
    want = _linked([(r.doc_id, r.text) for r in messy.collect()])
    # Null ids with an empty set stand alone.
    assert tuples(jaccard.groups(messy)) == want
    assert jaccard.groups(nothing).count() == 0
    left = jaccard.kept(messy)
    assert left.columns == messy.columns
    keep = {doc for doc, _, group in want if doc == group}
    assert {r.doc_id for r in left.collect()} == keep


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80)])
def test_jaccard_chains_and_stars(spark, n, percent):
    """Near copies of one text that are not near each other, chains, and all small sizes."""
    base = prose(150, 2).split()
    rows = [(0, " ".join(base))]
    for i in range(60):
        w = list(base)
        for k in range(1 + i % 6):
            w[(7 * i + 23 * k) % 150] = f"new{i}x{k}"
        rows.append((len(rows), " ".join(w)))
    chain = prose(60, 4).split()
    for i in range(12):
        chain = [*chain[2:], f"c{i}", f"d{i}"]
        rows.append((len(rows), " ".join(chain)))
    for size in range(1, 60):
        w = prose(size, 100 + size).split()
        rows.append((len(rows), " ".join(w)))
        rows.append((len(rows), " ".join([*w[:-1], "other"]) if size % 2 else " ".join([*w, "other"])))
    rows = [(len(rows) - i, t) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert tuples(jaccard.groups(docs, n=n, percent=percent)) == _linked(rows, n, percent)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[i] == 100 for i in range(101, 130))


# --- resharding, packing, numbering ---------------------------------------------------------


def test_running_sums(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 3)
    rows = running(df, "g", ["id"], F.lit(1).cast("long"), 500, "at").collect()
    for g in range(3):
        assert sorted(r["at"] for r in rows if r.g == g) == list(range(len([r for r in rows if r.g == g])))


def test_reshard(messy, nothing):
    def placed(df):
        return reshard.reshard(reshard.sized(df, "doc_id", "text", F.pmod(F.xxhash64("source"), F.lit(3))), "doc_id", 4)

    rows = placed(messy).collect()
    assert len(rows) == messy.count() and placed(nothing).count() == 0
    for r in messy.select("doc_id", "text").distinct().collect():
        body = (r.text or "").encode()
        assert any(x.doc_id == r.doc_id and x["size"] == len(body) + 1 and x.text_crc32 == zlib.crc32(body) for x in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_reshard_moves_only_the_surplus(spark, small, tmp_path):
    placed = reshard.op4_reshard(spark, small).cache()
    rows = placed.collect()
    size, old = Counter(), Counter()
    for r in rows:
        size[r.shard] += r["size"]
        old[r.old_shard] += r["size"]
    total, largest = sum(size.values()), max(r["size"] for r in rows)
    assert max(size.values()) - min(size.values()) <= 2 * largest
    moved = sum(r["size"] for r in rows if r.shard != r.old_shard)
    surplus = sum(max(0, b - total // 16) for b in old.values())
    assert abs(moved - surplus) <= 16 * largest
    docs = spark.read.parquet(f"{small}/documents.parquet")
    reshard.rewrite(docs, placed, "doc_id", str(tmp_path / "new"))
    new = spark.read.parquet(str(tmp_path / "new")).select("doc_id", "shard").collect()
    place = {r.doc_id: r.shard for r in rows}
    assert new and all(place[r.doc_id] == r.shard for r in new)
    assert {r.doc_id for r in rows if r.shard != r.old_shard} <= {r.doc_id for r in new}


def test_resharding_writes_the_touched_shards_only(spark, messy, nothing, tmp_path):
    """All rows, repeated ones and null ids too; the shard that neither sends nor gets stays."""
    docs = messy.withColumn("of", F.when(F.col("doc_id").isin(5, 6, 7), 0).when(F.col("doc_id") == 8, 1).otherwise(2))
    kept = sum(len(r.text or "") + 1 for r in docs.filter("of = 0").collect())
    path = str(tmp_path / "shards")
    rows = reshard.moved(docs, "doc_id", "text", F.col("of"), path, 3, [kept, 10**6, 20_000]).collect()
    files = spark.read.parquet(path)
    assert {p.name for p in (tmp_path / "shards").glob("shard=*")} == {"shard=1", "shard=2"}
    whole = lambda df: sorted(map(repr, df.select(*docs.columns).collect()))
    assert whole(files) == whole(docs.filter("of > 0"))
    want = Counter((r.doc_id, r.shard, zlib.crc32((r.text or "").encode())) for r in files.collect())
    want.update((r.doc_id, 0, zlib.crc32((r.text or "").encode())) for r in docs.filter("of = 0").collect())
    assert Counter((r.doc_id, r.shard, r.text_crc32) for r in rows) == want
    for shard in range(3):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert reshard.moved(nothing, "doc_id", "text", F.lit(1), str(tmp_path / "none"), 3).count() == 0


def test_op4_rewrites_files(spark, small, tmp_path, monkeypatch):
    from tidegauge.llm import store

    for module in (store, reshard):
        monkeypatch.setattr(module, "folder", lambda spark, name: f"{tmp_path}/{name}", raising=False)
    rows = reshard.op4_reshard(spark, small).collect()
    files = spark.read.parquet(f"{tmp_path}/shards").select("doc_id", "text", "shard").collect()
    touched = {s for r in rows if r.shard != r.old_shard for s in (r.shard, r.old_shard)}
    assert touched and {(r.doc_id, r.shard) for r in rows if r.shard in touched} == {(r.doc_id, r.shard) for r in files if r.shard in touched}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert len(rows) == len(docs) and all(docs[r.doc_id] == r.text for r in files)


def test_packing(messy, nothing):
    rows = packing.pack(messy, buckets=3, budget=200).collect()
    assert len(rows) == messy.count() and packing.pack(nothing).count() == 0
    texts = Counter(len(BLANK.findall(r.text or "")) + 1 for r in messy.collect())
    assert Counter(r.n_tokens for r in rows) == texts
    ends = packing.boundaries(texts, 3)
    assert {r.bucket_tokens for r in rows} == set(ends)
    batches = defaultdict(list)
    for r in rows:
        assert r.n_tokens <= r.bucket_tokens and r.padding == r.bucket_tokens - r.n_tokens
        batches[r.bucket, r.batch].append(r)
    for own in batches.values():
        assert len(own) * own[0].bucket_tokens <= 200 or len(own) == 1
        assert sorted(r.slot for r in own) == list(range(len(own)))


def test_long_lengths_are_rounded_up(spark):
    lengths = [1, 65_535, 65_536, 65_537, 131_073, 10**7 + 1]
    rows = spark.createDataFrame([(v,) for v in lengths], "v long").select("v", packing.coarse(F.col("v")).alias("c")).collect()
    assert all(r.c >= r.v and r.c <= r.v * (1 + 2**-14) for r in rows) and [r.c for r in rows][:3] == lengths[:3]


# --- scans ---------------------------------------------------------------------------------


def test_license_scan_on_messy_rows(messy, nothing, spark, in_duckdb):
    more = spark.createDataFrame(
        [
            (101, "Licensed under the terms of the GNU General Public License, version 3. MIT License MIT license"),
            (102, "GNU General Public\nLicense; CC BY-NC 4.0. Licensed under CC BY-NC 4.0"),
            (103, "Licensed under the Apache License, Version 2.0 and the éapache license"),
            (104, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software to deal in the Software without restriction"),
            (105, "under the MIT License"),
            (106, "x under the terms of the MIT License"),
        ],
        "doc_id long, text string",
    )
    docs = messy.select("doc_id", "text").union(more)
    names, want = in_duckdb(docs, SQL["op5_license_scan"])
    assert tuples(license_scan.scan(docs), names) == want
    assert license_scan.scan(nothing).count() == 0
    found = {r.doc_id: r.labels for r in license_scan.scan(more).collect()}
    assert found[104] == "mit-grant" and found[105] == "mit" and found[106] == "mit,mit-notice"


def test_toxicity_learns_and_catches_misspellings(spark):
    bad = ["wretch", "nitwit", "dolt"]
    rows = []
    for i in range(400):
        w = prose(30, i).split()
        if i % 4 == 0:
            w.insert(i % 25, bad[i % 3])
        rows.append((" ".join(w), int(i % 4 == 0)))
    terms, weights = toxicity.train(spark.createDataFrame(rows, "text string, toxic int"))
    assert {t for t, _ in terms} == {b.encode() for b in bad}
    docs = spark.createDataFrame([(1, "you are a wretch today"), (2, "a kind person"), (3, None), (4, ""), (5, "what a wretsh you are"), (1, "you are a wretch today")], "doc_id long, text string")
    score = {r.doc_id: (r.score, r.near) for r in toxicity.score(docs, "doc_id", "text", terms, weights).collect()}
    assert score[1][0] > 0.5 > score[2][0] == score[3][0] == score[4][0]
    assert score[5][1] == 1


def test_toxicity_catches_misspellings_of_inflected_and_short_terms(spark):
    bad = ["idiot", "idiots", "idiott", "scum"]
    rows = []
    for i in range(600):
        w = prose(30, i).split()
        if i % 3 == 0:
            w.insert(i % 25, bad[i // 3 % 4])
        rows.append((" ".join(w), int(i % 3 == 0)))
    terms, weights = toxicity.train(spark.createDataFrame(rows, "text string, toxic int"))
    wrong = ["idjot", "1diot", "id1ot", "idoit", "idjots", "scmu", "scvm"]
    docs = spark.createDataFrame([*((i, f"what a {w} you are") for i, w in enumerate(wrong)), (98, "such idiotic talk"), (99, "a kind person")], "doc_id long, text string")
    score = {r.doc_id: (r.exact, r.near) for r in toxicity.score(docs, "doc_id", "text", terms, weights).collect()}
    assert [score[i] for i in range(len(wrong))] == [(0, 1)] * len(wrong)
    assert score[98][0] == 1 and score[99] == (0, 0)


def test_toxicity_without_labels(spark, messy, nothing):
    terms, weights = toxicity.train(spark.createDataFrame([], "text string, toxic int"))
    assert terms == []
    assert all(r.score < 0.3 for r in toxicity.score(messy, "doc_id", "text", terms, weights).collect())
    assert toxicity.score(nothing, "doc_id", "text", terms, weights).count() == 0


def test_toxicity_on_held_out_labels(spark, small):
    rows = toxicity.op7_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic"), "doc_id")
    rows = [(r.toxic, r.predicted) for r in rows.filter("held_out").collect()]
    hit = sum(t and p for t, p in rows)
    assert hit >= 0.85 * sum(t for t, _ in rows) and hit >= 0.85 * sum(p for _, p in rows)


def _url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = lower(host)
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_url_rules_and_model(spark):
    urls = [None, "", "no scheme", "http://", "https://Example.ORG/es/1?q#f", "https://a.example.org/en/12", "http://xexample.org/es/",
            "http://com/fr/", "http://b.com/de/x://y", "http://b.com/de", "http://h?x", "http://h#x", "http://org", "http://cheap-pills.example.net/en/1",
            "http://blog.therti.example.net/en/5", "http://blog.therti.example.net/en/5"]
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], "page_id long, url string, label string, html string")
    model = url_filter.train(url_filter.labelled_urls(spark))
    rows = {r.page_id: r for r in url_filter.judge(pages, model).collect()}
    for i, u in enumerate(urls):
        host, path, rule, verdict = _url(u)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule), u
        assert rows[i].verdict == (verdict or rows[i].verdict) and rows[i].verdict in ("allow", "block")
    assert rows[13].verdict == "block" and rows[14].verdict == rows[15].verdict == "allow"
    assert url_filter.judge(pages.limit(0), model).count() == 0


# --- decontamination and quality ------------------------------------------------------------


def test_decontamination(spark, messy, nothing):
    items = [(i, prose(15 + 2 * i, 500 + i).capitalize() + ". The answer is " + prose(3, 900 + i) + ".") for i in range(20)]
    benchmark = spark.createDataFrame([*items, (98, None), (99, ""), (None, "x")], "item_id long, text string")
    rows = []
    for i, (_, t) in enumerate(items):
        w = t.split()
        near = [x if k % 9 else "changed" for k, x in enumerate(w)]
        rows += [(1000 + i, prose(100, i) + " " + t.upper() + " " + prose(70, 40 + i)), (2000 + i, prose(90, 60 + i) + " " + " ".join(near)), (3000 + i, prose(200, 80 + i))]
    docs = messy.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r.whole.doc_id: r.leak for r in decontam.matches(docs, benchmark).filter("leak is not null").collect()}
    assert {d for d in found if d and d >= 1000 and d < 2000} == set(range(1000, 1020))
    assert all(found[1000 + i]["item"] == i for i in range(20))
    assert len([d for d in found if d and 2000 <= d < 3000]) >= 18  # recall of paraphrases
    assert not [d for d in found if d is None or d < 1000 or d >= 3000]
    left = decontam.clean(messy, benchmark)
    assert left.columns == messy.columns and left.count() == messy.count()
    assert decontam.clean(nothing, benchmark).count() == 0
    assert decontam.clean(messy, benchmark.limit(0)).count() == messy.count()


@pytest.mark.parametrize("size", [200, 1_000, 10_000])
def test_decontamination_of_many_items(spark, size):
    rng = random.Random(size)
    words = ["".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(5_000)]
    text = lambda n: rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=n)
    items = [text(400 if i % 50 == 0 else rng.randrange(15, 60)) for i in range(size)]
    docs = []
    for i in range(0, 60):
        for tenths in range(4):
            changed = set(rng.sample(range(len(items[i])), tenths * len(items[i]) // 10))
            docs.append((4 * i + tenths, text(80) + ["changed" if k in changed else w for k, w in enumerate(items[i])] + text(90)))
    frames = [spark.createDataFrame([(i, " ".join(w)) for i, w in rows], schema) for rows, schema in ((docs, "doc_id long, text string"), (enumerate(items), "item_id long, text string"))]
    found = {r.whole.doc_id: r.leak for r in decontam.matches(*frames).filter("leak is not null").collect()}
    for i, w in docs:
        item = items[i // 4]
        masks = {}
        for k, x in enumerate(item):
            masks[x] = masks.get(x, 0) | (1 << k)
        if decontam.common(masks, len(item), w[80:-90]) >= 0.7 * len(item):
            assert i in found, (i, len(item))
            assert i % 4 or found[i]["share"] == 1.0


def test_decontamination_reports_every_item(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(decontam, "ITEMS", 4)  # several blocks
    items = [prose(15 + i, 700 + i) for i in range(10)]
    near = " ".join(w if k % 6 else "changed" for k, w in enumerate(items[7].split()))
    docs = [(1, " ".join([prose(50, 1), items[3], prose(60, 2), near, prose(50, 3), items[1]])), (2, prose(80, 4)), (3, items[5] + " " + items[5])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = decontam.op6_decontamination(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (1, 3), (1, 7), (3, 5)]
    assert all((r.lcs_share == 1.0) == (r.item_id != 7) for r in found)


def test_decontamination_searches_all_texts_of_an_id(spark):
    texts = [prose(20, 800 + i) for i in range(4)]
    benchmark = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (1, texts[0])], "item_id long, text string")
    docs = spark.createDataFrame([(i, prose(30, i) + " " + t) for i, t in enumerate(texts)] + [(9, " ".join(texts)), (10, prose(60, 10))], "doc_id long, text string")
    found = {r.whole.doc_id: [x["item"] for x in r.leaks] for r in decontam.matches(docs, benchmark).collect()}
    assert found == {0: [1], 1: [1], 2: [None], 3: [None], 9: [1, 1, None, None], 10: []}
    assert [r.doc_id for r in decontam.clean(docs, benchmark).collect()] == [10]


def test_decontamination_finds_what_brute_force_finds(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = spark.read.parquet(f"{small}/benchmark.parquet").collect()
    want = {r.doc_id for r in docs.collect() if any(i.text in (r.text or "") for i in items)}
    got = {r.doc_id for r in decontam.op6_decontamination(spark, small).collect()}
    assert want <= got and len(got) <= len(want) + 1


def test_quality_keeps_good_documents(spark, small):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    # Every fourth label is hidden from training.
    hidden = F.crc32(F.col("doc_id").cast("string")) % 4 == 1
    left = {r.doc_id for r in quality.kept(docs, labels.filter(~hidden)).select("doc_id").collect()}
    rows = labels.filter(hidden).collect()
    good, bad = ([r.doc_id for r in rows if r.quality == q] for q in (1, 0))
    assert sum(d in left for d in good) >= 0.97 * len(good)
    assert sum(d in left for d in bad) <= 0.25 * len(bad)


def test_quality_on_messy_rows(spark, messy, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (12, 0, 0), (13, 1, 0), (5, None, 0), (8, 7, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for own in (labels, labels.limit(0), labels.filter("quality = 0")):
        left = quality.kept(messy, own)
        assert left.columns == messy.columns
        left.count()
    assert quality.kept(messy, labels.limit(0)).count() == messy.count()
    assert quality.kept(nothing, labels).count() == 0


# --- registered queries ---------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, small, in_duckdb, name):
    names, want = in_duckdb(spark.read.parquet(f"{small}/documents.parquet"), SQL[name])
    found = QUERIES[name](spark, small)
    assert sorted(found.columns) == sorted(names)
    assert tuples(found, names) == want


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, small).cache()
        own = {r.doc_id for r in docs.collect()}
        assert own <= ids
        if name == "exact_dedup":
            want, _ = _exact([(r.doc_id, r.text) for r in before.collect()])
            assert own == {keep for _, keep, _ in want}
        if name == "near_dedup":
            assert own == {g for _, _, g in _linked([(r.doc_id, r.text) for r in before.collect()], 5, 80)}
        if name == "packing":
            assert own == ids
        else:
            assert docs.columns == columns
        ids = own
    assert 0 < len(ids) < 200
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, small).collect()) == sorted(ids)
