"""Parts of the benchmark search that keep its work small."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tidegauge.llm import decontam


def test_latent_space_takes_one_pass_a_round(spark, monkeypatch):
    texts = [(" ".join(f"w{(i * 7 + j) % 90}" for j in range(80)),) for i in range(40)]
    stored = decontam.stored_passages(spark.createDataFrame(texts, "text string").repartition(3))
    passes, summed = [], decontam.summed
    monkeypatch.setattr(decontam, "summed", lambda *a: passes.append(a) or summed(*a))
    found = decontam.randomised_svd(stored.selectExpr("*", "1D AS weight"), np.ones(decontam.HASHED), 8)
    assert len(passes) == 2
    assert np.allclose(found.T @ found, np.eye(8), atol=1e-3)


def test_places_of_words():
    rng = np.random.default_rng(4)
    words = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))
    # Words, others, and others that share their low bits.
    code = rng.permutation(np.concatenate((words[::3], words + np.uint64(1 << 16), rng.integers(0, 2**63, 500, dtype=np.uint64))))
    at, which = decontam.Codes(words).places(code)
    assert at.tolist() == [i for i, c in enumerate(code) if c in set(words.tolist())]
    assert words[which].tolist() == code[at].tolist()
    assert not len(decontam.Codes(words).places(code[:0])[0])


def matcher(texts: list[str]) -> decontam.Matcher:
    items = [decontam.Item(k, decontam.word_list(t), decontam.word_list(decontam.answer(t))) for k, t in enumerate(texts)]
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((len(items), 8)).astype(np.float32)
    wide = np.array([len(i.words) > 24 for i in items], dtype=bool)
    word = rng.standard_normal((decontam.HASHED, 8)).astype(np.float32)
    return decontam.Matcher(decontam.Space(word, np.full(decontam.HASHED, 8.0), items, wide, vectors))


def test_shares_are_those_of_each_candidate(monkeypatch):
    monkeypatch.setattr(decontam, "COMPARED", 200)  # several rounds, and candidates above it
    rng = np.random.default_rng(8)
    for words in (4, 300):
        texts = [" ".join(f"w{i}" for i in rng.integers(0, words, n)) for n in (1, 2, 31, 63, 64, 65, 130, 64)]
        made = matcher(texts)
        code = np.array(decontam.word_list(" ".join([*texts, *(f"w{i}" for i in rng.integers(0, words + 5, 400))])), dtype=np.uint64)
        k = rng.integers(0, len(texts), 300)
        low = rng.integers(0, len(code), 300)
        high = np.minimum(low + rng.integers(0, 260, 300), len(code))
        want = [decontam.common(made.masks[i], len(made.space.items[i].words), code[a:b].tolist()) / len(made.space.items[i].words) for i, a, b in zip(k, low, high, strict=True)]
        assert made.shares(code, k, low, high).tolist() == want
        assert not len(made.shares(code, k[:0], low[:0], high[:0]))


def test_candidates_are_not_compared_one_by_one(monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    items = [" ".join(rng.choice(words, 30)) for _ in range(20)]
    texts = [" ".join(rng.choice(words, 200)) for _ in range(20)] + [" ".join([*rng.choice(words, 40), i, *rng.choice(words, 40)]) for i in items]
    calls, common = [], decontam.common
    monkeypatch.setattr(decontam, "common", lambda *a: calls.append(a) or common(*a))
    found = matcher(items).match(pa.array(texts))
    assert all(any(x["item"] == i and x["share"] == 1 for x in found[20 + i]) for i in range(20))
    assert not calls


def test_products_read_only_what_a_passage_has(monkeypatch):
    monkeypatch.setattr(decontam, "TERMS", 7)
    rng = np.random.default_rng(2)
    dense = rng.random((50, 90)).astype(np.float32) * (rng.random((50, 90)) < rng.random((50, 1)))
    dense[[0, 17]] = 0  # rows without terms
    to, of = np.nonzero(dense)
    block = rng.random((90, 6)).astype(np.float32)
    out = np.ones((50, 6), dtype=np.float32)
    decontam.add_products(out, to, of, dense[to, of], block)
    assert np.allclose(out, 1 + dense @ block, atol=1e-4)
    decontam.add_products(out, to[:0], of[:0], dense[to, of][:0], block)
    assert np.allclose(out, 1 + dense @ block, atol=1e-4)


def test_query_searches_each_text_once(spark, tmp_path, capsys):
    spark.createDataFrame([(1, "a b c d e f. g h"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "b c d e f")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = decontam.op6_decontamination(spark, str(tmp_path))
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, 7)]
    capsys.readouterr()
    found.explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
