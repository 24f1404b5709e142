"""The trie's levels: pointers, context-relative words, 16-bit probabilities that never add up to more than 1."""

import numpy as np
import pytest

from roomtide.llm import lm


def test_access_and_stretches():
    rng = np.random.default_rng(4)
    for values in (np.sort(rng.integers(0, 5_000, 2_000)), np.zeros(70, np.int64), np.array([3]), np.sort(rng.integers(0, 10**12, 300))):
        e = lm.EliasFano.encode(values)
        code = lm.EliasFano(*map(int, e["shape"]), e["low"], e["high"], e["ones"], e["zeros"])
        assert (code.access(np.arange(len(values))) == values).all()
        begin = rng.integers(0, len(values), 200)
        end = np.minimum(begin + rng.integers(0, 40, 200), len(values))
        ask = np.where(rng.random(200) < 0.5, values[np.minimum(begin + 2, len(values) - 1)], rng.integers(0, values[-1] + 5, 200)).astype(np.uint64)
        for v, a, b, got in zip(ask, begin, end, code.find(ask, begin, end), strict=True):
            hits = np.flatnonzero(values[a:b] == v)
            assert got == (a + hits[0] if len(hits) else -1)


def test_successors_of_each_context():
    rng = np.random.default_rng(5)
    pairs = np.unique(np.stack([rng.integers(0, 90, 4_000), rng.integers(0, 700, 4_000)], axis=1), axis=0)
    pairs = pairs[(pairs[:, 0] % 7 != 3) & (pairs[:, 0] != 89)]  # contexts without successors, the last one too
    p = np.full(len(pairs), 0.5)
    level = lm.Level(lm.Level.arrays(pairs[:, 0], 90, pairs[:, 1].astype(np.uint64), p, np.full(90, 0.5)))
    ask = np.stack(np.meshgrid(np.arange(90), np.arange(700), indexing="ij"), axis=-1).reshape(-1, 2)
    known = {tuple(x): i for i, x in enumerate(pairs.tolist())}
    assert level.successors(ask[:, 0], ask[:, 1]).tolist() == [known.get(tuple(x), -1) for x in ask.tolist()]


def test_quantised_numbers_are_rounded_down():
    p = np.concatenate([np.random.default_rng(6).random(5_000), 10.0 ** np.linspace(-15, 0, 999), [1.0]])
    got = lm.VALUES[lm.quantise(p)]
    assert (got <= p * (1 + 1e-12)).all() and (got > p * 0.999).all()
    assert lm.VALUES[lm.quantise(np.zeros(1))] == 0 and got[-1] == 1


@pytest.mark.parametrize("texts", [["a b"] * 300, ["a"] * 50 + ["a a a a"] * 50, ["x y z", "x y w", "x q"] * 40, [None, ""]])
def test_probabilities_stay_below_one(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    trie = lm.train(docs)
    assert all(r.score <= 0 for r in lm.score_texts(docs, trie).collect())
    # texts of one word more than the context, and the context alone, are different texts: together below 1
    words = sorted({w for t in texts for w in (t or "").split()})
    for context in {tuple((t or "").split()[:1]) for t in texts}:
        tails = spark.createDataFrame([(i, " ".join([*context, w])) for i, w in enumerate(words)], "doc_id long, text string")
        head = spark.createDataFrame([(0, " ".join(context))], "doc_id long, text string")
        whole = sum(10 ** r.score for r in lm.score_texts(tails, trie).collect())
        closed = 10 ** lm.score_texts(head, trie).first().score
        assert whole + closed <= 1 + 1e-9


def test_empty_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    trie = lm.train(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    assert lm.score_texts(empty, trie).collect() == []


def test_the_select_step_takes_few_passes_and_finds_each_bit(monkeypatch):
    rng = np.random.default_rng(7)
    words = np.concatenate([rng.integers(1, 1 << 63, 500, dtype=np.uint64), np.array([1, 1 << 63, 2**64 - 1, 0x8000000000000001], np.uint64)])
    which = [(w, k, place) for w in words.tolist() for k, place in enumerate(i for i in range(64) if w >> i & 1)]
    calls, counted = [], np.bitwise_count
    monkeypatch.setattr(np, "bitwise_count", lambda x: (calls.append(1), counted(x))[1])
    got = lm._select(np.array([w for w, _, _ in which], np.uint64), np.array([k for _, k, _ in which]))
    assert got.tolist() == [place for _, _, place in which] and len(calls) == 1
