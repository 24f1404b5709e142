"""Tokens of whole columns: the same words as text by text, calls that do not grow with the texts, windows without a sort by columns."""

import random
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from roomtide.llm import common, lm

ODD = ["  A b  c ", None, "", "   ", "x", "x\ty\x0bZ\x0cq\rq\nend", "a\x1cb\x1dc\x1ed\x1fe\x00f\x85g\xa0h i ÀÉß Ⅷ K ﻿", " ".join(map(chr, range(1, 0x300)))]


def batches(texts, rows=10_000):
    return iter(pa.table({"text": pa.array(texts, pa.string())}).to_batches(max_chunksize=rows))


def words_by_text(texts):
    return [(t or "").encode().lower().split() for t in texts]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@pytest.mark.parametrize("texts", [ODD, ODD[1:4], ["a b", "c"], [None], []])
def test_words_of_a_column(kind, texts):
    for column, own in ((pa.array(texts, kind), texts), (pa.array(["cut", *texts, "cut"], kind).slice(1, len(texts)), texts)):
        words, sizes = common.split_words(column)
        assert words.to_pylist() == [w for t in words_by_text(own) for w in t]
        assert sizes.tolist() == [len(t) for t in words_by_text(own)]
        assert common.hashes_of(words).tolist() == [lm.xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()]


def test_slices_hold_all_rows_and_few_bytes():
    rng = random.Random(3)
    texts = [None if rng.random() < 0.1 else "x" * rng.randint(0, 60) for _ in range(500)] + ["y" * 300, None, "é" * 40]
    parts = list(common.text_slices(batches(texts, 70), "text", 100))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
    assert all(len(p) == 1 or sum(len((t or "").encode()) for t in p.column("text").to_pylist()) <= 100 for p in parts) and len(parts) < len(texts)


class Known:
    """A vocabulary of all words: a word's number is its hash modulo 2^40."""

    def look_up(self, hashes):
        return (hashes % np.uint64(1 << 40)).astype(np.int64), (hashes % np.uint64(7)).astype(np.int64)


@pytest.mark.parametrize("most", [1, 40, 500_000])
def test_chunks_hold_each_text_and_its_end(monkeypatch, most):
    monkeypatch.setattr(lm, "CHUNK_TOKENS", most)
    monkeypatch.setattr(common.text_slices, "__defaults__", (50,))
    rng = random.Random(5)
    texts = ODD + [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 9))) for _ in range(60)]
    chunks = list(lm._chunks(batches(texts, 9), Known()))
    assert [n for c in chunks for n in c[3].tolist()] == [len(t) + 1 for t in words_by_text(texts)]
    assert sum(len(c[0]) for c in chunks) == len(texts) and (len(chunks) > 1) == (most < 500_000)
    hashes = np.array([h for t in words_by_text(texts) for h in [*map(lm.xxhash.xxh3_64_intdigest, t), lm.END]], np.uint64)
    for at, want in zip((1, 2), Known().look_up(hashes), strict=True):
        assert np.concatenate([c[at] for c in chunks]).tolist() == want.tolist()


@pytest.mark.parametrize("texts", [[], [None, ""], ["  "]])
def test_chunks_without_words(texts):
    got = [c[3].tolist() for c in lm._chunks(batches(texts), Known())]
    assert got == ([[1] * len(texts)] if texts else [])


@pytest.mark.parametrize("texts", [ODD, [], [None, ""], ["a b a", "a"] * 9])
def test_word_counts(monkeypatch, texts):
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 2)
    got = Counter()
    for batch in lm._word_counts(5)(batches(texts, 2)):
        for slot, data, counts in zip(*(batch.column(n).to_pylist() for n in ("slot", "data", "counts")), strict=True):
            hashes = np.cumsum(lm.unpack(data, np.uint64), dtype=np.uint64)
            assert (lm.slot_of(hashes, 5) == slot).all()
            for h, c in zip(hashes.tolist(), lm.unpack(counts, np.uint64).tolist(), strict=True):
                got[h] += c
    want = Counter(lm.xxhash.xxh3_64_intdigest(w) for t in words_by_text(texts) for w in t)
    assert dict(got) == {**want, lm.END: len(texts), lm.START: len(texts)}


@pytest.mark.parametrize("step", [lambda b: lm._word_counts(4)(b), lambda b: lm._chunks(b, Known())], ids=["counts", "chunks"])
def test_calls_do_not_grow_with_the_texts(step):
    def calls(texts):
        seen, source = [0], batches(texts)

        def count(frame, event, arg):
            seen[0] += event in ("call", "c_call")

        sys.setprofile(count)
        try:
            for _ in step(source):
                pass
        finally:
            sys.setprofile(None)
        return seen[0]

    calls(["a b c"])  # what is imported or compiled at first use
    assert calls(["a b c"] * 4_000) < calls(["a b c"] * 400) + 400


@pytest.mark.parametrize("order", [2, 3, 4])
def test_windows_of_large_numbers_need_no_sort_by_columns(monkeypatch, order):
    rng = np.random.default_rng(8)
    line = rng.choice(rng.integers(0, 1 << 40, 30), 900)
    begin = np.flatnonzero(rng.random(900 - order) < 0.8)
    want = sorted(Counter(tuple(line[b:b + order].tolist()) for b in begin).items())
    monkeypatch.setattr(np, "lexsort", None)
    columns, counts = lm._windows(line, begin, order)
    assert list(zip(zip(*(c.tolist() for c in columns), strict=True), counts.tolist(), strict=True)) == want


def test_windows_of_more_bits_than_a_number_holds():
    rng = np.random.default_rng(9)
    line = rng.permutation(1 << 17) + (1 << 41)
    begin = np.arange(0, 1000, 7)
    columns, counts = lm._windows(np.concatenate([line, line[:1100]]), np.concatenate([begin, begin + (1 << 17)]), 4)
    want = sorted(tuple(line[b:b + 4].tolist()) for b in begin)
    assert list(zip(*(c.tolist() for c in columns), strict=True)) == want and (counts == 2).all()


@pytest.mark.parametrize("high", [4, 1 << 62, (1 << 63) - 1])
def test_numbered(high):
    keys = np.random.default_rng(10).integers(0, high, 300)
    keys = np.append(keys, keys[:40])
    distinct, place = lm._numbered(keys)
    assert distinct.tolist() == sorted(set(keys.tolist())) and (distinct[place] == keys).all()
    assert [x.tolist() for x in lm._numbered(keys[:0])] == [[], []]


def test_rows_in_order_of_wide_columns():
    rng = np.random.default_rng(11)
    for tops in ((9, 9, 9), (1 << 30, 1 << 30, 1 << 30), (1 << 63, 5, 1 << 50), (1 << 64, 3)):
        columns = [rng.integers(0, t, 400, dtype=np.uint64, endpoint=False) // np.uint64(max(1, t // 6)) * np.uint64(max(1, t // 6)) for t in tops]
        order = lm._order(columns)
        got = list(zip(*(c[order].tolist() for c in columns), strict=True))
        assert got == sorted(zip(*(c.tolist() for c in columns), strict=True)) and sorted(order.tolist()) == list(range(400))
