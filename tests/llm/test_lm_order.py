"""The deeper levels of the n-gram trie against brute force."""

import math
import random
from collections import Counter

import pytest

from roomtide.llm import lm, queries


@pytest.mark.parametrize("order", [3, 4])
def test_deep_levels(spark, order):
    rng = random.Random(7)
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 30))) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    trie = lm.train(docs.where("doc_id < 60"), order=order)
    got = {r.doc_id: r.score for r in lm.score_texts(docs, trie).collect()}
    tokens = [[*t.split(), "</s>"] for t in texts]
    one, grams, context, follow = Counter(w for t in tokens[:60] for w in t), Counter(), Counter(), Counter()
    for t in tokens[:60]:
        line = ["<s>"] * (order - 1) + t
        for i in range(order - 1, len(line)):
            for k in range(2, order + 1):
                gram = tuple(line[i - k + 1:i + 1])
                follow[gram[:-1]] += not grams[gram]
                grams[gram] += 1
                context[gram[:-1]] += 1
    total, size = sum(one.values()), len(one)
    for i, t in enumerate(tokens):
        line, want = ["<s>"] * (order - 1) + t, 0.0
        for j in range(order - 1, len(line)):
            p = (one[line[j]] + 1) / (total + size + 1)
            for k in range(2, order + 1):
                gram = tuple(line[j - k + 1:j + 1])
                if c := context[gram[:-1]]:
                    p = max(grams[gram] - 0.75, 0) / c + 0.75 * follow[gram[:-1]] / c * p
            want += math.log10(p)
        assert got[i] == pytest.approx(want, abs=0.02 * len(t))


def test_registered_order(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(lm, "score_texts", lambda docs, trie: seen.append(trie.order) or docs.selectExpr("*", *(f"0 {c}" for c in ("n_tokens", "n_known", "train_tokens", "base_score", "score"))))
    monkeypatch.setattr(queries, "table", lambda *_: spark.createDataFrame([(1, "a b c")], "doc_id long, text string"))
    queries.op9_lm(spark, "")
    assert seen[0] >= 3
