"""Scoring of empty tables, the same model from another order of rows, and recall of vector pairs at the threshold."""

import numpy as np

from roomtide.llm import neardup_vectors, quality, toxicity

DOC = "doc_id long, text string"


def labelled(spark):
    rows = [(i, f"you are a {'fool' if i % 3 == 0 else 'friend'} number {i % 7} of the {'bad' if i % 2 else 'Good'} row") for i in range(120)]
    return spark.createDataFrame(rows, DOC), spark.createDataFrame([(i, int(i % 2 == 0), int(i % 3 == 0)) for i in range(120)], "doc_id long, quality int, toxic int")


def test_empty_documents(spark):
    docs, labels = labelled(spark)
    grammar, model = toxicity.learn(docs, labels), quality.learn(docs, labels)
    assert toxicity.score_toxicity(docs.limit(0), grammar).collect() == []
    assert quality.grade_documents(docs.limit(0), model).collect() == []


def test_order_of_rows_does_not_change_the_model(spark):
    docs, labels = labelled(spark)
    a = quality.learn(docs.repartition(2), labels)
    b = quality.learn(docs.orderBy("text").repartition(7), labels)
    assert (a.weights == b.weights).all() and (a.cuts == b.cuts).all()


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(9)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    base = unit(rng.standard_normal((400, 64)))
    side = rng.standard_normal((400, 64))
    side = unit(side - (side * base).sum(axis=1, keepdims=True) * base)
    near = 0.9005 * base + np.sqrt(1 - 0.9005**2) * side
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, near]))]
    got = neardup_vectors.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = np.concatenate([base, near])
    true = (unit(x) @ unit(x).T >= 0.9).sum(axis=1) - 1
    found = {r.vec_id: r.n_links for r in got}
    assert all(found[i] <= true[i] for i in found)
    assert sum(found.values()) >= 0.9 * true.sum() and true.sum() >= 800
