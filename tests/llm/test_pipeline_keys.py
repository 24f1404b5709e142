"""Rows without id and rows of a repeated id in the pipeline's stages."""

import corpus_pipeline as pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], SCHEMA)


def test_benchmark_rows(spark, monkeypatch):
    line = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(1, line)], "item_id long, text string")
    monkeypatch.setattr(pipeline, "table", lambda *_: items)
    rows = [(None, line), (None, "clean a"), (None, "clean b"), (None, None), (7, f"x {line}"), (7, "clean c")]
    kept = pipeline.no_benchmark(spark, frame(spark, rows), "").collect()
    assert {(r.doc_id, r.text) for r in kept} == {rows[i] for i in (1, 2, 3, 5)} and len(kept) == 4


def test_group_rows(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    near = lambda k: text(k) + " more"
    rows = [(1, text(1)), (1, text(2)), (1, text(1)), (None, text(3)), (None, near(3)), (None, text(4)), (9, text(5)), (None, near(5)), (8, near(5)), (3, near(2))]
    kept = [(r.doc_id, r.text) for r in pipeline.one_of_group(spark, frame(spark, rows), "").collect()]
    assert len(kept) == 5 and {(1, text(1)), (1, text(2)), (None, text(4)), (8, near(5))} < set(kept)
    assert len({(None, text(3)), (None, near(3))} & set(kept)) == 1
