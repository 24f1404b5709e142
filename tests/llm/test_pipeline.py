"""The pipeline's stages against brute force over what each stage was given."""

import os
import re

import pytest

import corpus_pipeline as pipeline
from roomtide.llm import decontaminate, jaccard, quality, toxicity
from roomtide.llm.common import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, None
    for name, step in pipeline.STAGES:
        before = docs.collect()
        step(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        kept = {r.doc_id for r in after}
        if name == "quality":
            model = quality.learn(table(spark, SF, "documents"), table(spark, SF, "labels"))
            score = model.scorer()
            assert kept == {r.doc_id for r in before if model.tails(score((r.text or "").encode()))[0] >= quality.CUT}
        if name == "toxicity":
            g = toxicity.learn(table(spark, SF, "documents"), table(spark, SF, "labels").where(~toxicity.held_out()))
            a = g.automaton()
            assert kept == {r.doc_id for r in before if g.score(*g.evidence(r.text, a)) < toxicity.CUT}
        if name == "near_copies":
            groups = jaccard.jaccard_groups(spark.createDataFrame(before, docs.schema)).collect()
            assert kept == {r.component_id for r in groups} and len(after) == len(kept)
        if name == "decontaminate":
            judged = decontaminate.decontaminate(spark.createDataFrame(before, docs.schema), table(spark, SF, "benchmark"))
            assert kept == {r.doc_id for r in judged.where("not contaminated").collect()}
        if name == "mix":
            size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
            whole = sum(map(size, before))
            assert abs(sum(map(size, after)) - 1.5 * whole) < 0.2 * whole
        assert docs.columns == columns
    assert pipeline.run(spark, SF).count() == len(after)


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, step in pipeline.STAGES:
        assert step(spark, docs, SF).count() == 0
