"""Token files against encoding each whole text, their layout, and reads of parts."""

import glob
import random
import struct
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from roomtide.llm import token_files as T

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "B", "é", "é", "́", " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x00", "<|endoftext|>", "<|", "1", "'s", "!", "中文", "　", " ", "Σ", "x" * 70]


def whole(text):
    # the library on the whole text
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [T.END_ID]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 40))) for _ in range(60)]
    out = [(i * 3, t) for i, t in enumerate(texts)]
    return [*out, (500, None), (None, "no id"), (None, None), (501, ""), (502, "Word. " * 30_000), (503, "y" * 5_000), (7, "twice"), (7, "twice"), (7, "other")]


@pytest.fixture(scope="module")
def folder(spark, rows):
    docs = spark.createDataFrame([(*r, 1, [2]) for r in rows], "doc_id long, text string, part int, ids array<int>")
    return T.write_tokens(docs.repartition(5), PATH)


def test_digests_equal_whole_texts(spark, rows, folder):
    got = T.digests(spark, folder).orderBy("start").collect()
    known = {}
    for key, text in rows:
        ids = whole(text)
        known.setdefault((key, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))), []).append(text)
    assert len(got) == len(rows)
    assert [r.doc_id for r in got] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k))
    at = 0
    for r in got:
        assert r.start == at
        known[r.doc_id, r.n_tokens, r.ids_crc32].pop()
        at += r.n_tokens


def test_layout(folder):
    for path in glob.glob(f"{folder}/tokens/*.parquet"):
        group = pq.ParquetFile(path).metadata.row_group(0)
        columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
        for name in ("doc_id", "part", "offset", "n_tokens"):
            assert columns[name].encodings == ("DELTA_BINARY_PACKED",)
            assert columns[name].has_column_index


def test_selective_reads(spark, rows, folder):
    every = [i for _, ids in T.read_tokens(spark, folder).orderBy("start").select("start", "ids").collect() for i in ids]
    for start, n in ((0, 7), (3, 1), (40, 500), (len(every) - 5, 5), (100, len(every))):
        span = [i for _, ids in T.read_span(spark, folder, start, n).orderBy("start").collect() for i in ids]
        assert span == every[start:start + n]
    assert T.read_span(spark, folder, len(every) + 3, 2).count() == 0
    few = T.read_documents(spark, folder, 6, 12)
    assert sorted(r.doc_id for r in few.collect()) == sorted(k for k, _ in rows if k is not None and 6 <= k <= 12)
    plan = few.select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan and "GreaterThanOrEqual(doc_id,6)" in plan


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    made = T.write_tokens(empty, PATH)
    assert T.digests(spark, made).collect() == []
    assert T.read_span(spark, made, 0, 5).collect() == []
    assert T.read_tokens(spark, made).agg(F.sum("n_tokens")).first()[0] is None
