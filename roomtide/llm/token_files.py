"""Token ids in Parquet list columns, in document order, for selective reads of tokens or metadata.

Texts are dealt into ranges of doc_id, encoded inside the ranges and written by Spark's writer at once, so a
range becomes one file whose rows are in order, and a lost task is written again like any other. Columns:

* doc_id, n_tokens (with the end id), part (the range) and offset (ids of the range before the document):
  delta-encoded numbers without dictionary;
* ids, a list of 32-bit numbers: dictionary-encoded, as a vocabulary is small against a row group.

Row groups hold about `ROW_GROUP` bytes and pages at most `PAGE_ROWS` rows; the writer adds page indexes, so
a filter on doc_id, or on part and offset, reads only the pages it needs, and a frame that does not ask for
`ids` never reads the token column. A small table beside the files, one row per range, holds the number of ids
before each range; `read_tokens` adds it to the offset, which gives every document's place in the whole.

Tokens: a tokenizer that splits at white space before anything else of its model encodes each piece between
blanks once per worker process; whole texts are put together from them, and the ids are those of the whole text.
With other tokenizers each text is encoded as one piece. Documents are in ascending order of doc_id, null first; equal ids are
ordered by a hash of their text. Null and empty texts have the end id alone; repeated rows are documents of their own;
other columns are ignored; an empty table gives files without rows.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import compress, islice
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import _Numbers, batch_of, slices

END_ID = 2
ROW_GROUP, PAGE, PAGE_ROWS = 16 << 20, 256 << 10, 2_000
#: Bytes of text encoded at once; pieces up to KEPT_CHARS characters are remembered, about KEPT of them.
CHUNK, KEPT, KEPT_CHARS = 4 << 20, 400_000, 64
#: The split of tokenizers that drop white space and part runs of letters, single digits and runs of other marks (fixed value).
LETTERS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A place that this split always parts: a mark other than the apostrophe behind a letter.
CUT = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}])([,.;:!?])"
#: Functions travel with a job by value, so what outlives a task stands in a module of its own.
KEPT_IN = "_token_encoders"
STORED = "doc_id long, part int, offset long, n_tokens long, ids array<int>"
LAYOUT = {
    "compression": "zstd", "parquet.writer.version": "v2", "parquet.block.size": str(ROW_GROUP), "parquet.page.size": str(PAGE),
    "parquet.page.row.count.limit": str(PAGE_ROWS), "parquet.enable.dictionary": "true",
    **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "part", "offset", "n_tokens")},
}


def _strings(pieces: pa.Array) -> list[str]:
    """As Python strings, of one text: pieces hold no line end."""
    if not len(pieces):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces)
    return pc.binary_join(whole, pa.scalar("\n", pieces.type))[0].as_py().split("\n")


class Encoder:
    """Ids of whole texts; a piece between blanks is encoded once while it is remembered."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        split = ((model.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        normal = [n["type"] for n in (model.get("normalizer") or {}).get("normalizers", [])]
        # what stands for white space is removed before anything else of the model, so blanks part the text
        self.apart = split.get("pattern", {}).get("Regex") == LETTERS and split.get("behavior") == "Removed" and split.get("invert") is True and normal == ["NFC", "Replace", "Lowercase"]
        self.lower = all(t["content"].startswith("<") for t in model.get("added_tokens", []))
        self._forget()

    def _forget(self) -> None:
        self.pieces = _Numbers()
        self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _together(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of short pieces, encoded as one text; places in it tell which ids are whose."""
        sizes, flat = [], []
        for at in range(0, len(pieces), 4096):
            some = pieces[at:at + 4096]
            coded = self.tokenizer.encode_batch([" ".join(some)], add_special_tokens=False)[0]
            begin = np.fromiter((a for a, _ in coded.offsets), np.int64, len(coded))
            first = np.cumsum([0] + [len(w) + 1 for w in some])
            sizes.append(np.diff(np.searchsorted(begin, first)))
            flat.append(np.array(coded.ids, np.int32))
        return np.concatenate(sizes), np.concatenate(flat)

    def _known(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the pieces in a table of sizes and ids; the table is the remembered one, and behind it the pieces too long to remember."""
        if len(self.pieces) > KEPT:
            self._forget()
        before, long = len(self.pieces), [i for i, w in enumerate(pieces) if len(w) > KEPT_CHARS]
        numbers = np.zeros(len(pieces), np.int64)
        short = np.ones(len(pieces), bool)
        short[long] = False
        numbers[short] = np.fromiter(map(self.pieces.__getitem__, compress(pieces, short)), np.int64, len(pieces) - len(long))
        new = list(islice(reversed(self.pieces), len(self.pieces) - before))[::-1]
        if new:
            sizes, flat = self._together(new)
            self.sizes, self.flat = np.concatenate([self.sizes, sizes]), np.concatenate([self.flat, flat])
        numbers[long] = len(self.sizes) + np.arange(len(long))
        extra = [np.array(self.tokenizer.encode_batch_fast([pieces[i]], add_special_tokens=False)[0].ids, np.int32) for i in long]
        sizes = np.concatenate([self.sizes, np.array([len(c) for c in extra], np.int64)])
        return numbers, sizes, np.concatenate([self.flat, *extra])

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (no nulls), each followed by `end`, and how many each text has."""
        if not self.apart:
            coded = [self.tokenizer.encode_batch_fast([t], add_special_tokens=False)[0].ids + [end] for t in texts.to_pylist()]
            return np.array([i for ids in coded for i in ids], np.int32), np.array([len(ids) for ids in coded], np.int64)
        texts = pc.replace_substring(texts.cast(pa.large_string()), "\n", " ")
        # these models know no upper case; added tokens, which are found before that, begin with a sign of their own
        texts = pc.if_else(pc.match_substring(texts, "<"), texts, pc.ascii_lower(texts)) if self.lower else texts
        texts = pc.replace_substring_regex(texts, CUT, r"\1 \2")
        words = pc.split_pattern(texts, " ")
        at = words.offsets.to_numpy()
        coded = words.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        numbers, sizes, flat = self._known(_strings(coded.dictionary))
        # behind each text a piece of its own, the end
        stops = at[1:] - at[0] + np.arange(len(texts))
        line = np.full(len(coded) + len(texts), len(sizes), np.int64)
        line[np.delete(np.arange(len(line)), stops)] = numbers[coded.indices.to_numpy()]
        sizes, flat = np.append(sizes, 1), np.append(flat, np.int32(end))
        first = np.cumsum(sizes) - sizes
        width = sizes[line]
        ends = np.cumsum(width)
        place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first[line] - ends + width, width)
        return flat[place], np.diff(ends[stops], prepend=0)


def _encoder(path: str) -> Encoder:
    """One of a worker process: a worker runs many tasks, and pieces come again from task to task."""
    kept = sys.modules.setdefault(KEPT_IN, ModuleType(KEPT_IN)).__dict__
    file = os.stat(path)
    key = (path, file.st_size, file.st_mtime_ns)
    if key not in kept:
        kept.clear()
        kept[key] = Encoder(path)
    return kept[key]


def _encoded(path: str, end: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, offset = _encoder(path), TaskContext.get().partitionId(), 0

        def emit(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            nonlocal offset
            keys = pa.concat_arrays([b.column("doc_id") for b in held])
            ids, sizes = encoder.encode(pa.concat_arrays([b.column("text").cast(pa.large_string()) for b in held]), end)
            starts = offset + np.cumsum(sizes) - sizes
            offset += len(ids)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(ids, pa.int32()))
            return batch_of({
                "doc_id": (pa.int64(), keys), "part": (pa.int32(), [part] * len(keys)), "offset": (pa.int64(), pa.array(starts, pa.int64())),
                "n_tokens": (pa.int64(), pa.array(sizes, pa.int64())), "ids": (pa.list_(pa.int32()), lists),
            })

        held, size = [], 0
        for batch in slices(batches):
            held.append(batch)
            size += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
            if size >= CHUNK:
                yield emit(held)
                held, size = [], 0
        if held:
            yield emit(held)

    return run


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, end: int = END_ID) -> str:
    """Encode (doc_id, text) rows with the tokenizer file `tokenizer`, end each document with the id `end`, and write
    the files below `folder`, by default a new one in the shared folder. Returns the folder."""
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    placed = ready.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.mapInArrow(_encoded(tokenizer, end), STORED).write.options(**LAYOUT).parquet(f"{folder}/tokens")
    # one row per file, summed from a column of small numbers
    sizes = spark.read.parquet(f"{folder}/tokens").groupBy("part").agg(F.sum("n_tokens").alias("n_ids"), F.count(F.lit(1)).alias("n_docs"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"), "n_ids", "n_docs")
    starts.write.parquet(f"{folder}/parts")
    return folder


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """(part, first, n_ids, n_docs): the files in order and the number of ids before each."""
    return spark.read.parquet(f"{folder}/parts")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids, part, offset of every document. Columns that are not asked for are not read."""
    stored = spark.read.schema(STORED).parquet(f"{folder}/tokens")
    placed = stored.join(parts(spark, folder).select("part", "first"), "part")
    return placed.select("doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids", "part", "offset")


def read_documents(spark: SparkSession, folder: str, low: int, high: int) -> DataFrame:
    """Documents with low <= doc_id <= high: the filter reaches the page index of the sorted files."""
    return read_tokens(spark, folder).where(F.col("doc_id").between(low, high))


def read_span(spark: SparkSession, folder: str, start: int, n: int) -> DataFrame:
    """The ids at places start .. start + n - 1 of the whole, as rows (start, ids) in pieces of documents.

    The table of files tells which of them overlap the span; part and offset then bound the pages."""
    stop = start + n
    hit = parts(spark, folder).where((F.col("first") < stop) & (F.col("first") + F.col("n_ids") > start))
    near = hit.agg(F.min("part").alias("low"), F.max("part").alias("high")).first()
    stored = read_tokens(spark, folder).where(F.col("part").between(near.low, near.high) & (F.col("start") < stop) & (F.col("start") + F.col("n_tokens") > start))
    skip = F.greatest(F.lit(start) - F.col("start"), F.lit(0)).cast("int")
    width = (F.least(F.col("start") + F.col("n_tokens"), F.lit(stop)) - F.col("start") - skip).cast("int")
    return stored.select((F.col("start") + skip).alias("start"), F.slice("ids", skip + 1, width).alias("ids"))


def _checked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        data = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes())
        at = lists.offsets.to_numpy() * 4
        crc = [zlib.crc32(data[a:b]) for a, b in zip(at, at[1:], strict=False)]
        kept = {n: (None, batch.column(n)) for n in ("doc_id", "part", "offset", "n_tokens")}
        yield batch_of(kept | {"ids_crc32": (pa.int64(), crc)})


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit numbers), read back from the files."""
    stored = spark.read.schema(STORED).parquet(f"{folder}/tokens")
    checked = stored.mapInArrow(_checked, "doc_id long, part int, offset long, n_tokens long, ids_crc32 long")
    placed = checked.join(parts(spark, folder).select("part", "first"), "part")
    return placed.select("doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
