"""Helpers shared by the operators: tables, words, hashes, packed arrays, sorted row streams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINE_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(key: str, m: int) -> Column:
    """crc32 of the key as text, modulo m; a null key counts as 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % m, F.lit(0)).cast("int")


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` words; null has none."""
    flat = F.trim(F.translate(text, LINE_SPACE[1:], " " * (len(LINE_SPACE) - 1)))
    n = F.when(F.length(flat) == 0, 0).otherwise(F.size(F.split(flat, " +")))
    return F.coalesce(n, F.lit(0)).cast("long")


def slices(batches: Iterable[pa.RecordBatch], rows_each: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small slices, so that few texts at a time exist as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows_each):
            yield batch.slice(at, rows_each)
        del batch
        pa.default_memory_pool().release_unused()


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as UTF-8 bytes. `bytes.lower` and `bytes.split` treat ASCII only, which is just
    the rule of the contracts: lower-case A-Z, words between \\x20 and \\x09-\\x0D."""
    column = batch.column(name)
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def text_slices(batches: Iterable[pa.RecordBatch], name: str, most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most so many bytes of text, or of one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
            yield batch.slice(at, stop - at)
            at = stop
        del batch
        pa.default_memory_pool().release_unused()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, one after another, as bytes, and their number by text: the rule of `utf8`, for a
    whole column at once. Null has no words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = pc.list_flatten(lists)
    words = words.cast(pa.large_binary() if pa.types.is_large_string(words.type) else pa.binary())
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # space at an end splits off an empty word
    if not real.all():
        upto, ends = np.concatenate(([0], np.cumsum(real))), np.cumsum(sizes)
        words, sizes = words.filter(pa.array(real)), upto[ends] - upto[ends - sizes]
    return words, sizes


def hashes_of(words: pa.Array) -> np.ndarray:
    """The 64-bit hash of each word, as `Words` keeps them."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_numpy(zero_copy_only=False)), np.uint64, len(words))


class _Numbers(dict):
    """Gives each new key the next number; unlike a defaultdict over its own length, no reference cycle."""

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


class Words:
    """Numbers words in order of first sight and keeps a 64-bit hash of each.

    Holds at most `keep` words between documents, so that a long task stays in bounded memory;
    hashes do not depend on what was forgotten.
    """

    def __init__(self, keep: int = 200_000) -> None:
        self.keep = keep
        self._reset()

    def _reset(self) -> None:
        self.ids = _Numbers()
        self._hashes = np.empty(1 << 12, np.uint64)
        self._known = 0

    def number(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))

    def hashes(self) -> np.ndarray:
        """By word number."""
        n = len(self.ids)
        if n > self._known:
            if n > len(self._hashes):
                self._hashes = np.concatenate([self._hashes[: self._known], np.empty(2 * n - self._known, np.uint64)])
            digest = xxhash.xxh3_64_intdigest
            new = np.fromiter(map(digest, islice(reversed(self.ids), n - self._known)), np.uint64, n - self._known)
            self._hashes[self._known:n] = new[::-1]
            self._known = n
        return self._hashes[:n]

    def hash_text(self, text: bytes | None) -> np.ndarray:
        """Word hashes of a text, in order."""
        if not text:
            return np.empty(0, np.uint64)
        if len(self.ids) > self.keep:
            self._reset()
        numbers = self.number(text.lower().split())
        return self.hashes()[numbers]


def pack(a: np.ndarray) -> bytes:
    """An integer array as compressed byte planes: high planes of small numbers cost next to nothing."""
    a = np.ascontiguousarray(a)
    return zstandard.compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).ravel(), 1)


def unpack(data: bytes, dtype) -> np.ndarray:
    raw, size = np.frombuffer(zstandard.decompress(data), np.uint8), np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def deltas(a: np.ndarray) -> np.ndarray:
    """Differences of a sorted uint64 array, the first from 0; np.cumsum restores it."""
    out = a.copy()
    out[1:] -= a[:-1]
    return out


def distinct(a: np.ndarray) -> np.ndarray:
    """Sorted distinct values; for short arrays much faster than np.unique."""
    a = np.sort(a)
    return a[np.concatenate(([True], a[1:] != a[:-1]))] if len(a) else a


def rows(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def batch_of(columns: dict[str, tuple[pa.DataType, object]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, pa.Array) else pa.array(v, type=t) for t, v in columns.values()], names=list(columns)
    )


def buckets_of(spark: SparkSession, least: int = 64) -> int:
    """Number of hash ranges: as many as the session's shuffle partitions, which follow the data."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
