"""Language-model scoring with an Elias-Fano n-gram trie.

Level 1 of the trie holds the words (64-bit hashes in order, with exact counts); a word's rank is its
number. Level k holds the k-grams in order of their context and word. Pointers, a monotone sequence with one entry per
node of level k-1, say where a context's successors begin. The successors' words form a second monotone
sequence: each word is stored relative to its context, on top of the last entry of the context before. Both sequences are coded
by Elias-Fano: low bits packed, high bits in unary with directories of ones and zeros. A successor is found by taking the
context's stretch from the pointers and the base from the entry before it, and searching the stretch alone, from its
high bits to a binary search on low bits: nothing is decoded but what a query touches. Smoothed probabilities
and back-off weights are quantised to 16 bits on a log scale, rounded down, so that no context's probabilities add
up to more than 1.
The trie is cut into shards by the hash of the first word; a shard is built by one task from counts that
all tasks have summed before, written to the shared folder, and memory-mapped by the tasks that
score. Nothing of it passes the driver but one line per shard.

Model: absolute discounting, interpolated down to add-one unigrams:
p(w | h) = max(c(hw) - D, 0) / c(h) + D * successors(h) / c(h) * p(w | shorter h), p(w) = (c + 1) / (N + V + 1).
Texts begin after order - 1 start marks, which are contexts only: c(h) and successors(h) count no start mark after h.

Tokens: words `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z, then one end. Null and empty texts have the end
alone. Repeated rows count and score each for itself; rows with a null doc_id are trained on or
not as any other; other columns are ignored. With no training text N and V are 0.
"""

from __future__ import annotations

import json
import math
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import batch_of, buckets_of, crc_mod, deltas, hashes_of, pack, rows, split_words, text_slices, unpack

ORDER, DISCOUNT = 3, 0.75
END, START = xxhash.xxh3_64_intdigest(b"\n</s>"), xxhash.xxh3_64_intdigest(b"\n<s>")
CHUNK_TOKENS, CHUNK_BYTES, STEP = 500_000, 1 << 26, 1 / 4096
MESSAGE = "slot int, data binary, counts binary"


# --- Elias-Fano -------------------------------------------------------------------------------

_EACH, _TOP = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
#: Place of the k-th set bit of a byte, at 8 * byte + k.
_IN_BYTE = np.array([([i for i in range(8) if byte >> i & 1] + [0] * 8)[k] for byte in range(256) for k in range(8)], np.int64)


def _select(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th (from 0) set bit of each 64-bit word: its byte by running bit counts, all bytes of a word at
    once, then the bit by a table."""
    u, k = np.uint64, k.astype(np.uint64)
    s = words - ((words >> u(1)) & u(0x5555555555555555))
    s = (s & u(0x3333333333333333)) + ((s >> u(2)) & u(0x3333333333333333))
    upto = ((s + (s >> u(4))) & u(0x0F0F0F0F0F0F0F0F)) * _EACH  # byte i: set bits of bytes 0 .. i
    # bytes whose count is at most k lie before the bit
    start = np.bitwise_count((k * _EACH | _TOP) - upto & _TOP).astype(np.uint64) << u(3)
    left = k - (upto << u(8) >> start & u(255))
    return start.astype(np.int64) + _IN_BYTE[((words >> start & u(255)) << u(3) | left).astype(np.int64)]


def _directory_dtype(n: int):
    return np.uint32 if n < 1 << 32 else np.uint64


class EliasFano:
    """A monotone sequence of whole numbers; entries by place, and places of entries inside a stretch."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray | None = None) -> None:
        self.n, self.low_bits, self.low, self.high, self.ones = n, low_bits, low, high, ones
        self.zeros = 64 * np.arange(len(high)) - ones.astype(np.int64) if zeros is None else zeros

    @staticmethod
    def encode(values: np.ndarray, universe: int | None = None) -> dict[str, np.ndarray]:
        values = values.astype(np.uint64)
        n = len(values)
        universe = universe or (int(values[-1]) + 1 if n else 1)
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        bits = np.zeros((n * low_bits + 7) // 8 + 8, np.uint8)
        for at in range(0, n, 1 << 16):  # 2^16 rows start on a byte
            part = values[at:at + (1 << 16)]
            plain = ((part[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
            packed = np.packbits(plain.ravel(), bitorder="little")
            bits[at * low_bits // 8:at * low_bits // 8 + len(packed)] = packed
        last = universe >> low_bits
        unary = np.zeros(-(-(n + last + 2) // 64) * 64, np.uint8)
        unary[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        high = np.packbits(unary, bitorder="little").view("<u8")
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high).astype(np.int64))))[:-1]
        kind = _directory_dtype(len(unary))
        return {"shape": np.array([n, low_bits]), "low": bits, "high": high, "ones": ones.astype(kind), "zeros": (64 * np.arange(len(high)) - ones).astype(kind)}

    def _bit(self, directory: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
        """Place of the k-th (from 0) one, or zero, of the unary part: the word by its directory, then the bit."""
        word = np.searchsorted(directory, k.astype(directory.dtype), side="right") - 1
        bits = self.high[word]
        return 64 * word + _select(~bits if flip else bits, k - directory[word].astype(np.int64))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        word = np.ndarray((len(self.low) - 7,), "<u8", self.low, strides=(1,))[at >> 3]
        return (word >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The entries at these places."""
        high = (self._bit(self.ones, i, False) - i).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._low(i)

    def find(self, values: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Places of the values inside begin .. end - 1 (of all without), -1 for those that are not there."""
        begin = np.zeros(len(values), np.int64) if begin is None else begin
        end = np.full(len(values), self.n) if end is None else end
        out = np.full(len(values), -1)
        h, low = (values >> np.uint64(self.low_bits)).astype(np.int64), values & np.uint64((1 << self.low_bits) - 1)
        ask = np.flatnonzero((begin < end) & (h < 64 * len(self.high) - self.n))
        if not len(ask):
            return out
        h, low = h[ask], low[ask]
        lo = np.maximum(np.where(h > 0, self._bit(self.zeros, np.maximum(h - 1, 0), True) + 1 - h, 0), begin[ask])
        stop = np.minimum(self._bit(self.zeros, h, True) - h, end[ask])
        hi = stop.copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) // 2
            less = self._low(mid) < low[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        at = np.flatnonzero(lo < stop)
        at = at[self._low(lo[at]) == low[at]]
        out[ask[at]] = lo[at]
        return out


def quantise(p: np.ndarray) -> np.ndarray:
    """log10 of numbers in (0, 1] in 16 bits, rounded down, for numbers from 10^-15.9; 65535 for zero."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.clip(np.ceil(-np.log10(p) / STEP), 0, 65534), 65535).astype(np.uint16)


VALUES = np.append(10.0 ** (-STEP * np.arange(65535)), 0.0)


class Level:
    """The k-grams of a shard: children of the nodes of the level above."""

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        part = lambda name: EliasFano(*map(int, arrays[f"{name}.shape"]), *(arrays[f"{name}.{x}"] for x in ("low", "high", "ones", "zeros")))
        self.pointers, self.words = part("pointers"), part("words")
        self.p, self.back = arrays["p"], arrays["back"]

    @staticmethod
    def arrays(parent: np.ndarray, n_parents: int, word: np.ndarray, p: np.ndarray, back: np.ndarray) -> dict[str, np.ndarray]:
        """Of nodes in order of (parent, word)."""
        size = np.bincount(parent, minlength=n_parents)
        pointers = np.concatenate(([0], np.cumsum(size)))
        full = np.flatnonzero(size)
        last = word[pointers[full + 1] - 1]
        base = np.zeros(n_parents, np.uint64)
        base[full] = np.cumsum(last) - last
        coded = {"pointers": EliasFano.encode(pointers), "words": EliasFano.encode(base[parent] + word)}
        return {f"{n}.{k}": v for n, c in coded.items() for k, v in c.items()} | {"p": quantise(p), "back": quantise(back)}

    def successors(self, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The node of each (parent, word), -1 where there is none; parents are sorted."""
        new = np.append(True, parent[1:] != parent[:-1])[:len(parent)]
        own, which = parent[new], np.cumsum(new) - 1
        begin, end = self.pointers.access(own).astype(np.int64), self.pointers.access(own + 1).astype(np.int64)
        base = np.where(begin > 0, self.words.access(np.maximum(begin - 1, 0)) if self.words.n else 0, 0).astype(np.uint64)
        return self.words.find(base[which] + word.astype(np.uint64), begin[which], end[which])


# --- shards -----------------------------------------------------------------------------------

def _put(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Arrays in one file, each on a multiple of 64 bytes, behind a line that says where."""
    files, at = fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)
    places, size = {}, 0
    for name, array in arrays.items():
        places[name] = (array.dtype.str, len(array), size)
        size += -(-array.nbytes // 64) * 64
    head = json.dumps(places).encode()
    head += b" " * (-(len(head) + 9) % 64) + b"\n"
    with files.open_output_stream(at, compression=None) as out:
        out.write(len(head).to_bytes(8, "little") + head)
        for array in arrays.values():
            out.write(np.ascontiguousarray(array).view(np.uint8).data)
            out.write(bytes(-array.nbytes % 64))


def _get(path: str) -> dict[str, np.ndarray]:
    """Memory-mapped where the file lies if that is a mounted folder, else from a copy without a name, which ends with the mapping."""
    at = path.removeprefix("file://").removeprefix("file:")
    copied = ":" in at.split("/")[0]
    if copied:
        files, inner = fs.FileSystem.from_uri(path)
        handle, at = tempfile.mkstemp(prefix="shard-")
        with files.open_input_stream(inner, compression=None) as source, os.fdopen(handle, "wb") as copy:
            while block := source.read(1 << 22):
                copy.write(block)
    data = np.asarray(np.memmap(at, np.uint8, "r"))  # parts of a memmap proper cost more to take
    if copied:
        os.remove(at)
    head = 8 + int.from_bytes(data[:8].tobytes(), "little")
    places = json.loads(data[8:head].tobytes())
    return {n: data[head + start:head + start + length * np.dtype(kind).itemsize].view(kind) for n, (kind, length, start) in places.items()}


def slot_of(hashes: np.ndarray, slots: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)


def _order(columns: list[np.ndarray]) -> np.ndarray:
    """Places that sort the rows; neighbouring columns become one number each where that fits."""
    keys, room = [], 0
    for column in columns:
        least = column.min()
        own, width = (column - least).astype(np.uint64), int(column.max()) - int(least) + 1
        if keys and room * width < 1 << 63:
            keys[-1], room = keys[-1] * np.uint64(width) + own, room * width
        else:
            keys.append(own)
            room = width
    return np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(keys[::-1])


def _grouped(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows in order, counts summed."""
    if not len(counts):
        return columns, counts
    order = _order(columns)
    columns = [c[order] for c in columns]
    new = columns[0][1:] != columns[0][:-1]
    for c in columns[1:]:
        new |= c[1:] != c[:-1]
    first = np.concatenate(([True], new))
    return [c[first] for c in columns], np.add.reduceat(counts[order], np.flatnonzero(first))


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and of each key its place among them."""
    bits = len(keys).bit_length()
    if len(keys) and keys.min() >= 0 and int(keys.max()) < 1 << 63 - bits:
        # key and place as one number: numbers sort faster than places by number
        ranked = np.sort(keys << bits | np.arange(len(keys)))
        order, ranked = ranked & (1 << bits) - 1, ranked >> bits
    else:
        order = np.argsort(keys)
        ranked = keys[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(keys) else np.zeros(0, bool)
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return ranked[new], place


def _windows(line: np.ndarray, begin: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct windows of a line, in order, and how often each begins at the given places."""
    words, place = _numbered(line)
    bits = len(words).bit_length()
    if bits * order > 63:
        return _grouped([line[begin + k] for k in range(order)], np.ones(len(begin), np.int64))
    key = place[begin]
    for k in range(1, order):
        key = key << bits | place[begin + k]
    key.sort()
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    own = key[first]
    columns = [words[own >> bits * k & (1 << bits) - 1] for k in reversed(range(order))]
    return columns, np.diff(np.append(first, len(key)))


def _portions(batches: Iterable[pa.RecordBatch], most: int):
    """Portions of about so many tokens: other columns of the rows, words of all texts one after another, words by text."""
    keys, words, sizes, held, weight = [], [], [], 0, 0
    for batch in text_slices(batches, "text"):
        keys += zip(*(batch.column(n).to_pylist() for n in batch.schema.names if n != "text"), strict=True) if batch.num_columns > 1 else [()] * len(batch)
        own, n = split_words(batch.column("text"))
        words.append(own)
        sizes.append(n)
        held, weight = held + len(own) + len(n), weight + own.nbytes
        if held >= most or weight >= CHUNK_BYTES:
            yield keys, pa.chunked_array(words), np.concatenate(sizes)
            keys, words, sizes, held, weight = [], [], [], 0, 0
    if keys:
        yield keys, pa.chunked_array(words), np.concatenate(sizes)


def _word_counts(slots: int):
    def emit(hashes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        (hashes,), counts = _grouped([hashes], counts)
        cuts = np.searchsorted(slot_of(hashes, slots), np.arange(slots + 1))
        parts = [(s, pack(deltas(hashes[a:b])), pack(counts[a:b].astype(np.uint64))) for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
        return batch_of({n: (t, [p[i] for p in parts]) for i, (n, t) in enumerate((("slot", pa.int32()), ("data", pa.binary()), ("counts", pa.binary())))})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = 0
        for _, words, sizes in _portions(batches, 4 * CHUNK_TOKENS):
            texts += len(sizes)
            seen = pc.value_counts(words)
            yield emit(hashes_of(seen.field("values")), seen.field("counts").to_numpy(zero_copy_only=False))
        yield emit(np.array([END, START], np.uint64), np.array([texts, texts]))

    return run


def _write_words(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, group in groupby(rows(batches, "slot", "data", "counts"), lambda r: r[0]):
            parts = [(np.cumsum(unpack(d, np.uint64), dtype=np.uint64), unpack(c, np.uint64)) for _, d, c in group]
            (hashes,), counts = _grouped([np.concatenate([p[0] for p in parts])], np.concatenate([p[1] for p in parts]))
            path = f"{folder}/words-{slot}-{uuid.uuid4().hex}"
            _put(path, {"hash": hashes, "count": counts})
            yield batch_of({"slot": (pa.int32(), [slot]), "path": (pa.string(), [path]), "n": (pa.int64(), [len(hashes)]), "total": (pa.int64(), [int(counts.sum())])})

    return run


class Vocabulary:
    """Level 1: words by hash, through memory-mapped shards."""

    def __init__(self, shards: list[tuple[int, str, int, int]], slots: int) -> None:
        self.slots = slots
        self.paths = {s: p for s, p, _, _ in shards}
        sizes = np.zeros(slots + 1, np.int64)
        for s, _, n, _ in shards:
            sizes[s + 1] = n
        self.first = np.cumsum(sizes)
        self.n = int(self.first[-1])
        self._open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def _shard(self, s: int) -> tuple[np.ndarray, np.ndarray]:
        if s not in self._open:
            arrays = _get(self.paths[s])
            self._open[s] = arrays["hash"], arrays["count"]
        return self._open[s]

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each word (n for words not seen in training), and its count."""
        numbers, counts = np.full(len(hashes), self.n, np.int64), np.zeros(len(hashes), np.int64)
        order = np.argsort(hashes)
        sorted_ = hashes[order]
        slots = slot_of(sorted_, self.slots)
        for s in np.unique(slots):
            if s not in self.paths:
                continue
            mine = slice(*np.searchsorted(slots, [s, s + 1]))
            known, seen = self._shard(int(s))
            at = np.minimum(np.searchsorted(known, sorted_[mine]), len(known) - 1)
            hit = known[at] == sorted_[mine]
            numbers[order[mine]] = np.where(hit, self.first[s] + at, self.n)
            counts[order[mine]] = np.where(hit, seen[at], 0)
        return numbers, counts


def _chunks(batches: Iterable[pa.RecordBatch], vocabulary: Vocabulary):
    """Per chunk of texts: rows, per token its number and count, tokens per text (words and the end)."""
    for keys, words, sizes in _portions(batches, CHUNK_TOKENS):
        coded = words.dictionary_encode().combine_chunks()
        known = coded.dictionary
        numbers, counts = vocabulary.look_up(np.append(hashes_of(known), np.array([END], np.uint64)))
        tokens = np.full(len(words) + len(sizes), len(known))
        tokens[np.arange(len(words)) + np.repeat(np.arange(len(sizes)), sizes)] = coded.indices.to_numpy()
        yield keys, numbers[tokens], counts[tokens], sizes + 1


def _padded(tokens: np.ndarray, sizes: np.ndarray, before: int, after: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts with `before` pads in front and `after` behind; places of the texts' own tokens."""
    place = np.arange(len(tokens)) + np.repeat(before + np.arange(len(sizes)) * (before + after), sizes)
    out = np.full(len(tokens) + len(sizes) * (before + after), pad, np.int64)
    out[place] = tokens
    return out, place


def _gram_counts(vocabulary: Vocabulary, order: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pad = int(vocabulary.look_up(np.array([START], np.uint64))[0][0])
        for _, tokens, _, sizes in _chunks(batches, vocabulary):
            line, _ = _padded(tokens, sizes, order - 1, order - 2, pad)
            # windows that begin in a text or its front pads and end inside it or its back pads
            length = sizes + 2 * order - 3
            begin = np.repeat(np.cumsum(length) - length, sizes + order - 2) + np.concatenate([np.arange(n + order - 2) for n in sizes])
            columns, counts = _windows(line, begin, order)
            cuts = np.searchsorted(columns[0], vocabulary.first)
            slots, data, totals = [], [], []
            for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                if a < b:
                    slots.append(s)
                    own = [c[a:b].astype(np.uint64) for c in columns]
                    packed = [pack(c) for c in (deltas(own[0]), *own[1:])]
                    data.append(b"".join(len(x).to_bytes(8, "little") + x for x in packed))
                    totals.append(pack(counts[a:b].astype(np.uint64)))
            yield batch_of({"slot": (pa.int32(), slots), "data": (pa.binary(), data), "counts": (pa.binary(), totals)})

    return run


def _columns(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at:at + 8], "little")
        out.append(unpack(data[at + 8:at + 8 + n], np.uint64))
        at += 8 + n
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def _write_grams(folder: str, vocabulary: Vocabulary, order: int, discount: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pad = int(vocabulary.look_up(np.array([START], np.uint64))[0][0])
        for slot, group in groupby(rows(batches, "slot", "data", "counts"), lambda r: r[0]):
            parts = [(_columns(d), unpack(c, np.uint64)) for _, d, c in group]
            columns, counts = _grouped([np.concatenate([p[0][k] for p in parts]) for k in range(order)], np.concatenate([p[1] for p in parts]))
            path = f"{folder}/grams-{slot}-{uuid.uuid4().hex}"
            parent, n_parents = columns[0].astype(np.int64) - vocabulary.first[slot], int(vocabulary.first[slot + 1] - vocabulary.first[slot])
            for level in range(2, order + 1):
                key = parent.astype(np.uint64) * np.uint64(vocabulary.n) + columns[level - 1]
                new = np.concatenate(([True], key[1:] != key[:-1]))
                total, own = np.add.reduceat(counts, np.flatnonzero(new)), parent[new]
                spoken = columns[level - 1][new] != np.uint64(pad)
                whole = np.bincount(own[spoken], total[spoken], minlength=n_parents)
                p = np.where(spoken, total - np.minimum(discount, total), 0.0) / np.maximum(whole[own], 1)
                with np.errstate(invalid="ignore", divide="ignore"):
                    back = np.where(whole > 0, discount * np.bincount(own[spoken], minlength=n_parents) / whole, 1.0)
                _put(f"{path}.{level}", Level.arrays(own, n_parents, columns[level - 1][new], p, back))
                parent, n_parents = np.cumsum(new) - 1, len(own)
            yield batch_of({"slot": (pa.int32(), [slot]), "path": (pa.string(), [path])})

    return run


class Trie:
    """The model: level 1, and the shards of the higher levels."""

    def __init__(self, vocabulary: Vocabulary, shards: dict[int, str], order: int, tokens: int, words: int) -> None:
        self.vocabulary, self.shards, self.order, self.tokens, self.words = vocabulary, shards, order, tokens, words
        self._open: dict = {}

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    @cached_property
    def start(self) -> int:
        return int(self.vocabulary.look_up(np.array([START], np.uint64))[0][0])

    def _level(self, slot: int, level: int) -> Level:
        if (slot, level) not in self._open:
            self._open[slot, level] = Level(_get(f"{self.shards[slot]}.{level}"))
        return self._open[slot, level]

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1) / (self.tokens + self.words + 1)

    def probabilities(self, line: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """p(w | the order - 1 words before) at each place of a line of word numbers, from order - 1 on; `counts` by place.

        Level by level: the context of a gram is the gram of the place before, whose node is known, so each
        distinct gram of the line takes one step down."""
        p, n = self.unigram(counts), self.vocabulary.n
        words, gram = _numbered(line)
        slot = np.searchsorted(self.vocabulary.first, words, side="right") - 1
        node = np.where(words < n, words - self.vocabulary.first[np.minimum(slot, self.vocabulary.slots - 1)], -1)
        width = len(words)
        word = gram
        for level in range(2, self.order + 1):
            # places before order - 1 have no whole context and are not asked for
            before = np.concatenate(([0], gram[:-1]))
            distinct, gram = _numbered(before * width + word)
            parent, last = distinct // width, words[distinct % width]
            slot, context = slot[parent], node[parent]
            found, weight, node = np.zeros(len(distinct)), np.ones(len(distinct)), np.full(len(distinct), -1)
            known = np.flatnonzero(context >= 0)
            cuts = np.searchsorted(slot[known], np.arange(self.vocabulary.slots + 1))
            for s in np.flatnonzero(cuts[1:] > cuts[:-1]):
                if s not in self.shards:
                    continue
                mine = known[cuts[s]:cuts[s + 1]]
                grams = self._level(int(s), level)
                weight[mine] = VALUES[grams.back[context[mine]]]
                ask = mine[last[mine] < n]
                node[ask] = place = grams.successors(context[ask], last[ask])
                hit = place >= 0
                found[ask[hit]] = VALUES[grams.p[place[hit]]]
            p = np.minimum(found[gram] + weight[gram] * p, 1.0)  # the bound is exact but for the last bit
        return p


def train(docs: DataFrame, folder: str | None = None, order: int = ORDER, discount: float = DISCOUNT) -> Trie:
    """Count, build and write the trie of all given texts."""
    spark = docs.sparkSession
    slots = buckets_of(spark)
    folder = folder or f"{shared_dir(spark)}/trie-{uuid.uuid4().hex}"
    files, at = fs.FileSystem.from_uri(folder) if ":" in folder.split("/")[0] else (fs.LocalFileSystem(), folder)
    files.create_dir(at, recursive=True)
    texts = docs.select(F.col("text").cast("string").alias("text"))

    def by_slot(frame: DataFrame) -> DataFrame:
        return frame.repartition("slot").sortWithinPartitions("slot")

    counted = by_slot(texts.mapInArrow(_word_counts(slots), MESSAGE))
    shards = [tuple(r) for r in counted.mapInArrow(_write_words(folder), "slot int, path string, n long, total long").collect()]
    vocabulary = Vocabulary(shards, slots)
    _, (starts,) = vocabulary.look_up(np.array([START], np.uint64))
    grams: dict[int, str] = {}
    if starts:
        counted = by_slot(texts.mapInArrow(_gram_counts(vocabulary, order), MESSAGE))
        grams = {r.slot: r.path for r in counted.mapInArrow(_write_grams(folder, vocabulary, order, discount), "slot int, path string").collect()}
    return Trie(vocabulary, grams, order, sum(s[3] for s in shards) - int(starts), max(0, vocabulary.n - 1) if starts else 0)


def _score(trie: Trie):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, tokens, counts, sizes in _chunks(batches, trie.vocabulary):
            first = np.cumsum(sizes) - sizes
            base = np.log10(trie.unigram(counts))
            line, place = _padded(tokens, sizes, trie.order - 1, 0, trie.start)
            seen = np.zeros(len(line), np.int64)
            seen[place] = counts
            p = trie.probabilities(line, seen)[place]
            yield batch_of({
                "doc_id": (pa.int64(), [k[0] for k in keys]), "n_tokens": (pa.int64(), pa.array(sizes)),
                "n_known": (pa.int64(), pa.array(np.add.reduceat((counts > 0).astype(np.int64), first))),
                "train_tokens": (pa.int64(), [trie.tokens] * len(keys)), "base_score": (pa.float64(), pa.array(np.add.reduceat(base, first))),
                "score": (pa.float64(), pa.array(np.add.reduceat(np.log10(p), first))),
            })

    return run


def score_texts(docs: DataFrame, trie: Trie) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every text."""
    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return ready.mapInArrow(_score(trie), "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out(key: str = "doc_id") -> Column:
    return crc_mod(key, 7) == 2
