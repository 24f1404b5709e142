"""N-gram Jaccard join of whole texts by T-occurrence search.

A document's set holds its distinct 5-word shingles (64-bit hashes). Two sets of sizes m and n reach
Jaccard 0.8 when their overlap reaches T = ceil(80 (m + n) / 180). The search, as Spark jobs:

1. Count. Every task sends each distinct shingle once, packed by hash range; each range answers how
   many documents hold it. A document whose shared shingles are under 80 % of its set has no partner
   and leaves. Document frequencies are exact up to 48-bit hash collisions, which only raise them.
2. The rest is grouped by equal sets; one document stands for each. Frequencies are counted again
   among these, and every set is ordered by (frequency, hash): the short inverted lists first.
3. DivideSkip: the first n - ceil(0.8 n) + 1 lists are the short ones. They are merged by a shuffle
   on the shingle; a pair that meets in none of them cannot reach T. The long lists are never
   merged: a candidate's sorted set is probed for their shingles by binary search, and a pair whose
   short hits plus open long lists fall short of T is given up before.
4. First every member of a short list is checked against its two end members, and links give
   components. Then only pairs that share a short list and are still in different components are
   checked, so that the components are found without all pairs of a large group.
5. Every link lies inside a component, so `jaccard_links` counts them there: the sets of a component
   are dealt in salted blocks, and a task takes the overlaps of all pairs of its block at once as a
   product of 0/1 matrices. Only a count per set leaves the task, no row per pair.

n_links of a row is the number of other documents that reach 0.8 with it; rows of equal doc_id and equal
set are one document, so a set of k documents counts k times, for its own members k - 1 times.

Nulls and empty texts have an empty set and no partner. Rows that share a doc_id are one node;
a null doc_id keeps a null component
and has no links. Other columns of the input are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import Words, batch_of, buckets_of, deltas, distinct, pack, rows, slices, unpack, utf8
from .components import components

WORDS, SHARE = 5, 80
CHUNK = 500_000
#: Sets and shingles in one side of a block of a component, and shared shingles in one matrix.
BLOCK, BLOCK_SHINGLES, COLUMNS = 512, 1_000_000, 4096
MESSAGE = "slot int, chunk long, data binary"
_MULT = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(hashes: np.ndarray, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle, an empty one none."""
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    n = len(hashes) - width + 1
    acc = hashes[:n] + np.uint64(width)
    for k in range(1, width):
        acc = (acc ^ (acc >> np.uint64(31))) * _MULT + hashes[k:k + n]
    return distinct((acc ^ (acc >> np.uint64(29))) * _MULT)


def required(m: int, n: int, share: int = SHARE) -> int:
    """Least overlap at which 100 * overlap >= share * union."""
    return -(-share * (m + n) // (100 + share))


def short_lists(n: int, share: int = SHARE) -> int:
    """Lists that must be merged: with fewer than this many set apart, the rest cannot reach T."""
    return n - -(-share * n // 100) + 1


def _digest(shingles: np.ndarray) -> bytes | None:
    return blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _messages(words: int, buckets: int, carry: bool):
    """Per chunk of documents: a header (who they are), and one packed run of shingles per range."""

    def emit(chunk: int, ids: list, digests: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(s) for s in sets], np.uint32)
        every = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        order = np.argsort(every, kind="stable")
        values, counts = np.unique(every[order], return_counts=True)
        short = values >> np.uint64(16)
        owner = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)[order]
        head = {"ids": ids, "digests": digests, "sizes": pack(sizes), "owner": pack(owner), "counts": pack(counts.astype(np.uint32))}
        if carry:
            head["values"] = pack(deltas(values))
        slot = (short >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)
        cuts = np.searchsorted(slot, np.arange(buckets + 1, dtype=np.uint64))
        # headers take slots of their own, spread by task and by chunk within the task
        slots, data = [-1 - (31 * (chunk >> 24) + chunk % (1 << 24)) % 4096], [pickle.dumps(head)]
        for b in range(buckets):
            lo, hi = cuts[b], cuts[b + 1]
            if lo < hi:
                slots.append(b)
                data.append(pickle.dumps((pack(deltas(short[lo:hi])), pack(counts[lo:hi].astype(np.uint32)))))
        return batch_of({"slot": (pa.int32(), slots), "chunk": (pa.int64(), [chunk] * len(slots)), "data": (pa.binary(), data)})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, base, n = Words(), TaskContext.get().partitionId() << 24, 0
        ids, digests, sets, held = [], [], [], 0
        for batch in slices(batches):
            wanted = batch.column("digest").to_pylist() if carry else None
            for i, (key, text) in enumerate(zip(batch.column("doc_id").to_pylist(), utf8(batch, "text"), strict=True)):
                s = shingle_set(vocabulary.hash_text(text), words)
                digest = _digest(s)
                if carry and digest != wanted[i]:
                    continue
                ids.append(key)
                digests.append(digest)
                sets.append(s)
                held += len(s)
                if held >= CHUNK or len(ids) >= 1 << 16:
                    yield emit(base + n, ids, digests, sets)
                    ids, digests, sets, held, n = [], [], [], 0, n + 1
        if ids:
            yield emit(base + n, ids, digests, sets)

    return run


def _frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers each chunk, in its own order, how many documents hold each shingle of a range."""

    def out(messages: list[tuple]) -> pa.RecordBatch:
        return batch_of({n: (t, [m[i] for m in messages]) for i, (n, t) in enumerate((("slot", pa.int32()), ("chunk", pa.int64()), ("data", pa.binary())))})

    for slot, group in groupby(rows(batches, "slot", "chunk", "data"), itemgetter(0)):
        if slot < 0:
            for message in group:
                yield out([message])
            continue
        chunks, values, counts = [], [], []
        for _, chunk, data in group:
            v, c = pickle.loads(data)
            chunks.append(chunk)
            values.append(np.cumsum(unpack(v, np.uint64), dtype=np.uint64))
            counts.append(unpack(c, np.uint32))
        _, at = np.unique(np.concatenate(values), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts)).astype(np.uint32)[at]
        ends = np.cumsum([len(v) for v in values])
        yield out([(slot, c, pack(t)) for c, t in zip(chunks, np.split(total, ends[:-1]), strict=True)])


def _chunks(batches: Iterable[pa.RecordBatch]):
    """Per chunk: header, and by document the places of its shingles with their frequencies."""
    for _, group in groupby(rows(batches, "chunk", "slot", "data"), itemgetter(0)):
        head, answers = None, []
        for _, slot, data in group:
            if slot < 0:
                head = pickle.loads(data)
            else:
                answers.append(unpack(data, np.uint32))
        counts, owner = unpack(head["counts"], np.uint32), unpack(head["owner"], np.uint32)
        frequency = np.concatenate(answers) if answers else np.empty(0, np.uint32)
        yield head, np.repeat(np.arange(len(counts)), counts), np.repeat(frequency, counts), owner


def _alive(share: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, _, frequency, owner in _chunks(batches):
            sizes = unpack(head["sizes"], np.uint32).astype(np.int64)
            shared = np.bincount(owner[frequency > 1], minlength=len(sizes))
            alive = (100 * shared >= share * sizes) & (sizes > 0)
            yield batch_of({
                "doc_id": (pa.int64(), head["ids"]), "n_shingles": (pa.int64(), pa.array(sizes)),
                "digest": (pa.binary(), head["digests"]), "alive": (pa.bool_(), pa.array(alive)),
            })

    return run


def _ordered(share: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, place, frequency, owner in _chunks(batches):
            values = np.cumsum(unpack(head["values"], np.uint64), dtype=np.uint64)[place]
            order = np.lexsort((values, frequency, owner))
            cuts = np.searchsorted(owner[order], np.arange(len(head["ids"]) + 1))
            out: list[tuple] = []
            for i, key in enumerate(head["ids"]):
                mine = order[cuts[i]:cuts[i + 1]]
                n = len(mine)
                single = int((frequency[mine] == 1).sum())
                short = values[mine[single:short_lists(n, share)]]
                if len(short):
                    out.append((key, n, single, short.tobytes(), np.sort(values[mine]).tobytes(), head["digests"][i]))
            yield batch_of({
                "id": (pa.int64(), [o[0] for o in out]), "n": (pa.int32(), [o[1] for o in out]), "skip": (pa.int32(), [o[2] for o in out]),
                "short": (pa.binary(), [o[3] for o in out]), "shingles": (pa.binary(), [o[4] for o in out]),
                "digest": (pa.binary(), [o[5] for o in out]),
            })

    return run


def _postings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [np.frombuffer(b, np.int64) for b in batch.column("short").to_pylist()]
        sizes = np.array([len(x) for x in lists], np.int64)
        if not sizes.sum():
            continue
        skip = batch.column("skip").to_numpy()
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        yield batch_of({
            "shingle": (pa.int64(), pa.array(np.concatenate(lists))),
            "id": (pa.int64(), pa.array(np.repeat(batch.column("id").to_numpy(), sizes))),
            "n": (pa.int32(), pa.array(np.repeat(batch.column("n").to_numpy(), sizes))),
            "pos": (pa.int32(), pa.array((np.arange(sizes.sum()) - first + np.repeat(skip, sizes)).astype(np.int32))),
            "skip": (pa.int32(), pa.array(np.repeat(skip, sizes))),
        })


def overlap(short: np.ndarray, query: np.ndarray, candidate: np.ndarray, least: int) -> int:
    """|query & candidate|, or some number under `least` as soon as that is out of reach."""

    def hits(keys: np.ndarray) -> int:
        at = np.searchsorted(candidate, keys)
        return int((candidate[np.minimum(at, len(candidate) - 1)] == keys).sum())

    found = hits(short)
    if found + len(query) - len(short) < least:
        return found
    return hits(query)


def _verify(share: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for u, v, short, x, y in rows([batch], "u", "v", "short", "x", "y"):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                least = required(len(a), len(b), share)
                if min(len(a), len(b)) >= least and overlap(np.frombuffer(short, np.uint64), a, b, least) >= least:
                    us.append(u)
                    vs.append(v)
            yield batch_of({"u": (pa.int64(), us), "v": (pa.int64(), vs)})

    return run


def _links(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    x = sets.select(F.col("id").alias("u"), "short", F.col("shingles").alias("x"))
    y = sets.select(F.col("id").alias("v"), F.col("shingles").alias("y"))
    return pairs.join(x, "u").join(y, "v").mapInArrow(_verify(share), "u long, v long")


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """|x & y| of every x of `a` and every y of `b`, each sorted and distinct."""
    out = np.zeros((len(a), len(b)), np.int64)
    values = [np.concatenate(x) if x else np.empty(0, np.uint64) for x in (a, b)]
    shared = np.intersect1d(distinct(values[0]), distinct(values[1]), assume_unique=True)
    if not len(shared):
        return out
    held = []
    for x, v in zip((a, b), values, strict=True):
        at = np.minimum(np.searchsorted(shared, v), len(shared) - 1)
        hit = shared[at] == v
        column, row = at[hit], np.repeat(np.arange(len(x)), [len(y) for y in x])[hit]
        order = np.argsort(column, kind="stable")
        held.append((column[order], row[order]))
    for low in range(0, len(shared), COLUMNS):
        sides = []
        for x, (column, row) in zip((a, b), held, strict=True):
            part = slice(*np.searchsorted(column, [low, low + COLUMNS]))
            side = np.zeros((len(x), min(COLUMNS, len(shared) - low)), np.float32)
            side[row[part], column[part] - low] = 1
            sides.append(side)
        out += (sides[0] @ sides[1].T).astype(np.int64)
    return out


def _count(share: int):
    """Per set of a block, how many documents of the block its links lead to."""

    def linked(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        m, n = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        return overlaps(a, b) >= -(-share * (m[:, None] + n) // (100 + share))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groupby(rows(batches, "component", "part", "side", "digest", "times", "shingles"), itemgetter(0, 1)):
            own = {r[3]: r for r in group}  # a set read from two texts of one doc_id is there twice
            sides: list[list[tuple]] = [[], [], []]
            for r in own.values():
                sides[r[2]].append(r)
            sets = [[np.frombuffer(r[5], np.uint64) for r in side] for side in sides]
            times = [np.array([r[4] for r in side], np.int64) for side in sides]
            digests, counts = [], []
            if sets[2]:
                within = linked(sets[2], sets[2])
                np.fill_diagonal(within, False)
                digests, counts = [r[3] for r in sides[2]], [within @ times[2]]
            elif sets[0] and sets[1]:
                across = linked(sets[0], sets[1])
                digests, counts = [r[3] for r in sides[0] + sides[1]], [across @ times[1], times[0] @ across]
            if digests:
                yield batch_of({"digest": (pa.binary(), digests), "others": (pa.int64(), pa.array(np.concatenate(counts)))})

    return run


def _link_counts(sets: DataFrame, groups: DataFrame, classes: DataFrame, share: int) -> DataFrame:
    """(digest, others): documents of other sets that a set is linked to, over all blocks of its component."""
    placed = sets.select("id", "digest", "n", "shingles").join(groups.select("id", "component"), "id")
    sizes = placed.groupBy("component").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s")).where("m > 1")
    parts = F.least("m", F.ceil(F.greatest(F.col("m") / BLOCK, F.col("s") / BLOCK_SHINGLES))).cast("long")
    dealt = placed.join(sizes.select("component", parts.alias("parts")), "component").join(classes.select("digest", "times"), "digest")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("digest"), F.col("parts"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    blocks = dealt.select("component", (low * F.col("parts") + high).alias("part"), side.cast("int").alias("side"), "digest", "times", "shingles")
    blocks = blocks.repartition("component", "part").sortWithinPartitions("component", "part")
    return blocks.mapInArrow(_count(share), "digest binary, others long").groupBy("digest").agg(F.sum("others").alias("others"))


def jaccard_groups(docs: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    seen, _, _, groups = _search(docs, words, share)
    return _with_component(seen, groups).select("doc_id", "n_shingles", "component_id")


def jaccard_links(docs: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """One row per input row: doc_id, n_shingles, n_links, component_id."""
    seen, classes, sets, groups = _search(docs, words, share)
    counts = classes.select("digest", "times").join(_link_counts(sets, groups, classes, share), "digest", "left")
    counts = counts.select("digest", (F.col("times") - 1 + F.coalesce("others", F.lit(0))).alias("links")).where("links > 0")
    counts = stage(counts, "link-counts")  # joined from a table of its own, so that a hot set can be split
    out = _with_component(seen, groups).join(counts, "digest", "left")
    n_links = F.when(F.col("doc_id").isNotNull(), F.coalesce("links", F.lit(0))).otherwise(0)
    return out.select("doc_id", "n_shingles", n_links.cast("long").alias("n_links"), "component_id")


def _with_component(seen: DataFrame, groups: DataFrame) -> DataFrame:
    out = seen.join(groups.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return out.withColumn("component_id", F.coalesce("component", "doc_id"))


def _search(docs: DataFrame, words: int, share: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Rows with the digest of their set, classes of equal sets, their sets, and components by doc_id."""
    buckets = buckets_of(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def counted(frame: DataFrame, carry: bool) -> DataFrame:
        sent = frame.mapInArrow(_messages(words, buckets, carry), MESSAGE)
        answered = sent.repartition("slot").sortWithinPartitions("slot").mapInArrow(_frequencies, MESSAGE)
        return answered.repartition("chunk").sortWithinPartitions("chunk", "slot")

    seen = stage(counted(docs, False).mapInArrow(_alive(share), "doc_id long, n_shingles long, digest binary, alive boolean"), "sets-seen")
    alive = seen.where("alive and doc_id is not null")
    owners = alive.select("digest", "doc_id").distinct()
    classes = owners.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("times"))
    copies = alive.join(classes, "digest").where("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    texts = docs.join(classes.select(F.col("rep").alias("doc_id"), "digest"), "doc_id").dropDuplicates(["doc_id", "digest", "text"])
    sets = stage(counted(texts, True).mapInArrow(_ordered(share), "id long, n int, skip int, short binary, shingles binary, digest binary"), "sets")
    postings = stage(sets.select("id", "n", "skip", "short").mapInArrow(_postings, "shingle long, id long, n int, pos int, skip int"), "short-lists")

    # the member with the fewest shingles of its own is the likeliest to be what the others are copies of
    middle = F.min(F.struct("skip", "id"))["id"].alias("mid")
    ends = postings.groupBy("shingle").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), middle).where("lo < hi")
    met = postings.select("shingle", "id").join(ends, "shingle").select("id", F.explode(F.array("lo", "hi", "mid")).alias("end"))
    pairs = met.where("id <> end").select(F.least("id", "end").alias("u"), F.greatest("id", "end").alias("v")).distinct()
    links = stage(_links(pairs, sets, share), "links")

    joined = components(links, "u", "v").withColumnRenamed("component", "c")
    lists = postings.join(joined, "id", "left").withColumn("c", F.coalesce("c", "id"))
    open_lists = lists.groupBy("shingle").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("shingle")
    lists = stage(lists.join(open_lists, "shingle", "left_semi"), "open-lists")
    a, b = lists.alias("a"), lists.alias("b")
    t = F.ceil(F.expr(f"{share} * (a.n + b.n) / {100 + share}"))
    rest = a.join(b, F.expr("a.shingle = b.shingle and a.id < b.id and a.c <> b.c")).where(
        F.expr(f"100 * least(a.n, b.n) >= {share} * greatest(a.n, b.n)")
        & (F.expr("least(a.n - a.pos, b.n - b.pos)") >= t)  # holds at the first shingle both share
    )
    rest = rest.select(F.col("a.id").alias("u"), F.col("b.id").alias("v")).distinct()
    more = _links(rest, sets, share)
    edges = links.unionByName(more).unionByName(copies)
    return seen, classes, sets, components(edges, "u", "v")
