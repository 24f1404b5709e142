"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text.

P(grade > k) = sigmoid(x . w - t_k) with one weight vector for all grades and ordered thresholds
t_0 < t_1 < ...; the expected grade is the sum of these tail probabilities. x holds the mean of a
text's hashed tokens, each as its lower-cased word and as its shape (case, digits, repeated marks),
tokens of more than `PIECE` bytes as consecutive pieces, and hashed buckets of length and repetition. Documents are selected by a tail probability.

Training: at most `sample` labelled documents chosen by a hash of the id (a bounded sample, a
parameter) are hashed once and written to the shared folder. Each round, every partition takes AdaGrad
steps from the common weights, and the results are averaged: a round is one Spark job, a lost
executor costs its partitions of that round.

Grades here: 0 for quality 0, 1 for good but toxic documents, 2 for good ones. Null labels and ids
are not learned from. Null and empty texts have no tokens, only the buckets of an empty text.
Texts are read whole; repeated rows score alike; other columns are ignored. Without labels all
weights are zero and every document is selected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import batch_of, crc_mod, slices, utf8
from .toxicity import labelled_sample

SAMPLE, BITS, ROUNDS, EPOCHS, PARTS, RATE, CUT = 16_000, 16, 4, 3, 8, 0.5, 0.5
MASK = (1 << BITS) - 1
_SHAPE = re.compile(rb"([A-Z])|([a-z\x80-\xff])|([0-9])|(.)", re.S)
_KEEP = 150_000
#: Longest token in bytes; texts without white space are cut into pieces of that length.
PIECE = 48


def shape(token: bytes) -> bytes:
    """Runs of upper case, lower case and digits as one letter each; marks as they are, runs marked."""
    out, last = bytearray(), -1
    for m in _SHAPE.finditer(token):
        c = b"Aa0"[m.lastindex - 1] if m.lastindex < 4 else token[m.start()]
        if c != last:
            out.append(c)
        elif m.lastindex == 4 and out[-1:] != b"+":
            out += b"+"
        last = c
    return bytes(out)


def tokens_of(text: bytes | None) -> list[bytes]:
    """The words of a text, long ones in pieces: every byte but white space is in one token."""
    words = (text or b"").split()
    if max(map(len, words), default=0) <= PIECE:
        return words
    return [w[i:i + PIECE] for w in words for i in range(0, len(w), PIECE)]


def token_indices(token: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_64_intdigest
    return h(b"w" + token.lower()) & MASK, h(b"s" + shape(token)) & MASK


def text_indices(n: int, distinct: int) -> tuple[int, ...]:
    """Buckets of length and repetition."""
    length, fresh = n.bit_length(), (10 * distinct // n) if n else 10
    h = xxhash.xxh3_64_intdigest
    return h(b"n%d" % length) & MASK, h(b"d%d" % fresh) & MASK, h(b"r%d:%d" % (length, fresh)) & MASK


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        places, values = [], []
        for text in utf8(batch, "text"):
            tokens = tokens_of(text)
            counts: Counter = Counter()
            words = Counter(tokens)
            for token, n in words.items():
                for i in token_indices(token):
                    counts[i] += n / len(tokens)
            for i in text_indices(len(tokens), len(words)):
                counts[i] += 1.0
            places.append(list(counts))
            values.append(list(counts.values()))
        yield batch_of({
            "grade": (pa.int32(), batch.column("grade")), "places": (pa.list_(pa.int32()), places), "values": (pa.list_(pa.float64()), values),
        })


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _train(weights: np.ndarray, cuts: np.ndarray, epochs: int, rate: float, seed: int):
    """AdaGrad on the likelihood of P(grade = g) = P(> g - 1) - P(> g)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [
            (g, np.array(p, np.int64), np.array(v)) for b in batches
            for g, p, v in zip(b.column("grade").to_pylist(), b.column("places").to_pylist(), b.column("values").to_pylist(), strict=True)
        ]
        if not rows:
            return
        rows.sort(key=lambda r: (r[1].tolist(), r[2].tolist(), r[0]))
        w, t = weights.copy(), cuts.copy()
        sw, st = np.full(len(w), 1e-6), np.full(len(t), 1e-6)
        order = np.random.default_rng(seed)
        for _ in range(epochs):
            for i in order.permutation(len(rows)):
                g, places, values = rows[i]
                s = w[places] @ values
                upper = _sigmoid(s - t[g - 1]) if g > 0 else 1.0
                lower = _sigmoid(s - t[g]) if g < len(t) else 0.0
                p = max(upper - lower, 1e-9)
                du, dl = upper * (1 - upper), lower * (1 - lower)
                grad = -(du - dl) / p * values
                sw[places] += grad**2
                w[places] -= rate * grad / np.sqrt(sw[places])
                for k, d in ((g - 1, du / p), (g, -dl / p)):
                    if 0 <= k < len(t):
                        st[k] += d**2
                        t[k] -= rate * d / np.sqrt(st[k])
                t.sort()
        yield batch_of({"n": (pa.int64(), [len(rows)]), "w": (pa.binary(), [w.tobytes()]), "t": (pa.binary(), [t.tobytes()])})

    return run


class Ordinal:
    """Weights and ordered thresholds."""

    def __init__(self, weights: np.ndarray, cuts: np.ndarray) -> None:
        self.weights, self.cuts = weights, cuts

    def scorer(self):
        """text -> x . w, with a cache of token scores."""
        weights = self.weights

        class Cache(dict):
            def __missing__(self, token: bytes) -> float:
                a, b = token_indices(token)
                self[token] = value = float(weights[a] + weights[b])
                return value

        cache = Cache()

        def score(text: bytes | None) -> float:
            tokens = tokens_of(text)
            if len(cache) > _KEEP:
                cache.clear()
            mean = sum(map(cache.__getitem__, tokens)) / len(tokens) if tokens else 0.0
            return mean + float(sum(weights[i] for i in text_indices(len(tokens), len(set(tokens)))))

        return score

    def tails(self, score: float) -> list[float]:
        return [float(_sigmoid(score - t)) for t in self.cuts]


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS, seed: str = "quality-1") -> Ordinal:
    good, toxic = F.col("quality").cast("int"), F.coalesce(F.col("toxic").cast("int"), F.lit(0))
    grade = {"grade": F.when(good == 0, 0).otherwise(2 - toxic)}
    known = labelled_sample(docs, labels, F.col("quality").isin(0, 1), grade, sample, seed).select("text", "grade")
    hashed = known.mapInArrow(_features, "grade int, places array<int>, values array<double>")
    # in an order of their own, so that a run again takes the same steps
    dealt = hashed.repartition(PARTS, F.xxhash64("places")).sortWithinPartitions("places", "values", "grade")
    hashed = stage(dealt, "quality-features")
    weights, cuts = np.zeros(1 << BITS), np.array([-2.0, 0.0])
    for r in range(rounds):
        parts = hashed.mapInArrow(_train(weights, cuts, EPOCHS, RATE / (1 + r), r), "n long, w binary, t binary").collect()
        if not parts:
            break
        n = np.array([p.n for p in parts], float)
        weights = np.average([np.frombuffer(p.w) for p in parts], axis=0, weights=n)
        cuts = np.average([np.frombuffer(p.t) for p in parts], axis=0, weights=n)
    return Ordinal(weights, cuts)


def grade_documents(docs: DataFrame, model: Ordinal, cut: float = CUT) -> DataFrame:
    """doc_id, expected_grade, p_above_0, p_above_1, selected (p_above_0 >= cut) of every document."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in slices(batches):
            tails = [model.tails(score(t)) for t in utf8(batch, "text")]
            yield batch_of({
                "doc_id": (pa.int64(), batch.column("doc_id")), "expected_grade": (pa.float64(), [sum(t) for t in tails]),
                "p_above_0": (pa.float64(), [t[0] for t in tails]), "p_above_1": (pa.float64(), [t[1] for t in tails]),
                "selected": (pa.bool_(), [t[0] >= cut for t in tails]),
            })

    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return ready.mapInArrow(run, "doc_id long, expected_grade double, p_above_0 double, p_above_1 double, selected boolean")


def select_documents(docs: DataFrame, model: Ordinal, cut: float = CUT) -> DataFrame:
    """The selected documents, with all their columns."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in slices(batches):
            yield batch.filter(pa.array([model.tails(score(t))[0] >= cut for t in utf8(batch, "text")], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(key: str = "doc_id") -> Column:
    return crc_mod(key, 5) == 2
