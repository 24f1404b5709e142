"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexical transducer reads a clause's tokens and writes symbols: INSULT and THREAT with a weight, TARGET,
NEGATION, REPORT, or nothing. Three transducers over these symbols are composed into one: negation (its state is how many
tokens it still covers), reported speech and target (whether one was met). An insult adds its weight,
damped if negated or reported; a threat counts only in a clause that names a target; a target
raises the whole clause, as the final weights of the composed states say. A document's evidence is the sum over its matched clauses, so isolated
function words never score. A logistic curve over the evidence and its share per clause gives the
score.

The insult lexicon is learned: whole words and word stems whose document frequency is nearly all on
toxic documents, weighted by their log odds. It is learned on at most `sample` labelled documents,
chosen by a hash of the id, and holds at most `lexicon` entries; both bounds are parameters. Closed
classes (targets, negations, verbs of speech, threats) are fixed lists.

Null and empty texts have no evidence and get the curve's lowest score. Documents are scored whole,
row by row: repeated rows score alike, other columns are ignored. Without usable labels the
lexicon is empty and only the fixed threats raise a score. Null labels and ids are not learned from.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_of, crc_mod, rows, slices
from .mixing import hashed_unit

SAMPLE, LEXICON, CUT = 20_000, 5_000, 0.3
STEMS = range(4, 8)
LEAST_DOCS, PURITY = 5, 0.95
NEGATED, REPORTED, TARGETED, REACH = 0.5, 0.6, 1.5, 3

# Closed word classes of English, German, French and Spanish.
TARGETS = "you your yours yourself he she him her they them du dich dir ihr euch sie vous toi tu te usted ustedes ti ellos".split()
NEGATIONS = "not never no none nobody nicht nie kein keine niemals jamais aucun nunca jamás ningún".split()
REPORTS = 'said says say told wrote claimed sagte sagt schrieb dit disait écrit dijo dice escribió " « » “ ” „'.split()
THREATS = (
    "kill kills killed killing hurt hurts hurting murder murders murdered murdering destroy destroys destroyed destroying "
    "strangle strangles strangled strangling stab stabs stabbed stabbing töten tötet tötete getötet umbringen umbringt "
    "umgebracht tuer tuerai tuera frapper frappe frapperai matar mataré matará golpear golpea golpearé"
).split()
THREAT_WEIGHT = 4.0

_CLAUSE = re.compile(r"[.!?;:\n]+")
_TOKEN = re.compile(r"[^\W\d_]+|[\"«»“”„]")
_WORD = re.compile(r"[^\W\d_]+")


SYMBOLS = ("", "INSULT", "THREAT", "TARGET", "NEGATION", "REPORT")


@dataclass(frozen=True)
class Transducer:
    """A deterministic weighted transducer over symbols. An arc (state, symbol) leads to a state, writes a symbol and
    multiplies its weight; a final state multiplies the insults and the threats of a clause."""

    start: object
    arcs: dict[tuple[object, str], tuple[object, str, float]]
    finals: dict[object, tuple[float, float]]


def transducer(states: Iterable, step: Callable[[object, str], tuple[object, float]], final: Callable[[object], tuple[float, float]]) -> Transducer:
    """From a step (state, symbol) -> (state, factor); every symbol is written as it is read. The first state starts."""
    states = list(states)
    arcs = {(q, s): (step(q, s)[0], s, step(q, s)[1]) for q in states for s in SYMBOLS}
    return Transducer(states[0], arcs, {q: final(q) for q in states})


def compose(a: Transducer, b: Transducer) -> Transducer:
    """What `a` writes is read by `b`: states are pairs, weights multiply; only pairs that can be reached are kept."""
    start = (a.start, b.start)
    arcs, finals, open_ = {}, {}, [start]
    while open_:
        p, q = pair = open_.pop()
        if pair in finals:
            continue
        finals[pair] = tuple(x * y for x, y in zip(a.finals[p], b.finals[q], strict=True))
        for symbol in SYMBOLS:
            p2, middle, f = a.arcs[p, symbol]
            q2, out, g = b.arcs[q, middle]
            arcs[pair, symbol] = (p2, q2), out, f * g
            open_.append((p2, q2))
    return Transducer(start, arcs, finals)


_HARMS = ("INSULT", "THREAT")
_ALL = (1.0, 1.0)
#: State: how many of the next tokens a negation still covers.
NEGATION = transducer(
    range(REACH + 1), lambda q, s: (REACH if s == "NEGATION" else max(0, q - 1), NEGATED if q and s in _HARMS else 1.0), lambda q: _ALL
)
#: State: whether a verb of speech or a quotation mark came before.
REPORT = transducer((False, True), lambda q, s: (q or s == "REPORT", REPORTED if q and s in _HARMS else 1.0), lambda q: _ALL)
#: State: whether a target was named. Threats without one count nothing.
TARGET = transducer((False, True), lambda q, s: (q or s == "TARGET", 1.0), lambda q: (TARGETED, TARGETED) if q else (1.0, 0.0))
PATTERN = compose(compose(NEGATION, REPORT), TARGET)


@dataclass(frozen=True)
class Grammar:
    """Weights of whole words and of stems (a stem fits any word it begins), and the curve."""

    words: dict[str, float]
    stems: dict[str, float]
    curve: tuple[float, float, float] = (-4.0, 2.0, 0.0)

    def lexical(self, token: str) -> tuple[str, float]:
        if token in TARGETS:
            return "TARGET", 0.0
        if token in NEGATIONS:
            return "NEGATION", 0.0
        if token in REPORTS:
            return "REPORT", 0.0
        if token in THREATS:
            return "THREAT", THREAT_WEIGHT
        weight = self.words.get(token)
        if weight is None:
            weight = max((self.stems[token[:k]] for k in STEMS if token[:k] in self.stems), default=0.0)
        return ("INSULT", weight) if weight else ("", 0.0)

    def clause(self, text: str) -> float:
        """Weight of the clause's only path through the lexical transducer and the composed grammar."""
        state, mass = PATTERN.start, [0.0, 0.0]
        for token in _TOKEN.findall(text):
            symbol, weight = self.lexical(token)
            state, out, factor = PATTERN.arcs[state, symbol]
            if weight:
                mass[out == "THREAT"] += weight * factor
        insults, threats = PATTERN.finals[state]
        return mass[0] * insults + mass[1] * threats

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for word in [*self.words, *self.stems, *THREATS]:
            found.add_word(word, len(word))
        found.make_automaton()
        return found

    def evidence(self, text: str | None, automaton: ahocorasick.Automaton) -> tuple[float, float]:
        """Summed weight of the matched clauses, and the same per clause of the text.

        One automaton pass over the whole text finds where a word of the lexicon may begin; only
        the clauses around those places run through the grammar.
        """
        if not text:
            return 0.0, 0.0
        low = text.lower()
        total, done = 0.0, -1
        for end, length in automaton.iter(low):
            start = end - length + 1
            if start < done or (start and low[start - 1].isalnum()):
                continue
            begin = max(low.rfind(mark, max(done, 0), start) for mark in ".!?;:\n") + 1
            stop = _CLAUSE.search(low, end)
            done = stop.start() if stop else len(low)
            total += self.clause(low[begin:done])
        return total, total / (1 + sum(map(low.count, ".!?;:\n"))) if total else 0.0

    def score(self, total: float, per_clause: float) -> float:
        a, b, c = self.curve
        return 1.0 / (1.0 + math.exp(-(a + b * math.log1p(total) + c * math.log1p(per_clause))))


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies of words (w) and stems (s) in toxic and other documents."""
    seen = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        names = sorted(seen[0].keys() | seen[1].keys())
        out = batch_of({
            "feature": (pa.string(), names), "toxic": (pa.int64(), [seen[1][f] for f in names]), "other": (pa.int64(), [seen[0][f] for f in names]),
        })
        seen[0].clear()
        seen[1].clear()
        return out

    for text, toxic in rows(slices(batches), "text", "toxic"):
        words = {w for w in _WORD.findall((text or "").lower()) if len(w) > 2}
        seen[toxic].update("w" + w for w in words)
        seen[toxic].update({"s" + w[:k] for w in words for k in STEMS if len(w) > k})
        if len(seen[0]) + len(seen[1]) > 200_000:
            yield flush()
    yield flush()


def _evidence(grammar: Grammar):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = grammar.automaton()
        for batch in slices(batches):
            found = [grammar.evidence(t, automaton) for t in batch.column("text").to_pylist()]
            yield batch_of({
                "toxic": (pa.int32(), batch.column("toxic")), "total": (pa.float64(), [f[0] for f in found]), "per_clause": (pa.float64(), [f[1] for f in found]),
            })

    return run


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Logistic regression by Newton steps on log(1 + evidence); the ridge keeps separable data finite."""
    z = np.column_stack([np.ones(len(x)), np.log1p(x)])
    w = np.zeros(z.shape[1])
    for _ in range(25):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        w += np.linalg.solve(hess, z.T @ (y - p) - ridge * w)
    return tuple(float(v) for v in w)


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column, columns: dict[str, Column], sample: int, seed: str) -> DataFrame:
    """text and label columns of at most about `sample` labelled documents, chosen by a hash of the id."""
    known = labels.where(F.col("doc_id").isNotNull() & usable).groupBy("doc_id").agg(*[F.max(c).alias(n) for n, c in columns.items()])
    share = sample / max(sample, known.count())
    # at most about `sample` ids: a bounded table, so it is broadcast and no text is shuffled
    known = F.broadcast(known.where(hashed_unit(F.col("doc_id"), seed) < share))
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(known, "doc_id")


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lexicon: int = LEXICON, seed: str = "toxic-1") -> Grammar:
    known = labelled_sample(docs, labels, F.col("toxic").isin(0, 1), {"toxic": F.col("toxic").cast("int")}, sample, seed)
    known = known.select("text", "toxic")
    counts = known.mapInArrow(_count, "feature string, toxic long, other long").groupBy("feature")
    counts = counts.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    pure = counts.where((F.col("toxic") >= LEAST_DOCS) & (F.col("toxic") >= PURITY * (F.col("toxic") + F.col("other"))))
    found = pure.orderBy(F.desc("toxic"), "feature").limit(lexicon).collect()
    weight = {r.feature: math.log((r.toxic + 0.5) / (r.other + 0.5)) for r in found}
    stems: dict[str, float] = {}
    for f in sorted((f for f in weight if f[0] == "s"), key=lambda f: (len(f), f)):
        if not any(f[1:1 + k] in stems for k in STEMS):
            stems[f[1:]] = weight[f]
    words = {f[1:]: v for f, v in weight.items() if f[0] == "w" and not any(f[1:1 + k] in stems for k in STEMS if len(f) - 1 > k)}
    grammar = Grammar(words, stems)
    seen = known.mapInArrow(_evidence(grammar), "toxic int, total double, per_clause double").toPandas()
    if seen["toxic"].nunique() < 2:
        return grammar
    curve = fit_curve(seen[["total", "per_clause"]].to_numpy(), seen["toxic"].to_numpy(float))
    return Grammar(words, stems, curve)


def _score(grammar: Grammar):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = grammar.automaton()
        for batch in slices(batches):
            found = [grammar.evidence(t, automaton) for t in batch.column("text").to_pylist()]
            yield batch_of({
                "doc_id": (pa.int64(), batch.column("doc_id")), "score": (pa.float64(), [grammar.score(*f) for f in found]),
                "evidence": (pa.float64(), [f[0] for f in found]),
            })

    return run


def score_toxicity(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id, score, evidence of every document."""
    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return ready.mapInArrow(_score(grammar), "doc_id long, score double, evidence double")


def keep_clean(docs: DataFrame, grammar: Grammar, cut: float = CUT) -> DataFrame:
    """The documents that score under `cut`, with all their columns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = grammar.automaton()
        for batch in slices(batches):
            low = [grammar.score(*grammar.evidence(t, automaton)) < cut for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(low, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(key: str = "doc_id") -> Column:
    return crc_mod(key, 4) == 2
