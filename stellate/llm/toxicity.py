"""Operator 1: toxicity by a weighted finite-state pattern grammar.

Five transducers read the words of a clause as symbols (insult, threat,
target, negation, report, intent, or none): ``INSULT`` and ``THREAT`` emit
weights, ``NEGATION`` and ``REPORT`` scale what is emitted while their state
lasts, and ``TARGET`` weighs the clause by its final state, so a target
counts before and after the word. ``composed`` is their composition, on the
product of their states. Clauses are scored, not words: every feature of a
text is made of the weights that its matched clauses emit, and no feature's
coefficient is negative, so negated and reported forms never score higher.

The weights of insult arcs (whole words, and stems of four to eight letters
that stand for all their endings) and of threat arcs (words within reach of
a word of intent) are learned from labelled texts: terms far more frequent
in toxic ones by a likelihood-ratio test, weighted by log odds. Short fixed
lists add arcs: by their log odds too where texts have them, else by the
median of the list. All terms that pass are kept. A logistic layer on the
features gives the document's score. Training sees at most ``max_labelled``
rows, which bounds the arcs too.

Defined cases: NULL, empty and letterless texts score as a text without any
match; repeated and conflicting labels all count; NULL labels do not; without
any usable label the fixed lists and fixed coefficients are used. Other
columns are ignored. One result row per document row.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import held_out, labelled_sample, materialise, slices

WORD = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[^.!?;\n]+")
#: The prior lexicon.
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "fool", "imbecile",
           "idiota", "estúpido", "imbécil", "basura", "crétin", "ordure", "minable", "dummkopf", "abschaum", "trottel")
THREATS = ("kill", "destroy", "hurt", "burn", "beat", "crush", "matar", "tuer", "töten")
INTENTS = ("will", "ll", "shall", "going", "gonna", "should", "must", "werde", "werden", "sollte", "vais", "allons", "voy", "vamos", "debe")
TARGETS = ("you", "your", "yours", "he", "she", "they", "them", "him", "her", "people", "tu", "vous", "du", "ihr", "sie", "usted", "ustedes")
NEGATIONS = ("not", "no", "never", "nobody", "without", "nicht", "kein", "nie", "pas", "jamais", "nunca", "sin")
REPORTS = ("said", "says", "wrote", "quoted", "called", "sagte", "dit", "dijo", "reported", "claimed")
_CLASSES = {**dict.fromkeys(TARGETS, "target"), **dict.fromkeys(NEGATIONS, "negation"), **dict.fromkeys(REPORTS, "report"),
            **dict.fromkeys(INTENTS, "intent")}
_STEMS = range(4, 9)
#: Words that a negation or a word of intent reaches.
REACH = 3
#: Weight of the fixed arcs.
PRIOR = 2.0


class Transducer:
    """Arcs (state, symbol) -> (state, factor); a missing arc is that of
    (state, None), or else stays, with factor 1. ``final`` weighs a whole
    clause's emissions of a symbol by the state it ends in."""

    def __init__(self, arcs: dict, final: dict | None = None):
        self.arcs, self.final = arcs, final or {}

    def step(self, state: int, symbol: str | None) -> tuple[int, float]:
        return self.arcs.get((state, symbol)) or self.arcs.get((state, None)) or (state, 1.0)

    def end(self, state: int, symbol: str) -> float:
        return self.final.get((state, symbol), 1.0)


#: An insult right after an insult emits a quarter more.
INSULT = Transducer({(0, "insult"): (1, 1.0), (1, "insult"): (1, 1.25), (1, None): (0, 1.0)})
#: A threat emits whole within reach of a word of intent, else three tenths.
THREAT = Transducer({**{(s, "intent"): (REACH, 1.0) for s in range(REACH + 1)}, **{(s, None): (s - 1, 1.0) for s in range(1, REACH + 1)},
                     (0, "threat"): (0, 0.3)})
#: Words within reach of a negation emit a quarter.
NEGATION = Transducer({**{(s, "negation"): (REACH, 1.0) for s in range(REACH + 1)}, **{(s, None): (s - 1, 0.25) for s in range(1, REACH + 1)}})
#: What follows a word of reporting in the clause emits half.
REPORT = Transducer({(0, "report"): (1, 1.0), (1, None): (1, 0.5)})
#: With a target, insults count half as much again; a threat without one counts a fifth.
TARGET = Transducer({(0, "target"): (1, 1.0)}, {(1, "insult"): 1.5, (0, "threat"): 0.2})
MACHINES = (INSULT, THREAT, NEGATION, REPORT, TARGET)
_START = (0,) * len(MACHINES)


@functools.cache
def composed(state: tuple[int, ...], symbol: str | None) -> tuple[tuple[int, ...], float]:
    """An arc of the composition: the next product state and the product of the factors."""
    steps = [m.step(s, symbol) for m, s in zip(MACHINES, state)]
    return tuple(s for s, _ in steps), math.prod(f for _, f in steps)


class Grammar:
    """The composed transducers with weights on their insult and threat arcs."""

    def __init__(self, exact: dict[str, float], stems: dict[str, float], threats: dict[str, float] | None = None):
        self.exact, self.stems, self.seen = exact, stems, {}
        self.threats = dict.fromkeys(THREATS, PRIOR) if threats is None else threats

    def arc(self, word: str) -> tuple[str | None, float]:
        """(symbol, weight) of a word; of several insult arcs the most specific."""
        found = self.seen.get(word)
        if found is None:
            if len(self.seen) > 300_000:
                self.seen.clear()
            if word in self.threats:
                found = "threat", self.threats[word]
            else:
                w = self.exact.get(word, 0.0) or next((self.stems[word[:k]] for k in reversed(_STEMS) if word[:k] in self.stems
                                                       and len(word) >= k), 0.0)
                found = ("insult", w) if w else (_CLASSES.get(word), 0.0)
            self.seen[word] = found
        return found

    def clause(self, words: list[str]) -> list[tuple[str, str, float, float]]:
        """(word, symbol, factor, weight) of what the clause emits."""
        state, out = _START, []
        for word in words:
            symbol, weight = self.arc(word)
            state, factor = composed(state, symbol)
            if weight:
                out.append((word, symbol, factor, weight))
        ends = {x: math.prod(m.end(s, x) for m, s in zip(MACHINES, state)) for x in ("insult", "threat")}
        return [(word, symbol, factor * ends[symbol], weight) for word, symbol, factor, weight in out]

    def matches(self, text: str | None):
        """(start, end, emissions) of the matched clauses of a text, in characters of its lower-case form."""
        low = (text or "").lower()
        if not any(self.arc(w)[1] for w in set(WORD.findall(low))):
            return
        for c in CLAUSE.finditer(low):
            if found := self.clause(WORD.findall(c[0])):
                yield c.start(), c.end(), found

    def features(self, text: str | None) -> list[float]:
        """Of the matched clauses: greatest score, sum of scores, weights and number of
        the matched words (each as strongly as any clause has it), greatest threat."""
        top = total = threat = 0.0
        kinds: dict[str, tuple[float, float]] = {}
        for _, _, found in self.matches(text):
            scores = {"insult": 0.0, "threat": 0.0}
            for word, symbol, factor, weight in found:
                scores[symbol] += factor * weight
                kinds[word] = max(kinds.get(word, (0.0, 0.0)), (factor, weight))
            score = sum(scores.values())
            top, total, threat = max(top, score), total + score, max(threat, scores["threat"])
        return [top, math.log1p(total), math.log1p(sum(f * w for f, w in kinds.values())), sum(f for f, _ in kinds.values()), threat]


#: Coefficients without labels, and what the fitted ones are drawn to; the intercept is last.
COEFFICIENTS = (0.5, 0.5, 0.5, 0.0, 0.5, -3.0)


def _terms(text: str | None) -> set[str]:
    """Words, stems (``abcd*``) and words within reach of one of intent (``>abcd``) of a text."""
    low = (text or "").lower()
    words = set(WORD.findall(low))
    terms = words | {w[:k] + "*" for w in words for k in _STEMS if len(w) >= k}
    if not words.isdisjoint(INTENTS):
        for c in CLAUSE.findall(low):
            own = WORD.findall(c)
            terms.update(">" + w for i, x in enumerate(own) if x in INTENTS for w in own[i + 1:i + 1 + REACH] if w not in _CLASSES)
    return terms


def _likelihood_ratio(pos: Column, neg: Column, n1: int, n0: int) -> Column:
    """Twice the log likelihood ratio of a term's shares in n1 and n0 texts."""
    def part(k, n):
        p = (pos + neg) / (n1 + n0)
        term = lambda x, y: F.when(x > 0, x * F.log(x / (n * y))).otherwise(0.0)
        return term(k, p) + term(n - k, 1 - p)

    return 2 * (part(pos, F.lit(n1)) + part(neg, F.lit(n0)))


def learn_grammar(rows: DataFrame, least_ratio: float = 16.0) -> Grammar:
    """Insult and threat arcs from the (text, label) rows of a bounded sample:
    terms are counted and tested by Spark, all that pass become arcs."""

    def count(batches):
        for batch in slices(batches):
            pos, neg = Counter(), Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                (pos if label else neg).update(_terms(text))
            terms = list(pos.keys() | neg.keys())
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([pos[t] for t in terms], pa.int64()),
                                              pa.array([neg[t] for t in terms], pa.int64())], names=["term", "pos", "neg"])

    sizes = dict(rows.groupBy("label").count().collect())
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    fixed = [*INSULTS, *(">" + w for w in THREATS)]
    weights = {}
    if n1 and n0:
        counts = rows.mapInArrow(count, "term string, pos bigint, neg bigint").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        pos, neg = F.col("pos"), F.col("neg")
        odds = F.log((pos + 0.5) / (n1 + 1)) - F.log((neg + 0.5) / (n0 + 1))
        telling = (pos >= 2) & (pos * n0 > 3 * neg * n1) & (_likelihood_ratio(pos, neg, n1, n0) >= least_ratio)
        found = counts.where(telling | F.col("term").isin(fixed)).select("term", F.greatest(odds, F.lit(0.0)), telling, pos)
        found = found.collect()  # of at most max_labelled texts
        told = {r[0]: r[3] for r in found}  # a stem whose texts are mostly those of one longer word is none
        explained = {w[:k] + "*" for w, n in told.items() for k in _STEMS if k < len(w) and w[-1] != "*" and 5 * n >= 4 * told.get(w[:k] + "*", 0)}
        weights = {r[0]: r[1] for r in found if r[0] not in explained}
        known = sorted(r[1] for r in found if r[0] in fixed and r[2])
    # a fixed arc that no text has weighs like the median of those that tell
    weights = {**dict.fromkeys(fixed, known[len(known) // 2] if weights and known else PRIOR), **weights}
    threats = {w: weights[">" + w] for w in THREATS}  # others are threats where intent tells more than the word
    threats.update((t[1:], w) for t, w in weights.items() if t[0] == ">" and w > weights.get(t[1:], 0.0))
    return Grammar({t: w for t, w in weights.items() if t[0] != ">" and t[-1] != "*"},
                   {t[:-1]: w for t, w in weights.items() if t[-1] == "*"}, threats)


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, penalty: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Coefficients, the intercept last, by Newton steps with an L2 penalty on
    the distance from ``prior``. A coefficient that would be negative is 0,
    and the others are fitted anew."""
    x = np.column_stack([x, np.ones(len(x))])
    free, w = np.ones(x.shape[1], bool), np.array(prior, float)
    while True:
        w = np.where(free, prior, 0.0)
        ridge = np.full(free.sum(), penalty * len(x) / 100 + 0.1)
        ridge[-1] = 1e-6
        own, drawn = x[:, free], np.asarray(prior, float)[free]
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(own @ w[free], -30, 30)))
            move = np.linalg.solve((own * (p * (1 - p))[:, None]).T @ own + np.diag(ridge), own.T @ (p - y) + ridge * (w[free] - drawn))
            w[free] -= np.clip(move, -5, 5)
            if np.abs(move).max() < 1e-8:
                break
        if (w[:-1] >= 0).all():
            return w
        free[:-1] &= w[:-1] >= 0


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 8000) -> tuple[Grammar, np.ndarray]:
    rows = materialise(labelled_sample(docs.sparkSession, docs, labels, "toxic", 5, 0, max_labelled).where("label IN (0, 1)")
                       .repartition(docs.sparkSession.sparkContext.defaultParallelism), "toxic-sample")
    grammar = learn_grammar(rows)

    def features(batches):
        for batch in slices(batches):
            data = [grammar.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(data, pa.list_(pa.float64())), batch.column("label")], names=["x", "label"])

    found = rows.mapInArrow(features, "x array<double>, label int").collect()  # at most max_labelled short rows
    y = np.array([r["label"] for r in found], float)
    if len(set(y)) < 2:
        return grammar, np.array(COEFFICIENTS)
    return grammar, fit_logistic(np.array([r["x"] for r in found]), y, np.array(COEFFICIENTS))


def score(docs: DataFrame, model: tuple[Grammar, np.ndarray]) -> DataFrame:
    """(doc_id, score) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches):
        grammar, w = model.value
        for batch in slices(batches):
            x = np.array([grammar.features(t) for t in batch.column("text").to_pylist()]).reshape(-1, len(w) - 1)
            p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rate, "doc_id bigint, score double")


def toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = 8000) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    out = score(docs, train(docs, labels, max_labelled))
    return out.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
