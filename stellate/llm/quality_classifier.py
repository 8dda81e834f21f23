"""Operator 3: quality by positive-unlabelled learning.

Trusted positives are labelled texts of quality 1; the other side is
unlabelled text of the corpus, good and bad. The class prior is estimated by
comparing how much of both samples a positive-versus-unlabelled score puts in
its top (the smallest ratio with a confidence margin), and the scorer then
minimises the non-negative unbiased risk

    prior * E+[l(g)] + max(0, Eu[l(-g)] - prior * E+[l(-g)])

by gradient steps; where the bracket falls below zero the step undoes it.
Both samples are bounded by documented parameters; every text is scored whole.

Defined cases: NULL and empty texts have the features of an empty text;
without trusted positives every text is kept with score 0.5; NULL and
conflicting labels: only rows that say 1 are trusted. Other columns are
ignored. One result row per document row.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import held_out, labelled_sample, slices

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = b"#*$%&|<>=+~^_{}[]\\/@"
_MARKS = b"!?"
_POINTS = b".,;:'\"()-"


def features(text: str | None) -> list[float]:
    """Shares and lengths of the whole text, none of them tied to a language."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    size = max(1, len(data))
    words = data.split()
    n = max(1, len(words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    share = lambda chars: (len(data) - len(data.translate(None, chars))) / size
    letters = len(data) - len(data.translate(None, bytes(range(65, 91)) + bytes(range(97, 123))))
    distinct = len(set(words))
    # distinct words as a share of what a text of this length usually has
    rich = distinct / (n ** 0.85)
    pairs = len(set(zip(words, words[1:])))
    packed = len(zlib.compress(data, 1)) / (size + 20)
    sizes = sorted(map(len, words)) or [0]
    return [math.log1p(len(words)), math.sqrt(share(_SYMBOLS)), math.sqrt((len(data) - len(data.translate(None, _UPPER))) / max(1, letters)),
            math.sqrt(share(_DIGITS)), math.sqrt(share(_MARKS)), math.sqrt(share(_POINTS)), rich, pairs / max(1, n - 1),
            packed, 1 - len(set(lines)) / max(1, len(lines)), math.log1p(n / max(1, len(lines))), sizes[len(sizes) // 2] / 10,
            math.log1p(sizes[-1]), sum(sizes) / n / 10, letters / size]


class Scorer:
    """Standardised features, their squares and a logistic layer."""

    def __init__(self, x: np.ndarray):
        self.mean, self.sd = x.mean(axis=0), x.std(axis=0) + 1e-6
        self.w = np.zeros(2 * x.shape[1] + 1)

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.sd, -6, 6)
        return np.column_stack([z, z * z / 6, np.ones(len(z))])

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.w


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(w, gradient, steps: int, rate: float):
    """Adam."""
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def class_prior(pos: np.ndarray, unl: np.ndarray, delta: float = 0.1) -> float:
    """The least share of unlabelled over positive scores above a threshold,
    among thresholds weighed with a margin for small samples."""
    pos, unl = np.sort(pos), np.sort(unl)
    cuts = np.quantile(pos, np.linspace(0, 0.95, 96))
    above_p = 1 - np.searchsorted(pos, cuts, "left") / len(pos)
    above_u = 1 - np.searchsorted(unl, cuts, "left") / len(unl)
    margin = math.sqrt(math.log(4 / delta) / 2) * (1 / math.sqrt(len(pos)) + 1 / math.sqrt(len(unl)))
    best = np.argmin((above_u + margin) / np.maximum(above_p, 1e-9))
    return float(np.clip(above_u[best] / max(above_p[best], 1e-9), 0.05, 0.98))


def non_negative_fit(pos: np.ndarray, unl: np.ndarray, penalty: float = 1e-3, steps: int = 600) -> tuple[Scorer, float]:
    """The scorer and the estimated prior."""
    scorer = Scorer(np.concatenate([pos, unl]))
    p, u = scorer.expand(pos), scorer.expand(unl)

    def plain(w, p, u):  # positives against unlabelled
        return -(p * (1 - _sigmoid(p @ w))[:, None]).mean(axis=0) + (u * _sigmoid(u @ w)[:, None]).mean(axis=0) + penalty * w

    half = (len(p) // 2, len(u) // 2)
    first = _descend(scorer.w, lambda w: plain(w, p[:half[0]], u[:half[1]]), 300, 0.05)
    prior = class_prior(p[half[0]:] @ first, u[half[1]:] @ first) if min(half) >= 10 else 0.8

    def risk(w):
        sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
        up = -prior * (p * (1 - sp)[:, None]).mean(axis=0)
        bracket = np.log1p(np.exp(np.clip(u @ w, -30, 30))).mean() - prior * np.log1p(np.exp(np.clip(p @ w, -30, 30))).mean()
        down = (u * su[:, None]).mean(axis=0) - prior * (p * sp[:, None]).mean(axis=0)
        return (up + down if bracket >= 0 else -down) + penalty * w

    scorer.w = _descend(scorer.w, risk, steps, 0.05)
    return scorer, prior


def _feature_rows(rows: DataFrame) -> np.ndarray:
    def make(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([features(t) for t in batch.column("text").to_pylist()], pa.list_(pa.float64()))], names=["x"])

    found = rows.select("text").mapInArrow(make, "x array<double>").collect()  # a bounded sample's short rows
    return np.array(sorted(tuple(r["x"]) for r in found))


def train(docs: DataFrame, labels: DataFrame, max_trusted: int = 8000, max_unlabelled: int = 8000) -> Scorer | None:
    """``max_unlabelled`` is met in the mean: a hash of id and text picks the
    share, and if a repeated row brings in too many, a second draw by row."""
    spark = docs.sparkSession
    trusted = labelled_sample(spark, docs, labels.where("quality = 1"), "quality", 3, 1, max_trusted)
    share = min(1.0, max_unlabelled / max(1, docs.count()))
    web = docs.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(3)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    drawn = web.count()
    if drawn > 2 * max_unlabelled:
        web = web.where(F.rand(3) < max_unlabelled / drawn)
    pos, unl = _feature_rows(trusted), _feature_rows(web)
    if not len(pos) or not len(unl):
        return None
    shuffled = np.random.default_rng(5)
    return non_negative_fit(shuffled.permutation(pos), shuffled.permutation(unl))[0]


def scored(docs: DataFrame, model: Scorer | None) -> DataFrame:
    """Every column of ``docs`` and ``_score``."""
    model = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", `_score` double"

    def rate(batches):
        for batch in slices(batches):
            x = [features(t) for t in batch.column("text").to_pylist()]
            s = _sigmoid(model.value.margin(np.array(x).reshape(len(x), -1))) if model.value and x else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], names=[*batch.schema.names, "_score"])

    return docs.mapInArrow(rate, schema)


def quality(docs: DataFrame, labels: DataFrame, max_trusted: int = 8000, max_unlabelled: int = 8000) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = scored(docs, train(docs, labels, max_trusted, max_unlabelled))
    return out.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), F.col("_score").alias("score"),
                      (F.col("_score") >= 0.5).cast("int").alias("predicted"))
