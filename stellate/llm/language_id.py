"""Operator 5: language identification.

Texts become TF-IDF vectors of hashed character n-grams (one to three
characters of lower-cased letters, words padded by blanks). A sparse
multinomial logistic regression is trained by follow-the-regularised-leader
(per-coordinate steps; the L1 part of the elastic net keeps weights at zero,
the L2 part shrinks them), then a temperature is fitted on a tenth of the
sample. Training sees about ``max_labelled`` distinct texts with a known
language, each language an equal share or all it has, so a rare language is
learned from a table of any size; document frequencies count all texts that
may be learned from. Every text is classified whole.

Defined cases: a NULL text or one without a letter is ``und`` with score 0;
rows without a language are not learned from; without any usable row every
text is ``und``; with one language all texts with letters get it. Ties go to
the language first by name. Other columns are ignored. One result row per
document row.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import held_out

_OTHER = re.compile(r"[\W\d_]+")
DIM = 1 << 15


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of a text's hashed n-grams; empty without letters."""
    kept = _OTHER.sub(" ", text.lower()).strip() if text else ""
    if not any(map(str.isalpha, kept)):  # figures such as a raised 2 are no letters
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    c = np.frombuffer(f" {kept} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    two = c[:-1] * np.uint64(0x1F123BB5) + c[1:]
    three = two[:-1] * np.uint64(0x1F123BB5) + c[2:]
    h = np.concatenate([c, two + np.uint64(1 << 40), three + np.uint64(1 << 50)]) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.bincount((h >> np.uint64(64 - 15)).astype(np.int64), minlength=DIM)
    at = np.flatnonzero(counts)
    return at, counts[at]


def _vector(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1 + np.log(counts)) * idf[at]
    return v / max(np.sqrt((v * v).sum()), 1e-12)


class FollowTheLeader:
    """Multinomial logistic regression by FTRL-proximal steps."""

    def __init__(self, classes: int, alpha=0.5, beta=1.0, l1=0.02, l2=0.1):
        self.z, self.n = np.zeros((classes, DIM)), np.zeros((classes, DIM))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        return np.where(np.abs(z) <= self.l1, 0.0,
                        -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = _softmax(w @ x)
        p[label] -= 1
        g = p[:, None] * x[None, :]
        n = self.n[:, at]
        self.z[:, at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[:, at] = n + g * g


def _softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp(m - m.max(axis=0))
    return e / e.sum(axis=0)


def train(docs: DataFrame, max_labelled: int = 3000, epochs: int = 3):
    """(languages, weights, idf, temperature), or None without usable rows."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                       & ~held_out(F.col("doc_id"), 4, 2))
    text = F.xxhash64("text", F.lit(9))
    sizes = sorted((r["n"], r["lang"]) for r in known.groupBy("lang").agg(F.approx_count_distinct(text, 0.02).alias("n")).collect())  # one row a language
    share, left = {}, max_labelled
    for i, (n, lang) in enumerate(sizes):  # those with fewer texts give all of them
        take = min(n, left // (len(sizes) - i))
        share[lang], left = take / max(1, n), left - take
    if not share:
        return None
    # a hash of the text picks each language's share; repeated texts come once
    limit = F.create_map(*[F.lit(x) for lang, s in share.items() for x in (lang, int(s * (1 << 30)) + 1)])
    picked = known.where(F.pmod(text, F.lit(1 << 30)) < F.element_at(limit, F.col("lang"))).select("lang", "text", text.alias("_h")).dropDuplicates(["lang", "_h"])

    def make(batches):
        for batch in batches:
            found = [ngrams(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([a.astype("<i4").tobytes() for a, _ in found], pa.binary()),
                                              pa.array([c.astype("<i4").tobytes() for _, c in found], pa.binary())], names=["lang", "at", "n"])

    def frequencies(batches):
        held = np.zeros(DIM, np.int64)
        for batch in batches:
            for t in batch.column("text").to_pylist():
                held[ngrams(t)[0]] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held[at], pa.int64())], names=["at", "n"])

    rows = picked.select("lang", "text").mapInArrow(make, "lang string, at binary, n binary").collect()  # bounded, sparse
    rows = sorted((r["lang"], bytes(r["at"]), bytes(r["n"])) for r in rows if r["at"])
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    order = np.random.default_rng(3).permutation(len(rows))
    data = [(np.frombuffer(rows[i][1], "<i4"), np.frombuffer(rows[i][2], "<i4"), languages.index(rows[i][0])) for i in order]
    df = np.zeros(DIM)
    for r in known.select("text").mapInArrow(frequencies, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect():  # DIM rows at most
        df[r["at"]] = r["n"]
    idf = np.log((1 + known.select("doc_id").count()) / (1 + df)) + 1
    rest = max(1, len(data) // 10)
    model = FollowTheLeader(len(languages))
    for _ in range(epochs):
        for at, n, label in data[rest:] or data:
            model.learn(at, _vector(at, n, idf), label)
    w = model.weights()
    margins = np.array([w[:, at] @ _vector(at, n, idf) for at, n, _ in data[:rest]])
    right = np.array([label for _, _, label in data[:rest]])
    losses = {t: -np.log(np.maximum(_softmax(margins.T / t)[right, np.arange(rest)], 1e-12)).mean() for t in np.geomspace(0.1, 10, 41)}
    return languages, w, idf, float(min(losses, key=losses.get))


def identify(docs: DataFrame, max_labelled: int = 3000) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = docs.sparkSession.sparkContext.broadcast(train(docs, max_labelled))

    def predict(batches):
        for batch in batches:
            names, scores = [], []
            for text in batch.column("text").to_pylist():
                at, n = ngrams(text)
                if not len(at) or model.value is None:
                    names.append("und")
                    scores.append(0.0)
                    continue
                languages, w, idf, temperature = model.value
                p = _softmax(w[:, at] @ _vector(at, n, idf) / temperature)
                best = int(p.argmax())
                names.append(languages[best])
                scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    out = docs.select("doc_id", "text").mapInArrow(predict, "doc_id bigint, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
