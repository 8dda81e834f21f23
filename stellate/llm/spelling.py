"""Operator 13: spelling variants by a bit-sliced position index.

A word is near another if one letter inserted, deleted or replaced turns one
into the other. The vocabulary is indexed in blocks: for every position and
letter a bitset says which words of the block have that letter there. A query
word is read letter by letter with a few word-parallel steps that track, for
all words of the block at once, those equal so far and those with one error
so far, at shifted positions (-1: a letter of the query is extra, 0: a letter
is replaced, 1: a letter of the block's word is extra).

A block need not meet every query: with one error the shorter word's first
or last half is intact, so only words that share such a half (of the class of
their length) come together. Halves are hashed to buckets of about
``block_words``; a bucket that a common half overfills is cut by a hash of
its words and its parts meet in pairs of parts. No pair of words is lost, no
group is held whole.

Defined cases: NULL and empty texts have no words; a NULL id is written as
the empty string; ``<doc_id>:<run>`` is hashed for every run, so repeated
rows count again; words may have any length; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import SQL_CRC_TABLE, bounded, materialise, sql_crc32

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, min_length: int = 7, min_count: int = 2, drop_every: int = 31) -> DataFrame:
    """(word, n): lower-cased runs of letters, one code point of them deleted
    where ``drop_every`` divides the hash of id and run."""
    d = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                    F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    # one shorter than the least length can never become a word
    d = d.where(F.length("run") >= min_length).select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    d = d.select(F.when(F.pmod("h", F.lit(drop_every)) == 0, cut).otherwise(F.col("run")).alias("word"))
    return d.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _entries(words: DataFrame, block_words: int) -> DataFrame:
    """(class, bucket, i, j, part, word): every word in the tiles of its buckets."""
    w = words.select("word", F.length("word").alias("len"))
    # class: length of the shorter word of a pair; halves are those of that length
    w = w.select("word", F.explode(F.array(F.col("len"), F.col("len") - 1)).alias("class")).where("class > 0")
    half = F.expr("class div 2").cast("int")
    first, last = F.col("word").substr(F.lit(1), half), F.expr("right(word, class - class div 2)")
    w = w.select("word", "class", F.explode(F.array(F.xxhash64(F.lit(0), first), F.xxhash64(F.lit(1), last))).alias("half"))
    # halves that one word alone has lead to no pair
    sizes = w.groupBy("class", "half").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    classes = sizes.groupBy("class").agg(F.ceil(F.sum("k") / F.lit(block_words)).cast("int").alias("buckets"))
    sizes = materialise(sizes.join(F.broadcast(classes), "class").select(
        "class", "half", "k", F.pmod(F.xxhash64(F.col("half"), F.lit(7)), F.col("buckets")).cast("int").alias("bucket")), "halves")
    cuts = sizes.groupBy("class", "bucket").agg(F.greatest(F.lit(1), F.round(F.sum("k") / F.lit(block_words))).cast("int").alias("parts"))
    sizes = sizes.join(bounded(cuts, "buckets"), ["class", "bucket"]).select("class", "half", "bucket", "parts")
    w = w.join(sizes, ["class", "half"]).select("class", "bucket", "parts", "word").distinct()
    w = w.select("*", F.pmod(F.xxhash64("word", F.lit(3)), F.col("parts")).cast("int").alias("part"))
    w = w.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    return w.select("class", "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "word")


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points as a matrix, 0 beyond a word's end, and the lengths."""
    lengths = np.array([len(w) for w in words], np.int64)
    out = np.zeros((len(words), int(lengths.max(initial=0)) + 2), np.uint32)
    for k, w in enumerate(words):
        out[k, :len(w)] = np.frombuffer(w.encode("utf-32-le"), np.uint32)
    return out, lengths


def _bitset(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words."""
    bits = np.packbits(flags, axis=-1, bitorder="little")
    pad = -bits.shape[-1] % 8
    return np.pad(bits, [(0, 0)] * (bits.ndim - 1) + [(0, pad)]).view(np.uint64)


def near_pairs(block: list[str], queries: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (query, word of the block) exactly one letter apart."""
    letters, lengths = _letters(block)
    text, size = _letters(queries)
    order = np.argsort(-size, kind="stable")  # a query that has ended leaves the tail of the arrays
    text, size = text[order], size[order]
    none = np.zeros((len(block) + 63) // 64, np.uint64)

    def at(position: int, wanted: np.ndarray) -> np.ndarray:
        """For each wanted letter the set of words with it at the position."""
        if not 0 <= position < letters.shape[1]:
            return np.broadcast_to(none, (len(wanted), len(none)))
        found, which = np.unique(wanted, return_inverse=True)
        return _bitset(letters[:, position][None, :] == found[:, None])[which]

    ends = {n: _bitset((lengths == n)[None, :])[0] for n in np.unique(lengths)}
    equal = np.broadcast_to(_bitset(np.ones((1, len(block)), bool)), (len(queries), len(none))).copy()
    replaced, extra, missing = (np.zeros_like(equal) for _ in range(3))
    for i in range(int(size.max(initial=0)) + 1):
        done = int(np.searchsorted(-size, -i, side="left"))  # the first query of length i: all before are longer
        stop = int(np.searchsorted(-size, -i, side="right"))
        if stop > done:
            rest = slice(done, stop)
            hits = ((replaced[rest] & ends.get(i, none)) | ((extra[rest] | equal[rest]) & ends.get(i + 1, none))
                    | (missing[rest] & ends.get(i - 1, none)))
            q, k = np.nonzero(hits)
            if len(q):
                bits = np.unpackbits(hits[q, k].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                row, bit = np.nonzero(bits)
                yield order[done + q[row]], 64 * k[row] + bit
        if not done:
            return
        equal, replaced, extra, missing = equal[:done], replaced[:done], extra[:done], missing[:done]
        wanted = text[:done, i]
        here, there = at(i, wanted), at(i + 1, wanted)
        extra = (extra | equal) & there  # the word's letter i, or one before it, is extra
        missing = (missing & at(i - 1, wanted)) | equal  # the query's letter i is extra
        replaced = (replaced & here) | (equal & ~here)
        equal = equal & here


def near_words(words: DataFrame, block_words: int = 2048) -> DataFrame:
    """(a, b), a < b: all pairs of words that are near, once each."""
    def tile(frame: pd.DataFrame) -> pd.DataFrame:
        i, j = frame.i.iloc[0], frame.j.iloc[0]
        block, queries = (frame.word[frame.part == p].tolist() for p in (i, j))
        found = [([queries[x] for x in q], [block[x] for x in w]) for q, w in near_pairs(block, queries)] if block and queries else []
        a, b = (pd.Series([x for f in found for x in f[k]], dtype=object) for k in (0, 1))
        keep = a < b if i == j else a != b
        a, b = a[keep], b[keep]
        return pd.DataFrame({"a": a.where(a < b, b), "b": b.where(a < b, a)})

    return _entries(words, block_words).groupBy("class", "bucket", "i", "j").applyInPandas(tile, "a string, b string").distinct()


def spelling_groups(docs: DataFrame, min_length: int = 7, min_count: int = 2, factor: int = 10, block_words: int = 2048) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word."""
    words = materialise(vocabulary(docs, min_length, min_count), "words")
    pairs = materialise(near_words(words, block_words), "near-words")
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # each word gathers its near words' counts, the largest first, ties by code points
    best = both.join(words.toDF("b", "nb"), "b").groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("nb")).alias("m"), F.col("b"))).alias("top"))
    known = words.join(best, words.word == best.a, "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("top.b").alias("b"), (-F.col("top.m")).alias("nb"))
    real = F.col("nb") >= factor * F.col("n")
    known = materialise(known.select("word", F.when(real, F.col("b")).alias("form"), "n", "n_near", F.when(real, F.col("nb")).alias("form_n")), "forms")
    # a form is at least `factor` times as frequent, so chains are short; each round doubles the steps taken
    steps = bounded(known.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        longer = bounded(steps.join(ahead, F.col("root") == F.col("_w"), "left").select(
            "word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), "roots")
        steps = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            break
    return known.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = rf"""
WITH RECURSIVE {SQL_CRC_TABLE},
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate("text", '{UPPER}', '{LOWER}'), '{RUN}')) AS run FROM documents),
o AS (SELECT id, run, count(*) AS n FROM r WHERE length(run) >= 7 GROUP BY ALL),
h AS (SELECT run, n, {sql_crc32("(id || ':' || run)")} AS h FROM o, crc_table),
w AS (SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, CAST(h % length(run) + 2 AS BIGINT), length(run)) ELSE run END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
-- words one letter shorter, by the place of the letter left out
x AS (SELECT word, i, substring(word, 1, i - 1) || substring(word, i + 1, length(word)) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (SELECT a.word AS a, b.word AS b FROM x a JOIN x b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
      UNION SELECT x.word, v.word FROM x JOIN v ON v.word = x.rest UNION SELECT v.word, x.word FROM x JOIN v ON v.word = x.rest),
g AS (SELECT p.a, count(*) AS n_near, min({{'m': -v.n, 'b': encode(p.b)}}) AS top FROM p JOIN v ON v.word = p.b GROUP BY 1),
f AS (SELECT v.word, v.n, coalesce(g.n_near, 0) AS n_near, CASE WHEN -g.top.m >= 10 * v.n THEN decode(g.top.b) END AS form,
             CASE WHEN -g.top.m >= 10 * v.n THEN -g.top.m END AS form_n FROM v LEFT JOIN g ON g.a = v.word),
s AS (SELECT word, word AS at FROM f UNION ALL SELECT s.word, f.form FROM s JOIN f ON f.word = s.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM f JOIN s ON s.word = f.word JOIN f e ON e.word = s.at AND e.form IS NULL
"""
