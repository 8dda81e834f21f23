"""Operator 10: benchmark decontamination with a positional inverted index.

The index is distributed by documents: each task turns its documents into
blocks of about ``block_words`` words, and a block holds its own term
dictionary and, per term, the delta-coded sorted positions of the term in
the block. A hot term or passage therefore never gathers in one place. The
blocks are written as a table and queried from there.

A query (a window of words) starts from the rarest of its terms in the block
at hand: the term's positions, less its offset in the window, are the
candidate starts, and each further posting list (again by rising length) is
intersected with them until none is left. A proximity query starts from its
rarest term too, and each further list must have a posting near a candidate.

Spark splits the benchmark into windows (or distinct words), removes
repetitions and packs them into numbered batches of bounded size, one row
each. Every batch is answered by one job over the index, whose rows are
appended to one table: plans and driver hold one batch at a time, whatever
the benchmark's size.

Defined cases: NULL and empty texts have no words, are hit by nothing and
appear in the result with zeros; repeated rows and NULL ids give one result
row each; items without words ask for nothing; an item with a NULL id hits
words but is not counted or listed; an empty benchmark hits nothing. Other
columns of the inputs are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import materialise, slices
from stellate.session import new_scratch_dir

#: Bytes of words as they are, A-Z as a-z, all others as blanks.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
              for b in range(256))
INDEX_SCHEMA = ("block string, doc_id array<bigint>, text_hash array<bigint>, n_words array<int>, "
                "terms binary, counts binary, deltas binary")
MATCH_SCHEMA = "block string, doc int, spans array<struct<s:int,e:int>>, items array<string>"
NEAR_SCHEMA = "block string, doc int, item_id string, start int, end int"
_MATCH_ARROW = pa.schema([("block", pa.string()), ("doc", pa.int32()), ("spans", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                          ("items", pa.list_(pa.string()))])
_NEAR_ARROW = pa.schema([("block", pa.string()), ("doc", pa.int32()), ("item_id", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def _pack(values: np.ndarray) -> bytes:
    """32-bit integers, byte planes apart, compressed."""
    planes = np.ascontiguousarray(values.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").reshape(-1)


def _block_row(name, ids, hashes, lengths, words) -> dict:
    codes, terms = pd.factorize(np.array(words, dtype=object)) if words else (np.zeros(0, np.int64), [])
    order = np.argsort(codes, kind="stable").astype(np.int32)
    counts = np.bincount(codes, minlength=len(terms)).astype(np.int32)
    deltas = np.diff(order, prepend=np.int32(0))
    firsts = np.cumsum(counts)[:-1] if len(counts) else counts
    deltas[firsts] = order[firsts]
    return {"block": name, "doc_id": ids, "text_hash": hashes, "n_words": lengths,
            "terms": zstandard.compress(b"\n".join(terms), 1), "counts": _pack(counts), "deltas": _pack(deltas)}


_INDEX_ARROW = pa.schema([("block", pa.string()), ("doc_id", pa.list_(pa.int64())), ("text_hash", pa.list_(pa.int64())),
                          ("n_words", pa.list_(pa.int32())), ("terms", pa.binary()), ("counts", pa.binary()),
                          ("deltas", pa.binary())])


def build_index(docs: DataFrame, block_words: int = 1_000_000) -> DataFrame:
    """Write the positional index of (doc_id, text); one row per block."""

    def index(batches):
        from pyspark import TaskContext

        part, k = TaskContext.get().partitionId(), 0
        ids, hashes, lengths, words = [], [], [], []

        def flush():
            return pa.RecordBatch.from_pylist([_block_row(f"{part}-{k}", ids, hashes, lengths, words)], _INDEX_ARROW)

        for batch in slices(batches):
            for i, h, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "text"))):
                own = words_of(text)
                if words and len(words) + len(own) > block_words or len(ids) >= 100_000:
                    yield flush()
                    k, ids, hashes, lengths, words = k + 1, [], [], [], []
                ids.append(i)
                hashes.append(h)
                lengths.append(len(own))
                words += own
        if ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return materialise(rows.mapInArrow(index, INDEX_SCHEMA), "postings", compression="none", **{"parquet.block.size": 16 << 20})


class _Block:
    """One block of the index, opened."""

    def __init__(self, row: dict):
        self.name = row["block"]
        self.lengths = np.array(row["n_words"], np.int64)
        self.ends = np.cumsum(self.lengths)
        terms = zstandard.decompress(row["terms"])
        self.ids = {t: k for k, t in enumerate(terms.split(b"\n"))} if terms else {}
        self.counts = _unpack(row["counts"])
        self.firsts = np.concatenate(([0], np.cumsum(self.counts))).astype(np.int64)
        self.deltas = _unpack(row["deltas"])

    def lookup(self, vocabulary: list[bytes]) -> np.ndarray:
        return np.array([self.ids.get(t, -1) for t in vocabulary], np.int64)

    def positions(self, term: int) -> np.ndarray:
        return np.cumsum(self.deltas[self.firsts[term]:self.firsts[term + 1]], dtype=np.int64)

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, "right")


def _phrase(terms: np.ndarray, sizes: np.ndarray, postings) -> np.ndarray:
    """Starts of a phrase: offset-adjusted lists intersected from the rarest term."""
    order = np.argsort(sizes, kind="stable")
    starts = postings(terms[order[0]]) - order[0]
    for k in order[1:]:
        other, at = postings(terms[k]), starts + k
        i = np.searchsorted(other, at)
        i[i == len(other)] = 0
        starts = starts[other[i] == at]
        if not len(starts):
            break
    return starts


def _packed(rows: DataFrame, batch_rows: int, tag: str) -> tuple[DataFrame, int]:
    """The rows (key binary, items array<string>) dealt by a hash of the key to
    batches of about ``batch_rows``, each one row of term numbers by length:
    (batch, payload); and the number of batches."""

    def pack(found: pd.DataFrame) -> pd.DataFrame:
        vocabulary: dict[bytes, int] = {}
        groups: dict[int, tuple[list, list]] = {}
        for key, items in zip(found["key"], found["items"]):
            ids = [vocabulary.setdefault(w, len(vocabulary)) for w in bytes(key).split()]
            of_length = groups.setdefault(len(ids), ([], []))
            of_length[0].append(ids)
            of_length[1].append(sorted(items))
        data = list(vocabulary), [(n, np.array(w, np.int64), own) for n, (w, own) in groups.items()]
        return pd.DataFrame({"batch": [found["batch"].iloc[0]], "payload": [zstandard.compress(pickle.dumps(data), 1)]})

    rows = materialise(rows, tag)
    batches = -(-rows.count() // batch_rows)
    if not batches:
        return rows.select(F.lit(0).alias("batch"), F.col("key").alias("payload")), 0
    dealt = rows.withColumn("batch", F.pmod(F.xxhash64("key"), F.lit(batches)).cast("int"))
    return materialise(dealt.groupBy("batch").applyInPandas(pack, "batch int, payload binary"), tag + "-batches"), batches


def _item_rows(items: DataFrame, keys_of) -> DataFrame:
    """(key, items): the distinct keys that ``keys_of(words)`` yields, words
    joined by blanks, with the items (NULL ids left out) that have each."""

    def split(batches):
        for batch in slices(batches):
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                if words := words_of(text):
                    keys = list(dict.fromkeys(b" ".join(k) for k in keys_of(words)))
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([item] * len(keys), pa.string())], names=["key", "item"])

    rows = items.select(F.col("item_id").cast("string").alias("item"), "text").distinct().mapInArrow(split, "key binary, item string")
    return rows.groupBy("key").agg(F.collect_set("item").alias("items"))


def _answers(index: DataFrame, packed: tuple[DataFrame, int], answer, schema: str, fields: pa.Schema, tag: str) -> DataFrame:
    """What ``answer(block, vocabulary, groups)`` yields (as dicts) for every
    block of the index and batch: one job a batch, appended to one table."""
    batches, n = packed
    spark = index.sparkSession
    path = new_scratch_dir(spark, tag)
    spark.createDataFrame([], schema).write.parquet(path)
    for k in range(n):
        for row in batches.where(F.col("batch") == k).collect():  # one row of bounded size, or none
            query = spark.sparkContext.broadcast(bytes(row["payload"]))

            def probe(rows, query=query):
                vocabulary, groups = pickle.loads(zstandard.decompress(query.value))
                for batch in rows:
                    for block in batch.to_pylist():
                        if out := list(answer(_Block(block), vocabulary, groups)):
                            yield pa.RecordBatch.from_pylist(out, fields)

            found = index.select("block", "n_words", "terms", "counts", "deltas").mapInArrow(probe, schema)
            found.write.mode("append").parquet(path)
            query.unpersist()
    return spark.read.schema(schema).parquet(path)


class _Postings:
    """The posting lists of a batch's terms in a block, each opened once."""

    def __init__(self, block: _Block, vocabulary: list[bytes]):
        self.block, self.ids, self.opened = block, block.lookup(vocabulary), {}
        self.sizes = np.where(self.ids >= 0, block.counts[self.ids] if len(block.counts) else 0, 0)

    def __call__(self, term: int) -> np.ndarray:
        if term not in self.opened:
            self.opened[term] = self.block.positions(self.ids[term])
        return self.opened[term]


def _phrases(block: _Block, vocabulary: list[bytes], groups: list):
    """Merged spans and items of the documents in which windows occur."""
    postings, hits = _Postings(block, vocabulary), {}
    for n, windows, items in groups:
        size_of = postings.sizes[windows]
        for w in np.flatnonzero(size_of.min(axis=1) > 0):
            starts = _phrase(windows[w], size_of[w], postings)
            if len(starts):
                docs = block.doc_of(starts)
                inside = starts + n <= block.ends[docs]
                for d, s in zip(docs[inside].tolist(), starts[inside].tolist()):
                    hits.setdefault(d, []).append((s, s + n, items[w]))
    for d, found in hits.items():
        first, spans = int(block.ends[d] - block.lengths[d]), []
        for s, e, _ in sorted(found, key=lambda x: x[:2]):
            if spans and s - first <= spans[-1]["e"]:
                spans[-1]["e"] = max(spans[-1]["e"], e - first)
            else:
                spans.append({"s": s - first, "e": e - first})
        yield {"block": block.name, "doc": d, "spans": spans, "items": sorted({i for _, _, own in found for i in own})}


def phrase_matches(index: DataFrame, items: DataFrame, size: int = 13, batch_windows: int = 200_000) -> DataFrame:
    """(block, doc, spans, items): where windows of ``size`` words of the
    items occur, per document of the index (its place in the block)."""
    windows = _item_rows(items, lambda words: (words[s:s + size] for s in range(max(1, len(words) - size + 1))))
    packed = _packed(windows, batch_windows, "windows")
    out = _answers(index, packed, _phrases, MATCH_SCHEMA, _MATCH_ARROW, "phrases")
    return out if packed[1] < 2 else out.groupBy("block", "doc").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))


def _span_words(spans: Column) -> Column:
    """Words in the union of sorted spans."""
    step = lambda a, x: F.struct(F.greatest(a["e"], x["e"]).alias("e"),
                                 (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(a["e"], x["s"]))).alias("n"))
    return F.aggregate(spans, F.struct(F.lit(0).alias("e"), F.lit(0).alias("n")), step, lambda a: a["n"])


def indexed_documents(index: DataFrame) -> DataFrame:
    """(block, doc, doc_id, text_hash, n_words) of every document of the index."""
    rows = index.select("block", F.posexplode(F.arrays_zip("doc_id", "text_hash", "n_words")).alias("doc", "d"))
    return rows.select("block", "doc", "d.doc_id", "d.text_hash", F.col("d.n_words").cast("long").alias("n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, share: int = 20,
                  block_words: int = 1_000_000, slop: int | None = None) -> DataFrame:
    """One row per document: words, words inside any occurrence of a window,
    items found, and whether ``share`` times the hit words reach the words;
    with a ``slop``, also the number of items (with an id) that have a
    proximity match in the document (n_near)."""
    index = build_index(docs, block_words)
    found = phrase_matches(index, benchmark, size).select(
        "block", "doc", _span_words(F.col("spans")).cast("long").alias("hit"), F.array_sort("items").alias("items"))
    hit, items = F.coalesce(F.col("hit"), F.lit(0).cast("long")), F.coalesce(F.col("items"), F.array().cast("array<string>"))
    rows, near = indexed_documents(index).join(found, ["block", "doc"], "left"), []
    if slop is not None:
        matches = proximity_matches(index, benchmark, slop).groupBy("block", "doc").agg(F.count_distinct("item_id").alias("near"))
        rows, near = rows.join(matches, ["block", "doc"], "left"), [F.coalesce(F.col("near"), F.lit(0).cast("long")).alias("n_near")]
    return rows.select(
        "doc_id", "text_hash", "n_words", hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"),
        ((hit > 0) & (share * hit >= F.col("n_words"))).alias("contaminated"), *near, items.alias("items"))


def _near(postings: _Postings, terms: np.ndarray, most: int) -> list[tuple[int, int]]:
    """The shortest stretches of at most ``most`` words that hold all the terms."""
    lists = [postings(t) for t in terms[np.argsort(postings.sizes[terms], kind="stable")]]
    starts = lists[0]
    for p in lists[1:]:  # places of the rarest term that have all others near
        i = np.searchsorted(p, starts)
        left, right = np.abs(p[np.clip(i - 1, 0, None)] - starts), np.abs(p[np.clip(i, None, len(p) - 1)] - starts)
        starts = starts[np.minimum(left, right) < most]
        if not len(starts):
            return []
    at, who = [], []
    for k, p in enumerate(lists):
        if len(starts) * 32 < len(p):  # a few stretches of a long list
            a, b = np.searchsorted(p, starts - most + 1), np.searchsorted(p, starts + most)
            p = p[np.unique(np.concatenate([np.arange(x, y) for x, y in zip(a, b)]))]
        at.append(p)
        who.append(np.full(len(p), k))
    at, who = np.concatenate(at), np.concatenate(who)
    order = np.argsort(at, kind="stable")
    last, spans = [-1] * len(lists), []
    for p, k in zip(at[order].tolist(), who[order].tolist()):
        last[k] = p
        s = min(last)
        if s >= 0 and p - s < most and not (spans and spans[-1][0] == s):
            spans.append((s, p + 1))
    return spans


def proximity_matches(index: DataFrame, items: DataFrame, slop: int = 5, batch_items: int = 10_000) -> DataFrame:
    """(block, doc, item_id, start, end): the shortest stretches, of at most
    the number of the item's distinct words plus ``slop`` words, that hold
    all its words in any order (no stretch inside another). An item without
    words or with a NULL id matches nothing."""

    def near(block, vocabulary, groups):
        postings = _Postings(block, vocabulary)
        for n, sets, own in groups:
            for w in np.flatnonzero(postings.sizes[sets].min(axis=1) > 0):
                for s, e in _near(postings, sets[w], n + slop):
                    d = int(block.doc_of(np.array([s]))[0])
                    if e <= block.ends[d]:
                        first = int(block.ends[d] - block.lengths[d])
                        for item in own[w]:
                            yield {"block": block.name, "doc": d, "item_id": item, "start": s - first, "end": e - first}

    packed = _packed(_item_rows(items, lambda words: [sorted(set(words))]), batch_items, "word-sets")
    return _answers(index, packed, near, NEAR_SCHEMA, _NEAR_ARROW, "proximity")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
        list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT row_number() OVER () AS bid, item_id,
        list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i:i + 12], ' ') AS g
        FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
pos AS (SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g
        FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win))),
m AS (SELECT rid, item_id, i, n FROM pos JOIN win USING (n, g)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM m) GROUP BY rid),
sets AS (SELECT bid, item_id, unnest(list_distinct(ws)) AS w, len(list_distinct(ws)) AS nd FROM b WHERE item_id IS NOT NULL),
ids AS (SELECT bid, item_id, nd, list(DISTINCT w) AS own FROM sets GROUP BY ALL),
cand AS (SELECT rid, bid, item_id, nd, own, ws FROM (SELECT rid, ws, list_distinct(ws) AS dw FROM d) JOIN ids ON list_has_all(dw, own)),
places AS (SELECT rid, bid, item_id, nd, i, ws[i] AS w FROM (SELECT rid, bid, item_id, nd, own, ws, unnest(range(1, len(ws) + 1)) AS i FROM cand)
           WHERE list_contains(own, ws[i])),
near AS (SELECT rid, count(DISTINCT item_id) AS n_near FROM (SELECT p.rid, p.item_id FROM places p JOIN places q
             ON p.rid = q.rid AND p.bid = q.bid AND q.i >= p.i AND q.i < p.i + p.nd + 5
           GROUP BY p.rid, p.bid, p.item_id, p.i, p.nd HAVING count(DISTINCT q.w) = p.nd) GROUP BY rid),
own AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM m) WHERE s IS NOT NULL GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated,
       CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM d LEFT JOIN hit USING (rid) LEFT JOIN own USING (rid) LEFT JOIN near USING (rid)
"""
