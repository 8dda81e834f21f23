"""Operator 7: Jaccard self-join on word n-grams, and its components.

A document's set holds 64-bit hashes of its distinct n-word shingles. Size
bands make tiles: two sets can only link (100 * both >= percent * either)
when their sizes differ by that ratio, so a set belongs to its band's tile
and to every tile below whose sets it can link with (from 77 percent on, one
at most, near the lower edge). In a tile at most D shingles
differ between linked sets; cutting the hash range into D + 1 + E buckets
leaves E + 1 buckets in which both sets agree, at least one of them not
empty unless a set has more than E empty buckets (it then offers those,
too). Sets that agree in a bucket are candidates; no link is lost.

Candidates are held against a parity bitmap: each differing shingle flips
one bit, so the count of differing bits bounds the overlap from above. What
passes is decided by intersecting the sorted arrays.

Groups of candidates are never expanded into all pairs. First every member
is compared with a central member of the group and links are joined into
components. Only groups that still hold several components are compared
further, in tiles of about ``tile_rows`` members a side, and only what is
outside the group's largest component, with one another and with that
component. Equal sets are one class from the start.

Bucket keys travel as arrays, one row per task and target, after links
within a batch of rows have been taken out, so a key that a third of all
documents share sends one entry per batch.

Defined cases: NULL, empty and blank texts have an empty set and link with
nothing; texts of fewer than n words have one shingle, the whole sequence;
repeated rows are linked with each other; a row with a NULL id is linked as
others, but never names a component (NULL if no row of it has an id); an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import bounded, materialise

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BITS = 1024  # of a bitmap, at least
BATCH_WORDS = 500_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list, n: int):
    """The sorted distinct shingle hashes of each text, in order."""
    words, ends = [], []
    for i, text in enumerate(texts):
        words += text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
        ends.append(len(words))
        if len(words) < BATCH_WORDS and i < len(texts) - 1:
            continue
        h = pd.util.hash_array(np.array([*words, b""], dtype=object))[:-1]
        full = h[:max(0, len(h) - n + 1)]
        for k in range(1, n):
            full = full * _A + h[k:k + len(full)]
        full, start = _mix(full), 0
        for end in ends:
            if end - start >= n:
                yield np.unique(full[start:end - n + 1])
            elif end > start:
                whole = np.full(1, end - start, np.uint64)
                for w in range(start, end):
                    whole = whole * _A + h[w:w + 1]
                yield _mix(whole)
            else:
                yield h[:0]
            start = end
        words, ends = [], []


class Bands:
    """Size bands and, per tile, the number of buckets and of empty ones allowed."""

    def __init__(self, percent: int, ratio: float = 1.3, largest: int = 1 << 40):
        self.percent, lows = percent, [1]
        while lows[-1] < largest:
            lows.append(max(lows[-1] + 1, int(lows[-1] * ratio)))
        self.lows = np.array(lows, np.int64)

    def tiles(self, size: int) -> list[tuple[int, int, int]]:
        """(tile, buckets, empty buckets allowed) of a set of this size."""
        own, out = int(np.searchsorted(self.lows, size, "right")) - 1, []
        for b in range(own, -1, -1):
            high = int(self.lows[b + 1]) - 1
            most = high * 100 // self.percent
            if b < own and size > most:  # nor is it in reach of the tiles below
                break
            differ = (high + most) * (100 - self.percent) // (100 + self.percent)
            if differ:  # else only equal sets link, and those are one class
                spare = 1 if differ < 10 else 2 + differ // 20
                out.append((b, differ + 1 + spare, spare))
        return out


def bucket_keys(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """The keys under which a set looks for candidates."""
    out = []
    for tile, buckets, spare in bands.tiles(len(shingles)):
        at = ((shingles >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)  # rises with the hash
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        salt = np.uint64((tile + 1) * int(_C) & 0xFFFFFFFFFFFFFFFF)
        out.append(_mix(np.add.reduceat(_mix(shingles ^ _A), first) + (at[first] + np.uint64(1)) * _B + salt))
        if buckets - len(first) > spare:
            empty = np.setdiff1d(np.arange(buckets, dtype=np.uint64), at[first])
            out.append(_mix((empty + np.uint64(1)) * _B + salt))
    return np.concatenate(out) >> np.uint64(16) if out else np.zeros(0, np.uint64)


def _pack_keys(keys: np.ndarray) -> bytes:
    """48-bit keys in six bytes each; a chance match costs a comparison, no link."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack_keys(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def parity_bitmap(shingles: np.ndarray) -> np.ndarray:
    """Bit j: whether an odd number of shingles has hash j modulo the width, a
    power of two of at least the set's size."""
    width = max(_BITS, 1 << (len(shingles) - 1).bit_length())
    odd = (np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.uint64)


def _fold(bitmap: np.ndarray, longs: int) -> np.ndarray:
    """The bitmap for a smaller width: parities of halves add up."""
    while len(bitmap) > longs:
        bitmap = bitmap[:len(bitmap) // 2] ^ bitmap[len(bitmap) // 2:]
    return bitmap


_SETS = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()),
                   ("digest", pa.binary()), ("bitmap", pa.binary()), ("keys", pa.binary())])


def _slices(batch, rows: int = 1000):
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def build_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    bands = Bands(percent)

    def rows(batches):
        for whole in batches:
            for b in _slices(whole):
                ns, digests, bitmaps, keys = [], [], [], []
                for s in shingle_sets(b.column("text").to_pylist(), n):
                    ns.append(len(s))
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    bitmaps.append(parity_bitmap(s).tobytes() if len(s) else None)
                    keys.append(_pack_keys(bucket_keys(s, bands)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("uid"), b.column("doc_id"), b.column("text_hash"), pa.array(ns, pa.int64()),
                     pa.array(digests, pa.binary()), pa.array(bitmaps, pa.binary()), pa.array(keys, pa.binary())], schema=_SETS)

    source = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
                         F.xxhash64("text").alias("text_hash"), "text")
    return materialise(source.mapInArrow(rows, "uid bigint, doc_id bigint, text_hash bigint, n bigint, digest binary, "
                                               "bitmap binary, keys binary"), "shingle-sets")


def _runs(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal sorted keys."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)


def _lengths(first: np.ndarray, total: int) -> np.ndarray:
    return np.diff(np.append(first, total))


def _dealt(parts: np.ndarray, columns: list[np.ndarray], kind: int):
    """One row per target with its entries: kind 0 keys and two columns, kind 1 pairs."""
    order = np.argsort(parts, kind="stable")
    parts, columns = parts[order], [c[order] for c in columns]
    first = _runs(parts)
    for s, e in zip(first, [*first[1:], len(parts)]):
        own = [c[s:e] for c in columns]
        yield {"p": int(parts[s]), "kind": kind, "keys": _pack_keys(own.pop(0)) if kind == 0 else b"",
               "a": zstandard.compress(own[0].tobytes(), 1), "b": zstandard.compress(own[1].tobytes(), 1)}


_DEALT = pa.schema([("p", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("a", pa.binary()), ("b", pa.binary())])
_DEALT_SQL = "p int, kind int, keys binary, a binary, b binary"


def _entries(batch, *columns):
    """Keys of a batch of sets with the rows they come from, sorted by key, and the columns as arrays."""
    data = [_unpack_keys(k) for k in batch.column("keys").to_pylist()]
    keys = np.concatenate(data) if data else np.zeros(0, np.uint64)
    of = np.repeat(np.arange(len(data)), [len(k) for k in data])
    order = np.argsort(keys, kind="stable")
    return keys[order], of[order], [batch.column(c).to_numpy() for c in columns]


def _joined(rows, column: str, kind: int) -> np.ndarray:
    data = rows.loc[rows.kind == kind, column]
    if column == "keys":
        return np.concatenate([np.zeros(0, np.uint64), *map(_unpack_keys, data)])
    return np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(zstandard.decompress(x), np.int64) for x in data]])


def _stars(keys, uid, weight):
    """Starts of the groups of equal keys, their central member (the
    weightiest, of those the smallest uid), and (member, centre) pairs."""
    order = np.lexsort((uid, -weight, keys))
    keys, uid, weight = keys[order], uid[order], weight[order]
    first = _runs(keys)
    centre = np.repeat(uid[first], _lengths(first, len(keys)))
    other = uid != centre
    return keys[first], uid[first], weight[first], np.stack([uid[other], centre[other]], 1)


def star_pairs(sets: DataFrame, parts: int) -> DataFrame:
    """Distinct (a, b): a set and the centre of a group of its keys (of the
    group's part in a batch of rows, and of those parts' centres). A set's
    weight is the number of others it shares keys with in its batch, so the
    text that a large group's copies derive from tends to be the centre."""

    def deal(batches):
        for whole in batches:
            for batch in _slices(whole, 4000):
                keys, of, (uid,) = _entries(batch, "uid")
                n = _lengths(_runs(keys), len(keys))
                weight = np.bincount(of, weights=np.repeat(n - 1, n), minlength=batch.num_rows).astype(np.int64)
                keys, centre, weight, pairs = _stars(keys, uid[of], weight[of])
                out = list(_dealt((keys % np.uint64(parts)).astype(np.int64), [keys, centre, weight], 0))
                pairs = np.unique(pairs, axis=0)
                out += _dealt((_mix(pairs[:, 0].astype(np.uint64)) % np.uint64(parts)).astype(np.int64), [pairs[:, 0], pairs[:, 1]], 1)
                yield pa.RecordBatch.from_pylist(out, _DEALT)

    def meet(rows):
        pairs = _stars(*(_joined(rows, c, 0) for c in ("keys", "a", "b")))[3]
        pairs = np.unique(np.concatenate([pairs, np.stack([_joined(rows, "a", 1), _joined(rows, "b", 1)], 1)]), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return sets.select("uid", "keys").mapInArrow(deal, _DEALT_SQL).groupBy("p").applyInPandas(meet, "a bigint, b bigint").distinct()


def open_groups(sets: DataFrame, parts: int) -> DataFrame:
    """(key, members, main, main_members): groups of three or more
    (uid, comp, keys) rows that hold several components, and the largest one."""

    def count(keys, comp, n):
        order = np.lexsort((comp, keys))
        keys, comp, n = keys[order], comp[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (comp[1:] != comp[:-1])))) if len(keys) else _runs(keys)
        return keys[first], comp[first], np.add.reduceat(n, first) if len(first) else n

    def deal(batches):
        for whole in batches:
            for batch in _slices(whole, 4000):
                keys, of, (comp,) = _entries(batch, "comp")
                keys, comp, n = count(keys, comp[of], np.ones(len(keys), np.int64))
                yield pa.RecordBatch.from_pylist(list(_dealt((keys % np.uint64(parts)).astype(np.int64), [keys, comp, n], 0)), _DEALT)

    def meet(rows):
        keys, comp, n = count(*(_joined(rows, c, 0) for c in ("keys", "a", "b")))
        order = np.lexsort((comp, -n, keys))
        keys, comp, n = keys[order], comp[order], n[order]
        first = _runs(keys)
        members = np.add.reduceat(n, first) if len(first) else n
        some = (_lengths(first, len(keys)) > 1) & (members > 2)
        at = first[some]
        return pd.DataFrame({"key": keys[at].astype(np.int64), "members": members[some], "main": comp[at], "main_members": n[at]})

    return sets.select("comp", "keys").mapInArrow(deal, _DEALT_SQL).groupBy("p").applyInPandas(
        meet, "key bigint, members bigint, main bigint, main_members bigint")


def _room(n, m, differ, percent: int):
    """Whether sizes and the least number of differing shingles allow a link."""
    return ((100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & ((100 + percent) * differ <= (100 - percent) * (n + m)))


def _bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that sizes and bitmaps do not rule out."""
    def passes(batches):
        for whole in batches:
            for b in _slices(whole):
                x, y = ([np.frombuffer(v, np.uint64) for v in b.column(c).to_pylist()] for c in ("x", "y"))
                differ = np.array([int(np.bitwise_count(_fold(p, len(q)) ^ _fold(q, len(p))).sum()) for p, q in zip(x, y)], np.int64)
                keep = _room(b.column("n").to_numpy(), b.column("m").to_numpy(), differ, percent)
                yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    info = sets.select("uid", "n", "bitmap")
    both = info.toDF("a", "n", "x").join(bounded(pairs, "pairs"), "a").join(info.toDF("b", "m", "y"), "b")
    both = both.where((100 * F.least("n", "m") >= percent * F.greatest("n", "m")))
    return both.select("a", "b", "n", "m", "x", "y").mapInArrow(passes, "a bigint, b bigint")


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs that link: bound first, then exact intersection of arrays
    recomputed from the texts of the documents that are left."""
    left = materialise(_bounded(pairs, sets, percent), "near-pairs")
    wanted = left.select(F.explode(F.array("a", "b")).alias("uid")).distinct()
    wanted = bounded(sets.select("uid", F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).join(wanted, "uid"), "near-docs")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").join(
        wanted, (F.col("text_hash") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_d"))).select("uid", "text")

    def arrays(batches):
        for whole in batches:
            for b in _slices(whole):
                sets = [s.tobytes() for s in shingle_sets(b.column("text").to_pylist(), n)]
                yield pa.RecordBatch.from_arrays([b.column("uid"), pa.array(sets, pa.binary())], names=["uid", "s"])

    def exact(batches):
        for whole in batches:
            for b in _slices(whole):
                keep = []
                for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist()):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    i = np.searchsorted(y, x)
                    i[i == len(y)] = 0
                    both = int((y[i] == x).sum())
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    data = materialise(texts.mapInArrow(arrays, "uid bigint, s binary").dropDuplicates(["uid"]), "near-arrays", compression="none")
    both = left.join(data.select(F.col("uid").alias("a"), F.col("s").alias("x")), "a").join(
        data.select(F.col("uid").alias("b"), F.col("s").alias("y")), "b")
    return materialise(both.select("a", "b", "x", "y").mapInArrow(exact, "a bigint, b bigint"), "links")


def components(edges: DataFrame) -> DataFrame:
    """(uid, comp): the smallest uid reachable, for every uid of an edge.

    Each round hooks every component to the least of its neighbours, follows
    these hooks to their ends by doubling, and contracts the edges to the new
    components. A component that has an edge left joins at least one other, so
    the components at least halve: rounds are logarithmic, chains included."""
    links = materialise(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-links")
    labels = None
    while not links.isEmpty():
        near = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.min("b").alias("m"))
        hooks = materialise(near.select(F.col("a").alias("uid"), F.least("a", "m").alias("to")), "cc-hooks")
        while True:
            ahead = hooks.select(F.col("uid").alias("_u"), F.col("to").alias("_t"))
            far = materialise(hooks.join(ahead, F.col("to") == F.col("_u")).select("uid", F.col("_t").alias("to"), (F.col("_t") != F.col("to")).alias("moved")), "cc-hooks")
            hooks = far.select("uid", "to")
            if far.where("moved").isEmpty():
                break
        step = hooks.select(F.col("uid").alias("comp"), "to")
        labels = hooks.select("uid", F.col("to").alias("comp")) if labels is None else materialise(
            labels.join(step, "comp", "left").select("uid", F.coalesce("to", "comp").alias("comp")), "cc-labels")
        ends = [step.select(F.col("comp").alias(c), F.col("to").alias("_" + c)) for c in "ab"]
        links = links.join(ends[0], "a").join(ends[1], "b").where("_a <> _b").select(
            F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
        links = materialise(links.distinct(), "cc-links")
    return edges.select(F.col("a").alias("uid"), F.col("a").alias("comp")).limit(0) if labels is None else labels


def _across_components(groups: DataFrame, members: DataFrame, sets: DataFrame, percent: int, tile_rows: int) -> DataFrame:
    """Pairs of different components in the groups that pass the bound.
    ``groups``: (key, members); ``members``: (uid, comp, keys)."""

    def entries(batches):
        for whole in batches:
            for b in _slices(whole, 4000):
                keys, of, (uid, comp) = _entries(b, "uid", "comp")
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(uid[of]), pa.array(comp[of])], names=["key", "uid", "comp"])

    rows = members.mapInArrow(entries, "key bigint, uid bigint, comp bigint").join(bounded(groups, "open"), "key")
    rows = materialise(rows, "open-members")
    # groups with the same members are one
    same = rows.groupBy("key").agg(F.sum(F.xxhash64("uid").cast("decimal(20,0)")).alias("h"), F.first("members").alias("n"))
    rows = rows.join(bounded(same.groupBy("h", "n").agg(F.min("key").alias("key")).select("key"), "open-keys"), "key")
    # chunks of the members outside the largest component meet each other and those of that component
    others = F.ceil((F.col("members") - F.col("main_members")) / tile_rows).cast("int")
    mains = F.ceil(F.col("main_members") / tile_rows).cast("int")
    rows = rows.withColumn("t", F.explode(F.when(F.col("comp") == F.col("main"), F.sequence(F.lit(0), others - 1))
                                          .otherwise(F.sequence(F.lit(0), others + mains - 1))))
    rows = rows.withColumn("m", F.when(F.col("comp") == F.col("main"), others + F.pmod(F.xxhash64("uid"), mains))
                           .otherwise(F.pmod(F.xxhash64("uid"), others)).cast("int"))
    rows = rows.select("key", F.least("m", "t").alias("i"), F.greatest("m", "t").alias("j"), "m", "uid", "comp")
    rows = rows.join(sets.select("uid", "n", "bitmap"), "uid")
    names = ["key", "i", "j"]
    rows = rows.repartition(*names).sortWithinPartitions(*names)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches):
        held = None

        def tile(t):
            i, j, m, n = t.i.iloc[0], t.j.iloc[0], t.m.to_numpy(), t.n.to_numpy()
            bits, comp, uid = [np.frombuffer(x, np.uint64) for x in t.bitmap], t.comp.to_numpy(), t.uid.to_numpy()
            bits = np.stack([_fold(x, min(map(len, bits))) for x in bits])
            left, right = np.flatnonzero(m == i), np.flatnonzero(m == j)
            a, b = [], []
            for x in left:
                y = right if i != j else right[right > x]
                y = y[comp[y] != comp[x]]
                differ = np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1, dtype=np.int64)
                y = y[_room(n[y], n[x], differ, percent)]
                a.append(np.minimum(uid[y], uid[x]))
                b.append(np.maximum(uid[y], uid[x]))
            return (np.concatenate(a), np.concatenate(b)) if a else (uid[:0], uid[:0])

        def tiles(frame):
            found = [tile(t) for _, t in frame.groupby(names, sort=False)]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in (0, 1)], schema=schema)

        for batch in batches:
            frame = batch.to_pandas()
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            if not len(frame):
                continue
            last = (frame[names] == frame[names].iloc[-1]).all(axis=1)
            held = frame[last]
            if not last.all():
                yield tiles(frame[~last])
        if held is not None and len(held):
            yield tiles(held)

    return rows.select(*names, "m", "uid", "comp", "n", "bitmap").mapInArrow(compare, "a bigint, b bigint").distinct()


def jaccard_components(docs: DataFrame, n: int = 4, percent: int = 85, tile_rows: int = 512) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, is_first), one row per
    document; exactly one row of a component is its first."""
    spark = docs.sparkSession
    sets = build_sets(docs, n, percent)
    filled = sets.where("n > 0")
    lowest = F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("doc_id"), F.col("uid").alias("uid"))
    classes = materialise(filled.groupBy("digest").agg(F.min("uid").alias("rep"), F.min(lowest).alias("low"),
                                                       F.count(F.lit(1)).alias("rows")), "classes")
    copies = sets.select("uid", "digest").join(classes.where("rows > 1"), "digest").where("uid <> rep").select("uid")
    reps = filled.join(bounded(copies, "copies"), "uid", "left_anti")
    total = sets.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // 6 // 400_000 + 1)
    pairs = materialise(star_pairs(reps, parts), "star-pairs")
    edges = verified(pairs, sets, docs, n, percent)
    found = components(edges)
    touched = pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct().join(found, "uid", "left").select(
        "uid", F.coalesce("comp", "uid").alias("comp"))
    members = materialise(sets.select("uid", "keys").join(bounded(touched, "comps"), "uid"), "touched")
    groups = materialise(open_groups(members, parts), "open-groups")
    if not groups.isEmpty():
        more = _across_components(groups, members, sets, percent, tile_rows)
        known = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        more = materialise(more.join(known, ["a", "b"], "left_anti"), "cross-pairs")
        new = verified(more, sets, docs, n, percent)
        if not new.isEmpty():
            found = components(edges.unionAll(new))
    of_class = classes.join(found.withColumnRenamed("uid", "rep"), "rep", "left").select(
        "digest", "low", F.coalesce("comp", "rep").alias("comp"))
    first = of_class.groupBy("comp").agg(F.min("low").alias("low"))
    of_class = of_class.select("digest", "comp").join(first, "comp").select("digest", "low")
    return sets.select("uid", "doc_id", "text_hash", "n", "digest").join(of_class, "digest", "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("low.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        ((F.col("n") == 0) | (F.col("uid") == F.col("low.uid"))).alias("is_first"))
