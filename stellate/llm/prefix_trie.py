"""Operator 11: prefix trie of conversations, rolled up by centroid decomposition.

Every conversation takes its first h turns from the conversation at the start
of its block of 20 ids (see ``rebuilt``); a node is a distinct sequence of
first d turns. The sums over a node's subtree come from a centroid
decomposition of the forest of parent edges:

* Every node weighs its number of members, so a subtree weighs the members'
  turns from its top on. That weight needs no rollup: it is a plain sum over
  the rows of a node.
* In a component of weight w the nodes whose part of the component weighs at
  least w / 2 form the path from the top to the centroid, its deepest node.
* The centroid and all below it in the component are summed once, and the sum
  is added to each node of that path. Then the centroid is taken out: each
  child starts a component of its own, the rest above loses that weight.

Weights halve, so the rounds are at most the logarithm of the number of
turns, however long a conversation or deep the trie is; a sequence of any
length is numbered and hashed in blocks.

Defined cases: rows without a conv_id belong to no conversation and are left
out; NULL roles and texts are empty; a NULL turn comes first; turns of one
number follow by role and text, and equal rows stay as often as they come; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import SPACE, SQL_CRC_TABLE, bounded, materialise, sql_crc32

#: Prefixes are polynomials of the turns' hashes modulo this prime.
PRIME, BASE = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F
ROOT = bytes(16)
BLOCK = 1024


def _numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, hash, words): turns numbered from 0 in each conversation.

    A range sort deals a long conversation out to several tasks; each counts
    its own rows, and one row a task says how many its first conversation has before."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), role.alias("role"),
        F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)).alias("hash"),
        text.alias("text"), F.regexp_count(text, F.lit(SPACE.replace("[", "[^") + "+")).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("tie"))  # deals equal rows, whose order does not matter, to several tasks
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("tie")]
    schema = pa.schema([("task", pa.int64()), ("conv_id", pa.int64()), ("pos", pa.int64()), ("hash", pa.binary()), ("words", pa.int64())])

    def count(batches):
        task, last, n = TaskContext.get().partitionId(), None, 0
        for b in batches:
            pos = []
            for c in b.column("conv_id").to_pylist():
                n = n + 1 if c == last else 0
                last = c
                pos.append(n)
            yield pa.RecordBatch.from_arrays([pa.array([task] * len(pos), pa.int64()), b.column("conv_id"), pa.array(pos, pa.int64()),
                                              b.column("hash"), b.column("words")], schema=schema)

    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "hash", "words")
    rows = materialise(rows.mapInArrow(count, "task bigint, conv_id bigint, pos bigint, hash binary, words bigint"), "numbered")
    ends = rows.groupBy("task").agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("last"), F.max_by("pos", F.struct("conv_id", "pos")).alias("pos"))
    before, held, starts = None, 0, []
    for r in sorted(ends.collect()):  # one row a task
        start = held if before == r["first"] else 0
        starts.append((r["task"], r["first"], start))
        before, held = r["last"], r["pos"] + 1 + (start if r["first"] == r["last"] else 0)
    moved = [s for s in starts if s[2]]
    if not moved:
        return rows.drop("task")
    moved = F.broadcast(rows.sparkSession.createDataFrame(moved, "task bigint, conv_id bigint, start bigint"))
    return rows.join(moved, ["task", "conv_id"], "left").select(
        "conv_id", (F.col("pos") + F.coalesce("start", F.lit(0))).alias("pos"), "hash", "words")


def rebuilt(turns: DataFrame, block: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, depth, len, hash, words) of the rebuilt conversations, depth
    from 1, and (conv_id, len) of all, turnless ones included. Conversation c
    has the first h = crc32(c) mod ``heads`` turns of conversation c - c % ``block``."""
    rows = _numbered(turns)
    convs = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    convs = convs.select("*", (F.col("conv_id") - F.col("conv_id") % block).alias("base"),
                         F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).cast("long").alias("h"))
    lens = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    convs = convs.join(lens, "base", "left").select("conv_id", "base", "own", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken"))
    convs = materialise(convs.select("*", (F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("len")), "convs")
    first = rows.where(F.col("pos") < heads - 1).withColumnRenamed("conv_id", "base")
    head = convs.where("taken > 0").join(first, "base").where("pos < taken").select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "len", "hash", "words")
    # one row a block of turns, so that a long conversation's rows meet it in many tasks
    meta = convs.where("own > h").select("conv_id", "h", "taken", "len", F.explode(F.expr(f"sequence(0L, (own - 1) div {BLOCK})")).alias("block"))
    own = rows.withColumn("block", F.expr(f"pos div {BLOCK}")).join(meta, ["conv_id", "block"]).where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("depth"), "len", "hash", "words")
    return materialise(head.unionByName(own), "rebuilt"), convs.select("conv_id", "len")


def _prefixes(rows: DataFrame, base: int, others: tuple[str, ...] = ()) -> DataFrame:
    """(conv_id, depth, *others, node, parent): hash of the first ``depth`` items,
    128 bits, and of one fewer; rows are (conv_id, depth, hash, *others), depth
    from 1; the other columns are longs.
    Blocks of a sequence are hashed on their own; their totals are items of a
    shorter sequence, whose prefixes then move the rows of each block."""
    kept = ["conv_id", "depth", *others]
    schema = ", ".join(f"{c} bigint" for c in kept)
    blocks = rows.select(*kept, "hash", F.expr(f"(depth - 1) div {BLOCK}").alias("block"))

    def batch(b, names, node, parent):
        return pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(node, pa.binary()), pa.array(parent, pa.binary())],
                                          names=[*names, "node", "parent"])

    def scan(batches):
        last, state = None, 0
        for b in batches:
            node, parent = [], []
            for key in zip(b.column("conv_id").to_pylist(), b.column("block").to_pylist(), b.column("hash").to_pylist()):
                if key[:2] != last:
                    last, state = key[:2], 0
                parent.append(state.to_bytes(16, "big"))
                state = (state * base + int.from_bytes(key[2], "big") + 1) % PRIME
                node.append(state.to_bytes(16, "big"))
            yield batch(b, [*kept, "block"], node, parent)

    local = blocks.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "depth")
    local = materialise(local.mapInArrow(scan, f"{schema}, block bigint, node binary, parent binary"), "prefixes")
    full = local.where(f"depth % {BLOCK} = 0")
    if full.isEmpty():
        return local.drop("block")
    power = pow(base, BLOCK, PRIME)
    # a block's total is an item as it stands: item + 1 is added, so 1 is taken off
    less = full.select("conv_id", (F.col("block") + 1).alias("depth"), F.col("node").alias("hash"))
    before = _prefixes(less.mapInArrow(_less_one, "conv_id bigint, depth bigint, hash binary"), power).select(
        "conv_id", F.col("depth").alias("block"), F.col("node").alias("before"))

    def move(batches):
        for b in batches:
            node, parent = [], []
            for depth, n, p, ahead in zip(*(b.column(c).to_pylist() for c in ("depth", "node", "parent", "before"))):
                k, ahead = (depth - 1) % BLOCK, int.from_bytes(ahead, "big")
                node.append(((ahead * pow(base, k + 1, PRIME) + int.from_bytes(n, "big")) % PRIME).to_bytes(16, "big"))
                parent.append(((ahead * pow(base, k, PRIME) + int.from_bytes(p, "big")) % PRIME).to_bytes(16, "big"))
            yield batch(b, kept, node, parent)

    moved = local.where("block > 0").join(before, ["conv_id", "block"]).mapInArrow(move, f"{schema}, node binary, parent binary")
    return local.where("block = 0").drop("block").unionByName(moved)


def _less_one(batches):
    for b in batches:
        less = [((int.from_bytes(x, "big") - 1) % PRIME).to_bytes(16, "big") for x in b.column("hash").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("depth"), pa.array(less, pa.binary())], names=["conv_id", "depth", "hash"])


def trie(turns: DataFrame, block: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes (node, parent, conv_id, depth, n_convs, words, weight), the rows
    (conv_id, depth, node) of all conversations and (node, conv_id) where each ends."""
    rows, convs = rebuilt(turns, block, heads)
    rows = materialise(_prefixes(rows, BASE, ("len", "words")), "trie-rows")
    nodes = rows.groupBy("node").agg(F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
                                     F.count(F.lit(1)).alias("n_convs"), F.first("words").alias("words"),
                                     F.sum(F.col("len") - F.col("depth") + 1).alias("weight"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.coalesce(F.sum("len"), F.lit(0)).alias("weight")).where("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs",
                       F.lit(0).cast("long").alias("words"), (F.col("weight") + 1).alias("weight"))
    ends = rows.where("depth = len").select("node", "conv_id").unionByName(convs.where("len = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    return materialise(nodes.unionByName(root), "trie-nodes"), rows.select("conv_id", "depth", "node"), ends


def subtree_sums(nodes: DataFrame, rows: DataFrame, values: list[str]) -> DataFrame:
    """(node, *values): the values summed over each node's subtree, by centroid
    decomposition. ``nodes``: (node, parent, conv_id, depth, weight, *values) of one tree
    with the weight of the whole subtree, at least its number of nodes;
    ``rows``: (conv_id, depth, node) of at least the conversations that nodes name."""
    total = nodes.agg(F.max("weight")).first()[0]
    if total is None:
        return nodes.select("node", *values)
    state = nodes.select("node", "parent", "conv_id", "depth", "weight", *values, F.lit(ROOT).alias("comp"), F.lit(total).cast("long").alias("total"))
    paths, sums, level = [], [], 0
    while not state.isEmpty():
        on_path = F.col("weight") * 2 >= F.col("total")
        centroids = bounded(state.where(on_path).groupBy("comp").agg(F.max(F.struct("depth", "node", "weight")).alias("z")), "centroids")
        centroids = centroids.select("comp", F.col("z.depth").alias("z_depth"), F.col("z.node").alias("z"), F.col("z.weight").alias("z_weight"))
        # which child of the centroid the conversation that names a node goes through
        kids = state.select("comp", F.col("parent").alias("z"), F.col("node").alias("child"), F.col("weight").alias("child_weight"))
        kids = kids.join(centroids.select("comp", "z"), ["comp", "z"]).drop("z")
        ways = materialise(rows.join(bounded(kids, "children").withColumnRenamed("child", "node"), "node").select(
            "comp", "conv_id", F.col("node").alias("child"), "child_weight"), "ways")
        d = state.join(centroids, "comp").join(ways, ["comp", "conv_id"], "left")
        below = (F.col("depth") > F.col("z_depth")) & F.col("child").isNotNull()
        d = materialise(d.select(
            "node", "parent", "conv_id", "depth", *values, F.col("comp").alias("old"), on_path.alias("on_path"), below.alias("below"), (F.col("node") == F.col("z")).alias("out"),
            F.when(below, F.col("child")).otherwise(F.col("comp")).alias("comp"),
            F.when(below, F.col("child_weight")).otherwise(F.col("total") - F.col("z_weight")).alias("total"),
            F.when(on_path, F.col("weight") - F.col("z_weight")).otherwise(F.col("weight")).alias("weight")), f"level-{level}")
        tag = F.lit(level).alias("level")
        paths.append(d.where("on_path").select("node", F.col("old").alias("comp"), tag))
        sums.append(d.where("below OR out").groupBy(F.col("old").alias("comp")).agg(*[F.sum(v).alias(v) for v in values]).select("comp", tag, *values))
        state = d.where("NOT out").select("node", "parent", "conv_id", "depth", "weight", *values, "comp", "total")
        level += 1
    path, found = paths[0], sums[0]
    for p, s in zip(paths[1:], sums[1:]):
        path, found = path.unionByName(p), found.unionByName(s)
    found = bounded(found, "sums")
    return path.join(found, ["comp", "level"]).groupBy("node").agg(*[F.sum(v).alias(v) for v in values])


def ends_digest(ends: DataFrame, chunk: int = 512) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the sorted, comma-joined conv_ids of each
    node. The ids are sorted and joined in many tasks; the digest itself, which
    is sequential, then reads chunks of ids as a stream."""
    def chunks(batches):
        key, held, k = None, [], 0
        out = []
        for b in batches:
            for node, c in zip(b.column("node").to_pylist(), b.column("conv_id").to_pylist()):
                if node != key or len(held) == chunk:
                    if held:
                        out.append((key, int(held[0]), ",".join(held)))
                    key, held = node, []
                held.append(str(c))
            yield batch(out)
            out = []
        if held:
            yield batch([(key, int(held[0]), ",".join(held))])

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.string()))], names=["node", "first", "ids"])

    def digest(batches):
        key, state = None, None
        for b in batches:
            done = []
            for node, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist()):
                if node != key:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(("," + ids).encode())
            yield hexes(done)
        if state is not None:
            yield hexes([(key, state.hexdigest())])

    def hexes(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["node", "ends_sha256"])

    joined = materialise(ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").select("node", "conv_id").mapInArrow(
        chunks, "node binary, first bigint, ids string"), "ends")
    return joined.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, block: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256), one row per node."""
    nodes, rows, ends = trie(turns, block, heads)
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialise(nodes.join(kids, "node", "left").select(
        "*", F.coalesce("n_children", F.lit(0)).alias("kids"), F.col("n_children").isNull().cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")).drop("n_children"), "nodes")
    named = rows.join(nodes.select("conv_id").distinct(), "conv_id", "left_semi")
    sums = subtree_sums(nodes.select("node", "parent", "conv_id", "depth", "weight", "n_leaves", "saved_tokens"), materialise(named, "named"), ["n_leaves", "saved_tokens"])
    above = bounded(nodes.where("kids > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parents")
    out = nodes.drop("n_leaves", "saved_tokens").join(above, "parent", "left").join(sums, "node").join(ends_digest(ends), "node", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.col("kids").alias("n_children"), "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


ORACLE = rf"""
WITH {SQL_CRC_TABLE},
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce("text", '')) - 1 AS pos,
             coalesce(role, '') AS role, coalesce("text", '') AS txt FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {sql_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t), crc_table),
b AS (SELECT c.conv_id, 0 AS part, t.pos, t.role, t.txt FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.h
      UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.txt FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h),
-- a prefix is named by chained digests of its turns
r AS (SELECT conv_id, row_number() OVER w AS depth, txt, list(sha256(length(role) || ':' || role || txt)) OVER w AS seq,
             count(*) OVER (PARTITION BY conv_id) AS len
      FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
p AS (SELECT conv_id, depth, len, txt, array_to_string(seq, ',') AS node, array_to_string(seq[:-2], ',') AS parent FROM r
      UNION ALL SELECT c.conv_id, 0, coalesce(m.n, 0), '', 'root', NULL FROM c LEFT JOIN (SELECT conv_id, count(*) AS n FROM b GROUP BY 1) m USING (conv_id)),
n AS (SELECT node, any_value(CASE WHEN parent = '' THEN 'root' ELSE parent END) AS parent, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs,
             (count(*) - 1) * any_value(len(list_filter(string_split_regex(txt, '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS saved,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = len), '')) AS ends_sha256 FROM p GROUP BY node),
k AS (SELECT parent AS node, count(*) AS kids FROM n WHERE parent IS NOT NULL GROUP BY 1),
-- every node adds to itself and to all nodes above it, found through one of its members
s AS (SELECT a.node, sum(x.saved) AS saved, count(*) FILTER (k.kids IS NULL) AS leaves
      FROM n x JOIN p a ON a.conv_id = x.conv_id AND a.depth <= x.depth LEFT JOIN k ON k.node = x.node GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(k.kids, 0) AS BIGINT) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN s USING (node) LEFT JOIN k USING (node) LEFT JOIN n u ON u.node = n.parent
"""
