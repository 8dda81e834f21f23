"""Operator 4: shards by balanced label propagation.

Documents are linked through anchors (here: the text they share), a star per
group instead of its pairs. Linked documents start in shards by a hash; in
every round each anchor counts its documents per shard, each document sums
the counts of its anchors and asks to move where most of its neighbours are.
What a shard takes follows from the counts of asked moves between shards: its
room and the places that its own movers leave, so full shards swap. Luck is
drawn per anchor, so a group moves whole, and a shard that could not take all
is left out by a like share of anchors in the next round. A group larger than
a shard goes to the fewest shards that can hold it, and small groups that are
whole give way to it. Rounds end when the cut (links outside their anchor's
shards) stops falling; the least cut is kept. Rows without links then fill all
shards up to their quota.

The law is ``rows``: shard counts differ by one at most. Places are dense
ranks from a range-partitioned sort, not one task's numbering.

Defined cases: a NULL or empty text has size 1, checksum 0 and, if NULL, no
link; repeated rows and NULL ids are rows like others; an empty table gives
no rows; with fewer rows than shards some shards stay empty.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import bounded, materialise
from stellate.operators.keys import assign_dense_keys


def text_links(rows: DataFrame) -> DataFrame:
    """(uid, anchor) of rows whose text occurs again."""
    groups = rows.where("anchor IS NOT NULL").groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return rows.select("uid", "anchor").join(bounded(groups.select("anchor"), "shard-groups"), "anchor").select("uid", "anchor")


def shared_line_links(docs: DataFrame, min_chars: int = 80) -> DataFrame:
    """(uid, anchor) of lines of at least ``min_chars`` characters that more
    than one row of ``docs`` (uid, text) has."""
    lines = docs.select("uid", F.explode(F.array_distinct(F.split("text", "\n"))).alias("l"))
    lines = lines.where(F.length("l") >= min_chars).select("uid", F.unhex(F.md5(F.col("l").cast("binary"))).alias("anchor"))
    often = lines.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return lines.join(often.select("anchor"), "anchor").select("uid", "anchor")


def accepted(asked: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The share of movers each shard takes: the most at which, by the counts
    ``asked[from, to]``, no shard takes more than its room and what leaves it."""
    into, share = asked.sum(axis=0), np.ones(len(room))
    for _ in range(1000):
        new = np.where(into > 0, np.clip((room + asked @ share) / np.maximum(into, 1), 0, share), 1.0)
        if np.abs(new - share).max() < 1e-6:
            break
        share = new
    return share


def _draw(*cols: Column | int) -> Column:
    """A number in [0, 1) that depends on ``cols`` only."""
    return F.pmod(F.xxhash64(*[c if isinstance(c, Column) else F.lit(c) for c in cols]), F.lit(1 << 30)) / float(1 << 30)


def propagate(links: DataFrame, n_rows: int, n_shards: int = 16, patience: int = 3) -> DataFrame:
    """(uid, shard) of the linked rows. Shards may pass their quota by a
    fiftieth and the chance in accepting movers, which the caller evens out.
    Ends when ``patience`` rounds have not lowered the cut by a hundredth."""
    shards = range(n_shards)
    quota = -(-n_rows // n_shards)
    start = F.pmod(F.xxhash64(F.lit(-1), F.col("uid")), F.lit(n_shards)).cast("int").alias("shard")
    state = materialise(links.select("uid").distinct().select("uid", start), "shard-labels")
    total = F.aggregate("votes", F.lit(0).cast("long"), lambda a, v: a + v)
    # a group larger than a shard settles in as many of its first shards as it needs
    need = F.greatest(F.lit(1), F.ceil(total / quota)).cast("int")
    outside = total - F.aggregate(F.slice(F.sort_array("votes", asc=False), 1, need), F.lit(0).cast("long"), lambda a, v: a + v)
    share, pressure, best, cuts = np.ones(n_shards), np.zeros(n_shards), state, []
    while True:
        turn = len(cuts)
        votes = links.join(state, "uid").groupBy("anchor").agg(
            F.array(*[F.sum((F.col("shard") == s).cast("long")) for s in shards]).alias("votes"))
        votes = bounded(votes, "shard-votes", 100_000)
        cut = votes.agg(F.sum(outside)).first()[0] or 0
        if cuts and cut < min(cuts):
            best = state
        cuts.append(cut)
        if cut == 0 or turn >= patience and min(cuts[-patience:]) > 0.99 * min(cuts[:-patience]):
            return best
        wish = links.join(votes, "anchor").groupBy("uid").agg(
            F.array(*[F.sum(F.get("votes", F.lit(s))) for s in shards]).alias("votes"),
            F.min("anchor").alias("anchor"))
        wish = wish.join(state, "uid").withColumn("need", need).withColumn("whole", outside == 0)
        per = lambda values: F.get(F.array(*[F.lit(float(v)) for v in values]), F.col("shard"))
        wish = wish.withColumn("yields", F.col("whole") & (F.col("need") == 1) & (_draw(F.col("anchor"), turn, -3) < per(pressure)))
        # ties go to the same shard for all rows of an anchor, but spread over anchors
        options = F.array(*[F.struct(
            (~(F.col("yields") & (F.col("shard") == s))).alias("other"),
            (_draw(F.col("anchor"), turn, s) < float(share[s])).alias("open"),
            F.get("votes", F.lit(s)).alias("n"), F.xxhash64("anchor", F.lit(s)).alias("tie"), F.lit(s).alias("s")) for s in shards])
        first = F.transform(F.slice(F.sort_array(options, asc=False), 1, F.col("need")), lambda o: o["s"])
        wish = wish.withColumn("best", first)
        stays = F.when(F.col("whole"), ~F.col("yields")).otherwise(F.array_contains("best", F.col("shard")))
        large = F.col("need") > 1
        wish = materialise(wish.select(
            "uid", "shard", large.alias("large"),
            F.when(large, _draw(F.col("uid"), turn, -4)).otherwise(_draw(F.col("anchor"), turn, -4)).alias("luck"),
            F.when(stays, F.col("shard")).otherwise(
                F.get("best", F.pmod(F.xxhash64("uid", F.lit(-2)), F.size("best")).cast("int"))).alias("wish")), "shard-wishes")
        # n_shards * n_shards * 2 numbers
        held, asked, by_large = np.zeros(n_shards), np.zeros((n_shards, n_shards)), np.zeros(n_shards)
        for s, to, is_large, n in wish.groupBy("shard", "wish", "large").count().collect():
            held[s] += n
            if s != to:
                asked[s, to] += n
                by_large[to] += n * is_large
        share = accepted(asked, np.maximum(0, quota + quota // 50 - held))
        pressure = np.minimum(0.5, (1 - share) * by_large / np.maximum(held, 1))
        odds = F.get(F.array(*[F.lit(float(x)) for x in share]), F.col("wish"))
        state = materialise(wish.select("uid", F.when(F.col("luck") < odds, F.col("wish")).otherwise(F.col("shard")).alias("shard")),
                            "shard-labels")


def shard_documents(docs: DataFrame, n_shards: int = 16, patience: int = 3, min_line_chars: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row.
    With ``min_line_chars`` long lines that rows share link them, too."""
    data = F.col("text").cast("binary")
    rows = docs.select("doc_id", (F.coalesce(F.octet_length(data), F.lit(0)) + 1).cast("long").alias("size"),
                       F.coalesce(F.crc32(data), F.lit(0).cast("long")).alias("text_crc32"),
                       F.unhex(F.md5(data)).alias("anchor"), F.monotonically_increasing_id().alias("uid"),
                       *([] if min_line_chars is None else ["text"]))
    rows = materialise(rows, "shard-rows")
    n = rows.count()
    links = text_links(rows)
    if min_line_chars is not None:
        links = links.unionAll(shared_line_links(rows, min_line_chars)).distinct()
        rows = rows.drop("text")
    links = materialise(links, "shard-links")
    placed = rows.join(propagate(links, n, n_shards, patience), "uid", "left")
    quotas = [n // n_shards + (s < n % n_shards) for s in range(n_shards)]
    keep = ["doc_id", "size", "text_crc32", "anchor", "uid", "shard"]
    # linked rows by shard and group; what a shard cannot hold joins the rows without links
    linked, _ = assign_dense_keys(placed.where("shard IS NOT NULL").select(keep), "rank", order_by=["shard", "anchor", "uid"])
    held = dict(linked.groupBy("shard").count().collect())
    starts = [sum(held.get(t, 0) for t in range(s)) for s in range(n_shards)]
    per = lambda values, c: F.get(F.array(*[F.lit(int(v)) for v in values]), c)
    linked = linked.withColumn("slot", F.col("rank") - 1 - per(starts, F.col("shard")))
    stay = linked.where(F.col("slot") < per(quotas, F.col("shard"))).select("doc_id", "size", "text_crc32", "shard", "slot")
    over = linked.where(F.col("slot") >= per(quotas, F.col("shard"))).select(keep)
    rest, _ = assign_dense_keys(placed.where("shard IS NULL").select(keep).unionAll(over), "rank", order_by=["anchor", "uid"])
    used = [min(held.get(s, 0), quotas[s]) for s in range(n_shards)]
    ends = [sum(quotas[t] - used[t] for t in range(s + 1)) for s in range(n_shards)]
    place = F.size(F.filter(F.array(*[F.lit(int(e)) for e in ends]), lambda e: e < F.col("rank")))
    rest = rest.withColumn("shard", place).withColumn(
        "slot", F.col("rank") - 1 - per([0, *ends[:-1]], F.col("shard")) + per(used, F.col("shard")))
    return stay.unionByName(rest.select(stay.columns)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
