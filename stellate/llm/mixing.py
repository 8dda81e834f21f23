"""Operator 2: mixing sources to target weights by entropy balancing.

Wanted are document rates r close to 1 in relative entropy, at most
``cap``, such that every source's words meet its target:

    minimise  sum r log r - r   subject to  sum_{i in s} size_i r_i = target_s,  r_i <= cap.

The dual is convex with one multiplier per source and gives exponentially
tilted rates r_i = min(cap, exp(m_s size_i / mean size of s)). Newton steps,
kept inside a bracket, solve it; each step is one aggregation over the table
of (source, size, documents), whose rows are bounded by the distinct sizes.

Rates become copies by systematic sampling: along the documents of a source
by falling size, a copy is due whenever the running sum of rates passes the
next whole number, so the words are off by at most the largest document.
The running sum is exact (integer millionths) and distributed: rows are
range-partitioned (a hot source spreads over many partitions) and each
partition starts from the sum of those before it. What is left of the
difference is closed with single copies of at most four documents per source
and power of two of the size.

Defined cases: NULL and empty texts have size 0, take no words and keep one
copy; a NULL source is a source of its own, the last one; repeated rows and
NULL ids are rows like others (identical rows may differ in copies; the
multiset of results agrees between runs); an empty table gives an empty mix.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm.common import SPACE, materialise

_UNIT = 1_000_000


def word_count(text):
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")).cast("long")


def source_targets(sized: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: int = 2) -> DataFrame:
    """(source, source_size, target): sources by code point (NULL last) weigh
    ``weights`` in turn and share ``share`` times all words; none gets more
    than ``cap`` times its size, the excess goes to the others by weight.

    The refilling has a closed form: by rising cap per weight, the capped
    sources are a prefix, and the rest share what it leaves. The windows run
    over one row per source."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("_k") % len(weights) + 1)
    per = per.withColumn("_k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    per = per.select("source", "source_size", w.alias("_w"), (cap * F.col("source_size")).cast("double").alias("_c"))
    order = Window.orderBy(F.col("_c") / F.col("_w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((share * F.sum("source_size").over(whole) - F.coalesce(F.sum("_c").over(before), F.lit(0.0)))
             / F.sum("_w").over(after))
    per = per.withColumn("_level", level)
    free = F.col("_level") * F.col("_w") <= F.col("_c")
    per = per.withColumn("_first", F.min_by(F.when(free, F.col("_level")), F.when(free, F.col("_c") / F.col("_w"))).over(whole))
    return per.select("source", "source_size", F.least(F.col("_c"), F.coalesce(F.col("_first") * F.col("_w"), F.col("_c")))
                      .alias("target"))


def solve_tilts(sized: DataFrame, targets: DataFrame, cap: int = 2, tolerance: float = 1e-7) -> DataFrame:
    """(source, scale, tilt): the dual's solution, by safeguarded Newton steps.
    Every third step halves the bracket instead, so it closes and no tilt is left unsolved."""
    counts = materialise(sized.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    state = counts.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("scale")).join(
        targets.select(F.col("source").alias("_s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    full = F.col("target") >= F.col("source_size") * float(cap)
    state = materialise(state.select("source", "scale", "target", full.alias("full"), F.lit(0.0).alias("tilt"),
                                     F.lit(-1e6).alias("lo"), F.lit(1e6).alias("hi"), F.lit(False).alias("done")), "mix-tilts")
    for turn in count():
        if state.where(~F.col("full") & ~F.col("done")).isEmpty():
            break
        x = F.col("size") / F.col("scale")
        rate = F.least(F.lit(float(cap)), F.exp(F.least(F.col("tilt") * x, F.lit(50.0))))
        slope = F.when(rate < cap, rate * x).otherwise(0.0)
        sums = counts.withColumnRenamed("source", "_s").join(state, F.col("source").eqNullSafe(F.col("_s"))).groupBy("source").agg(
            *[F.first(c).alias(c) for c in ("scale", "target", "full", "tilt", "lo", "hi")],
            # sums of integers, so that the order of adding them does not matter
            (F.sum((F.round(rate * 1e9).cast("decimal(20,0)") * (F.col("n") * F.col("size")))) / F.lit(10**9)).cast("double").alias("got"),
            (F.sum((F.round(slope * 1e9).cast("decimal(20,0)") * (F.col("n") * F.col("size")))) / F.lit(10**9)).cast("double").alias("slope"))
        gap = F.col("got") - F.col("target")
        lo, hi = F.when(gap < 0, F.col("tilt")).otherwise(F.col("lo")), F.when(gap > 0, F.col("tilt")).otherwise(F.col("hi"))
        step = F.col("tilt") - gap / F.when(F.col("slope") > 0, F.col("slope"))
        moved = F.when((step > lo) & (step < hi) & F.lit(turn % 3 < 2), step).otherwise(F.when(lo < -1e5, F.least(hi * 2 - 1, F.lit(-1.0)))
                                                                  .when(hi > 1e5, F.greatest(lo * 2 + 1, F.lit(1.0)))
                                                                  .otherwise((lo + hi) / 2))
        done = (F.abs(gap) <= tolerance * F.col("target") + 0.5) | (hi - lo <= 1e-12 * F.greatest(F.lit(1.0), F.abs(lo), F.abs(hi)))
        state = materialise(sums.select("source", "scale", "target", "full", F.when(done | F.col("full"), F.col("tilt")).otherwise(moved)
                                        .alias("tilt"), lo.alias("lo"), hi.alias("hi"), done.alias("done")), "mix-tilts")
    return state.select("source", "scale", F.when(F.col("full"), F.lit(1e9)).otherwise(F.col("tilt")).alias("tilt"))


def _running_rates(rated: DataFrame) -> DataFrame:
    """``rated`` plus the sum of ``rate`` of the rows of the source before this one."""
    order = [F.col("source").asc_nulls_last(), F.col("size").desc(), "tie", "doc_id"]
    rows = materialise(rated.repartitionByRange(*order).sortWithinPartitions(*order)
                       .select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("uid")), "mix-order")
    starts = rows.groupBy("source", "_p").agg(F.sum("rate").alias("_n"))
    starts = starts.select(F.col("source").alias("_s"), F.col("_p").alias("_q"), F.coalesce(
        F.sum("_n").over(Window.partitionBy("source").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    inside = F.coalesce(F.sum("rate").over(Window.partitionBy("_p", "source").orderBy("uid")
                                           .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("_i", inside).join(
        starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_p") == F.col("_q"))).withColumn(
        "before", F.col("_b") + F.col("_i")).drop("_s", "_q", "_b", "_i", "_p")


def _corrections(mixed: DataFrame, targets: DataFrame, cap: int) -> DataFrame:
    """(uid, change): single copies that bring each source nearer to its target."""
    left = mixed.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken")).join(
        targets.select(F.col("source").alias("_s"), "target"), F.col("source").eqNullSafe(F.col("_s"))).select(
        F.col("source").alias("_s"), F.round(F.col("target") - F.col("taken")).cast("long").alias("gap"))
    one = F.struct(F.col("tie"), F.col("doc_id"), F.col("uid"), F.col("size"))
    more, less = F.when(F.col("copies") < cap, one), F.when(F.col("copies") > 0, one)
    picks = mixed.where("size > 0").groupBy("source", F.floor(F.log2("size")).alias("_c")).agg(
        F.array(F.min(more), F.max(more)).alias("more"), F.array(F.min(less), F.max(less)).alias("less"))
    picks = picks.join(left, F.col("source").eqNullSafe(F.col("_s")))
    one_of = F.explode(F.when(F.col("gap") > 0, F.col("more")).otherwise(F.col("less"))).alias("d")
    ranked = picks.select("source", "gap", one_of).where("d IS NOT NULL").groupBy("source").agg(
        F.first("gap").alias("gap"), F.sort_array(F.collect_set(F.struct(F.col("d.size").alias("size"), F.col("d.tie").alias("tie"),
                                                                        F.col("d.uid").alias("uid"))), asc=False).alias("ds"))
    start = F.struct(F.abs("gap").alias("left"), F.array().cast("array<bigint>").alias("uids"))
    chosen = F.aggregate("ds", start, lambda a, d: F.when(
        d["size"] <= a["left"], F.struct((a["left"] - d["size"]).alias("left"), F.array_append(a["uids"], d["uid"]).alias("uids")))
        .otherwise(a))
    return ranked.select(F.explode(chosen["uids"]).alias("uid"), F.signum("gap").cast("int").alias("change"))


def mix(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: int = 2) -> DataFrame:
    """One row per document: doc_id, tie (hash of id and text), source, size,
    source_size, target, rate, copies and taken = size * copies."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"))
    sized = materialise(rows, "mix-rows")
    targets = materialise(source_targets(sized, weights, share, cap).coalesce(1), "mix-targets")
    tilts = solve_tilts(sized, targets, cap)
    both = targets.join(tilts.select(F.col("source").alias("_t"), "scale", "tilt"), F.col("source").eqNullSafe(F.col("_t")), "left")
    both = both.select(F.col("source").alias("_s"), "source_size", "target", "scale", "tilt")
    rate = F.when(F.col("size") > 0, F.least(F.lit(float(cap)), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("scale"), F.lit(50.0)))))
    rated = sized.join(both, F.col("source").eqNullSafe(F.col("_s"))).withColumn(
        "rate", F.round(F.coalesce(rate, F.lit(1.0)) * _UNIT).cast("long")).drop("_s", "scale", "tilt")
    run = _running_rates(rated)
    due = lambda c: F.expr(f"({c} + {_UNIT // 2}) div {_UNIT}")
    mixed = materialise(run.withColumn("copies", F.when(F.col("size") == 0, 1).otherwise(
        due("before + rate") - due("before")).cast("int")).drop("before"), "mix-copies")
    fixes = _corrections(mixed, targets, cap).withColumnRenamed("uid", "_u")
    copies = F.col("copies") + F.coalesce(F.col("change"), F.lit(0))
    return mixed.join(fixes, F.col("uid") == F.col("_u"), "left").select(
        "doc_id", "tie", "source", "size", "source_size", "target", (F.col("rate") / _UNIT).alias("rate"),
        copies.alias("copies"), (F.col("size") * copies).alias("taken"))
