from pyspark.sql import functions as F

from stellate.operators.lookups import Lookup, bounded_broadcast, lookup_keys, measured_bytes
from stellate.plans.warehouse import fact_with_keys


def _dims(spark):
    cu = spark.createDataFrame([("C1", "US", 1), ("C2", "XX", 2), ("C3", "US", 3), ("C3", "OM", 4)],
                               "customer_id string, country_code string, customer_key long")
    pr = spark.createDataFrame([("P1", 10)], "product_id string, product_key long")
    co = spark.createDataFrame([("US", 100), ("OM", 200)], "country_code string, country_key long")
    return cu, pr, co


def test_left_lookup_semantics(spark):
    cu, pr, co = _dims(spark)
    sales = spark.createDataFrame([("T1", "C1", "P1"), ("T2", "C9", "P1"), ("T3", "C2", "P9"),
                                   ("T4", None, None), ("T5", "C3", "P1")],
                                  "transaction_id string, customer_id string, product_id string")
    out = {(r.transaction_id, r.customer_key): r for r in fact_with_keys(sales, cu, pr, co).collect()}
    assert len(out) == 6                                    # C3 is duplicated in the dimension: T5 twice
    assert out[("T1", 1)].country_key == 100 and out[("T1", 1)].product_key == 10
    t2 = out[("T2", None)]
    assert t2.product_key == 10 and t2.country_key is None  # unknown customer: row kept, keys NULL
    t3 = out[("T3", 2)]
    assert t3.product_key is None and t3.country_key is None  # country XX not in dimension
    assert out[("T4", None)].product_key is None
    assert {out[("T5", 3)].country_key, out[("T5", 4)].country_key} == {100, 200}


def test_broadcast_only_when_measured_small(spark):
    dim = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit("abcdefghij").alias("s"))
    rows, size = measured_bytes(dim)
    assert rows == 1000 and size >= 1000 * 10
    small = bounded_broadcast(dim, max_bytes=10 * 1024 * 1024)
    big = bounded_broadcast(dim, max_bytes=1024)
    fact = spark.range(0, 10).select(F.col("id").alias("k"))
    with_hint = fact.join(small, "k")._jdf.queryExecution().logical().toString()
    without = fact.join(big, "k")._jdf.queryExecution().logical().toString()
    assert "broadcast" in with_hint.lower() and "broadcast" not in without.lower()


def test_lookup_keys_generic(spark):
    fact = spark.createDataFrame([("a",), ("b",)], "x string")
    dim = spark.createDataFrame([("a", 1)], "x string, xk long")
    out = lookup_keys(fact, [Lookup(dim, "x", "x", "xk")]).orderBy("x").collect()
    assert [(r.x, r.xk) for r in out] == [("a", 1), ("b", None)]


def test_large_estimate_is_not_measured(spark):
    from stellate.operators.lookups import estimated_bytes, is_bounded
    big = spark.range(0, 10_000_000).select(F.col("id").alias("k"))
    assert estimated_bytes(big) > 8 * 1024
    # rejected from the estimate alone: no 10M-row scan happens
    assert is_bounded(big, max_bytes=1024) is False


def test_keyed_dimensions_are_broadcast(spark):
    from stellate.operators.keys import assign_dense_keys
    dim, _ = assign_dense_keys(spark.createDataFrame([("a",), ("b",)], "x string"), "xk", order_by=["x"])
    fact = spark.range(100).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("x"))
    plan = lookup_keys(fact, [Lookup(dim, "x", "x", "xk")])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_batched_broadcast_decisions(spark):
    from stellate.operators.lookups import bounded_broadcast_many
    small = spark.createDataFrame([(1, "a")], "k long, s string")
    large = spark.createDataFrame([(i, "x" * 100) for i in range(200)], "k long, s string")
    out = bounded_broadcast_many([small, large], max_bytes=2000)
    hinted = ["broadcast" in d._jdf.queryExecution().logical().toString().lower() for d in out]
    assert hinted == [True, False]
    assert bounded_broadcast_many([]) == []


def test_the_tables_of_a_query_share_the_limit(spark):
    from stellate.operators.checks import fk_violation_counts
    from stellate.operators.lookups import bounded_many
    dims = [spark.range(0, n).select(F.col("id").alias("k"), F.lit("x" * 20).alias("s")) for n in (300, 150, 200)]
    sizes = [measured_bytes(d)[1] for d in dims]
    assert bounded_many(dims, sizes[0]) == [False, True, False]  # each is under it, no two together are
    assert bounded_many(dims, sizes[1] + sizes[2]) == [False, True, True]
    assert bounded_many(dims, sum(sizes)) == [True, True, True]
    fact = spark.range(0, 400).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("a"), F.col("id").alias("b"))
    refs = [("a", dims[0], "k"), ("b", dims[1], "k")]
    found = [fk_violation_counts(fact, refs, limit, unique_keys=unique) for limit in (None, 1, 4000) for unique in (True, False)]
    assert all(f == {"a": 90, "b": 250} for f in found)


def test_the_default_limit_is_a_share_of_the_drivers_heap(spark):
    from stellate.operators import lookups
    heap = spark._jvm.Runtime.getRuntime().maxMemory()
    limit = lookups._broadcast_limit(spark.range(1), None)
    assert limit == min(lookups.DEFAULT_BROADCAST_BYTES, heap // 24)
    spark.conf.set("stellate.broadcast.maxBytes", "123")
    try:
        assert lookups._broadcast_limit(spark.range(1), None) == 123
    finally:
        spark.conf.unset("stellate.broadcast.maxBytes")
    assert lookups._broadcast_limit(spark.range(1), 7) == 7
