from pyspark.sql import functions as F

from stellate.operators.keys import assign_dense_keys, is_shuffle_free


def test_ordered_keys_equal_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("bk"), F.lit("x").alias("v")).repartition(7)
    keyed, high = assign_dense_keys(df, "k", order_by=["bk"])
    rows = keyed.orderBy("bk").select("bk", "k").collect()
    assert high == 5000
    assert [r.k for r in rows] == list(range(1, 5001))


def test_input_order_keys_dense_unique_and_continue(spark):
    df = spark.range(0, 3000, numPartitions=5).select(F.col("id").alias("v"))
    assert is_shuffle_free(df)
    keyed, high = assign_dense_keys(df, "k", start=100)
    ks = sorted(r.k for r in keyed.collect())
    assert ks == list(range(101, 3101)) and high == 3100
    # recomputation gives the same assignment (no materialisation needed)
    assert sorted(map(tuple, keyed.collect())) == sorted(map(tuple, keyed.collect()))


def test_shuffled_input_is_materialised(spark):
    df = spark.range(0, 1000).groupBy((F.col("id") % 37).alias("g")).count()
    assert not is_shuffle_free(df)
    keyed, high = assign_dense_keys(df, "k")
    assert high == 37 and sorted(r.k for r in keyed.collect()) == list(range(1, 38))


def test_hot_business_key_is_split(spark):
    # one key holds a third of all rows: the hash tie-break spreads it
    hot = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("bk"),
                                      F.col("id").alias("v"))
    keyed, high = assign_dense_keys(hot, "k", order_by=["bk"])
    assert high == 3000
    assert keyed.select("k").distinct().count() == 3000


def test_empty_input(spark):
    keyed, high = assign_dense_keys(spark.range(0).select(F.col("id").alias("v")), "k", start=9)
    assert high == 9 and keyed.count() == 0


def test_recommended_conf_scales():
    from stellate.session import recommended_conf
    small = recommended_conf(100 << 20, 8)
    big = recommended_conf(100 << 40, 8000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(big["spark.sql.shuffle.partitions"]) == 409600


def test_single_partition_input_sorted_in_place(spark):
    from stellate.operators.keys import _single_partition
    df = spark.createDataFrame([(v, str(v)) for v in [5, 3, 9, 1, 7, 3]], "bk long, s string").coalesce(1)
    assert _single_partition(df)
    keyed, high = assign_dense_keys(df, "k", order_by=["bk"])
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort" in plan
    assert [r.bk for r in keyed.orderBy("k").collect()] == [1, 3, 3, 5, 7, 9] and high == 6
