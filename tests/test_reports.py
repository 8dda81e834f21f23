from decimal import Decimal

from pyspark.sql import functions as F

from stellate.plans import reports as R


def _customers(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, customer_name string, country_code string")


def _fact(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, customer_id string, product_id string, total_amount string")


def test_same_names_merged_and_above_average(spark):
    cu = _customers(spark, [("1", "Ann", "US"), ("2", "Ann", "US"), ("3", "Bob", "OM"), ("4", "Cy", "OM")])
    fact = _fact(spark, [("t1", "1", "p", "10.00"), ("t2", "2", "p", "5.00"), ("t3", "3", "p", "1.00"),
                         ("t4", "9", "p", "100.00")])        # t4: no customer, dropped by the inner join
    totals = {r[0]: r[1] for r in R.sales_by_customer(cu, fact).collect()}
    assert totals == {"Ann": Decimal("15.00"), "Bob": Decimal("1.00")}
    above = [tuple(r) for r in R.above_average_customers(cu, fact).collect()]
    assert above == [("Ann", Decimal("15.00"))]


def test_all_equal_gives_nobody_above_average(spark):
    cu = _customers(spark, [("1", "A", "x"), ("2", "B", "x")])
    fact = _fact(spark, [("t1", "1", "p", "3.00"), ("t2", "2", "p", "3.00")])
    assert R.above_average_customers(cu, fact).count() == 0


def test_top_product_null_first_and_tie_by_name(spark):
    pr = spark.createDataFrame([("p1", "Zeta"), ("p2", "Alpha"), ("p3", "Nil")], "product_id string, product_name string")
    fact = _fact(spark, [("t1", "c", "p1", "5.00"), ("t2", "c", "p2", "5.00")])
    assert [tuple(r) for r in R.top_products(pr, fact).collect()] == [("Alpha", Decimal("5.00"))]
    fact_null = fact.unionByName(_fact(spark, [("t3", "c", "p3", None)]))
    assert [tuple(r) for r in R.top_products(pr, fact_null).collect()] == [("Nil", None)]


def test_sales_by_country_desc(spark):
    cu = _customers(spark, [("1", "A", "US"), ("2", "B", "OM")])
    fact = _fact(spark, [("t1", "1", "p", "1.00"), ("t2", "2", "p", "2.50"), ("t3", "2", "p", "0.50")])
    assert [tuple(r) for r in R.sales_by_country(cu, fact).collect()] == [("OM", Decimal("3.00")), ("US", Decimal("1.00"))]


def test_frequent_buyers_threshold_and_null_ids(spark):
    cu = _customers(spark, [("1", "Five", "x"), ("2", "Six", "x")])
    rows = [(f"a{i}", "1", "p", "1") for i in range(5)] + [(f"b{i}", "2", "p", "1") for i in range(6)]
    rows += [(None, "1", "p", "1")]                   # NULL transaction id is not counted
    out = [tuple(r) for r in R.frequent_buyers(cu, _fact(spark, rows)).collect()]
    assert out == [("Six", 6)]


def test_report_line_format(spark):
    df = spark.createDataFrame([("Customer_1", Decimal("2.675")), ("A very long customer name", Decimal("1234.5"))],
                               "n string, v decimal(18,3)")
    lines = [r.line for r in R.report_lines(df).collect()]
    assert lines[0] == f"{'Customer_1':<15} {'2.68':>10}"
    assert lines[1] == "A very long customer name    1234.50"


def test_bad_amount_fails_with_sqlstate(spark):
    import pytest
    from stellate.plans.audit import sqlstate_of
    cu = _customers(spark, [("1", "A", "x")])
    fact = _fact(spark, [("t1", "1", "p", "1,200")])
    with pytest.raises(Exception) as e:
        R.sales_by_customer(cu, fact).collect()
    assert sqlstate_of(e.value) == "22018"


def test_hot_customer_is_pre_aggregated_before_the_shuffle(spark):
    from pyspark.sql import functions as F
    n = 30000
    fact = spark.range(n).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("customer_id"),
        F.lit("1.00").alias("total_amount"))
    cu = spark.range(997).select(F.col("id").cast("string").alias("customer_id"),
                                 F.concat(F.lit("c"), F.col("id")).alias("customer_name"),
                                 F.lit("US").alias("country_code"))
    cu = cu.unionByName(spark.createDataFrame([("hot", "Hot", "OM")], cu.schema))
    df = R.sales_by_customer(cu, fact)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # partial aggregate per customer runs before the first shuffle of the fact
    first_exchange = plan.rfind("Exchange hashpartitioning(customer_id")
    assert first_exchange >= 0 and "partial_sum" in plan[first_exchange:]
    got = {r[0]: r[1] for r in df.collect()}
    assert got["Hot"] == Decimal(n // 3) and sum(got.values()) == Decimal(n)


def test_strict_cast_without_ansi(spark):
    import pytest
    from stellate.functions.casts import strict_decimal
    df = spark.createDataFrame([("1.5",), (None,), ("abc",)], "x string")
    with pytest.raises(Exception):
        df.select(strict_decimal("x", ansi=False)).collect()
    ok = spark.createDataFrame([("1.5",), (None,)], "x string").select(strict_decimal("x", ansi=False).alias("d"))
    assert [r.d for r in ok.collect()] == [Decimal("1.500000"), None]


def test_strict_cast_follows_session_ansi(spark):
    import pytest
    from stellate.functions.casts import strict_decimal
    df = spark.createDataFrame([("1.5",), ("abc",)], "x string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            df.select(strict_decimal("x").alias("d")).collect()
        good = spark.createDataFrame([("2.25",)], "x string").select(strict_decimal("x").alias("d"))
        assert good.collect()[0].d == Decimal("2.250000")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
