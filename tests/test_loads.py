import pytest
from pyspark.sql import functions as F

from stellate.plans.audit import ERROR_LOG, create_error_log, log_error, run_logged, sqlstate_of
from stellate.plans.jobs import JOBS, run_group, run_job
from stellate.plans.loads import full_load, merge_load, truncate
from stellate.plans.star import build_star
from stellate.plans.warehouse import COUNTRY, CUSTOMER, PRODUCT, SALES
from stellate.sources.staging import load_report, select_resources, stage
from stellate.sources.store import TableNotFound


def _stage_sample(spark, store, sales_extra=()):
    stage(store, "country", spark.createDataFrame([("US", "United States", "North America"), ("OM", "Oman", "Middle East")],
                                                  "country_code string, country_name string, region string"))
    stage(store, "customer", spark.createDataFrame(
        [("C1", "Ann", "US", "RETAIL"), ("C2", "Bob", "OM", "CORPORATE"), ("C3", "Cy", "XX", "RETAIL")],
        "customer_id string, customer_name string, country_code string, customer_type string"))
    stage(store, "product", spark.createDataFrame([("P1", "Pen", "Retail", "3"), ("P2", "Cup", "Retail", "5")],
                                                  "product_id string, product_name string, category string, standard_price string"))
    rows = [("T1", "2024-01-01", "C1", "P1", "1", "3", "3.00", "CARD"),
            ("T2", "2024-01-02", "C2", "P2", "2", "5", "10.00", "CASH"),
            ("T3", "2024-01-03", "C9", "P1", "1", "3", "3.00", "CARD"),
            ("T4", "2024-01-04", "C3", "P2", "1", "5", "5.00", "CARD")] + list(sales_extra)
    stage(store, "sales_transactions", spark.createDataFrame(
        rows, "transaction_id string, transaction_date string, customer_id string, product_id string, "
              "quantity string, unit_price string, total_amount string, payment_mode string"))


def test_star_build(spark, store):
    _stage_sample(spark, store)
    counts = build_star(store)
    assert counts == {"countries_dim": 2, "customers_dim": 3, "products_dim": 2, "sales_transactions_fact": 4}
    fact = {r.transaction_id: r for r in store.read(SALES.qualified).collect()}
    assert fact["T3"].customer_key is None and fact["T3"].country_key is None and fact["T3"].product_key == 1
    assert fact["T4"].customer_key == 3 and fact["T4"].country_key is None   # orphan country code
    assert sorted(r.sales_trans_key for r in fact.values()) == [1, 2, 3, 4]
    assert sorted(r.customer_key for r in store.read(CUSTOMER.qualified).collect()) == [1, 2, 3]
    # rebuilding is repeatable and restarts keys
    build_star(store)
    assert sorted(r.customer_key for r in store.read(CUSTOMER.qualified).collect()) == [1, 2, 3]


def test_full_load_twice_continues_keys(spark, store):
    _stage_sample(spark, store)
    full_load(store, PRODUCT)
    first = {r.product_id: r.product_key for r in store.read(PRODUCT.qualified).collect()}
    truncate(store, PRODUCT)
    assert store.read(PRODUCT.qualified).count() == 0
    full_load(store, PRODUCT)
    second = {r.product_id: r.product_key for r in store.read(PRODUCT.qualified).collect()}
    assert first == {"P1": 1, "P2": 2} and second == {"P1": 3, "P2": 4}


def test_merge_dimension_and_fact(spark, store):
    _stage_sample(spark, store)
    build_star(store)
    stage(store, "customer", spark.createDataFrame([("C1", "Ann B", "OM", "RETAIL"), ("C4", "Dee", "US", "RETAIL")],
                                                   "customer_id string, customer_name string, country_code string, customer_type string"))
    assert merge_load(store, CUSTOMER) == 1
    dim = {r.customer_id: (r.customer_name, r.customer_key) for r in store.read(CUSTOMER.qualified).collect()}
    assert dim == {"C1": ("Ann B", 1), "C2": ("Bob", 2), "C3": ("Cy", 3), "C4": ("Dee", 4)}
    stage(store, "sales_transactions", spark.createDataFrame(
        [("T1", "2024-02-01", "C4", "P1", "1", "3", "9.00", "CARD")],
        "transaction_id string, transaction_date string, customer_id string, product_id string, "
        "quantity string, unit_price string, total_amount string, payment_mode string"))
    merge_load(store, SALES)
    t1 = [r for r in store.read(SALES.qualified).collect() if r.transaction_id == "T1"]
    assert len(t1) == 1 and t1[0].customer_key == 4 and t1[0].total_amount == "9.00"


def test_failed_job_logs_once_and_leaves_tables(spark, store):
    _stage_sample(spark, store, sales_extra=[("T5", "2024-01-05", "C1", "P1", "1", "3", "abc", "CARD")])
    build_star(store)
    before = store.version()
    create_error_log(store)

    def bad_report():
        fact = store.read(SALES.qualified)
        fact.select(F.col("total_amount").cast("decimal(18,2)")).write.format("noop").mode("overwrite").save()
        store.replace(SALES.qualified, fact)          # never reached

    with pytest.raises(Exception) as e:
        run_logged(store, "report.TOTALS", bad_report)
    assert sqlstate_of(e.value) == "22018"
    log = store.read(ERROR_LOG).collect()
    assert len(log) == 1 and log[0].procedure_name == "report.TOTALS" and log[0].error_code == "22018"
    assert log[0].logged_at is not None
    assert store.read(SALES.qualified).count() == 5
    assert store.version() > before


def test_job_registry(spark, store):
    assert len(JOBS) == 8
    with pytest.raises(TableNotFound):
        run_job(store, "fullload.LOAD_SALES_TRANSACTIONS_FACT")
    log = store.read(ERROR_LOG).collect()
    assert [(r.procedure_name, r.error_code) for r in log] == [("fullload.LOAD_SALES_TRANSACTIONS_FACT", "42P01")]
    _stage_sample(spark, store)
    build_star(store)
    out = run_group(store, "fullload")
    assert out["fullload.LOAD_COUNTRY_DIM"] == 2 and out["fullload.LOAD_SALES_TRANSACTIONS_FACT"] == 4
    keys = sorted(r.customer_key for r in store.read(CUSTOMER.qualified).collect())
    assert keys == [4, 5, 6]
    fact_keys = {r.transaction_id: r.customer_key for r in store.read(SALES.qualified).collect()}
    assert fact_keys["T1"] == 4          # the fact follows the renewed dimension keys
    assert run_group(store, "merge_load")["merge_load.MERGE_COUNTRY_DIM"] == 0


def test_log_error_requires_name(store):
    with pytest.raises(Exception):
        log_error(store, "", "x", "y")


def test_load_report_and_resource_choice(spark, store):
    _stage_sample(spark, store)
    rep = {r.table_name: r.row_count for r in load_report(store, ["country", "customer"]).collect()}
    assert rep == {"country": 2, "customer": 3}
    called = []
    builders = {"a": lambda: called.append("a"), "b": lambda: called.append("b"), "c": lambda: called.append("c")}
    chosen = select_resources(builders, ["b"])
    assert list(chosen) == ["b"] and called == []
    assert list(select_resources(builders, deselected=["a"])) == ["b", "c"]


def test_staging_lineage(spark, store):
    info, _ = stage(store, "customer", spark.createDataFrame([("a",), ("a",)], "x string"))
    df = store.read("staging.customer")
    assert info.rows == 2 and df.select("_row_id").distinct().count() == 2
    assert df.select("_load_id").distinct().collect()[0][0] == info.load_id


def test_sql_over_published_star(spark, store):
    _stage_sample(spark, store)
    build_star(store)
    assert "customers_dim" in store.register_views(("dwh",))
    got = spark.sql("""
        SELECT c.customer_name AS `Customer Name`, SUM(CAST(s.total_amount AS DECIMAL(28,6))) AS `Total Sales`
        FROM customers_dim c JOIN sales_transactions_fact s ON c.customer_id = s.customer_id
        GROUP BY c.customer_name""").collect()
    assert {r[0]: float(r[1]) for r in got} == {"Ann": 3.0, "Bob": 10.0, "Cy": 5.0}


def test_star_build_with_repeated_dimension_key_falls_back(spark, store):
    _stage_sample(spark, store)
    dup = spark.createDataFrame([("C1", "Ann again", "US", "RETAIL")],
                                "customer_id string, customer_name string, country_code string, customer_type string")
    stage(store, "customer", dup, disposition="append")
    counts = build_star(store)
    fact = store.read(SALES.qualified).collect()
    assert counts["sales_transactions_fact"] == 5 and len(fact) == 5           # T1 matches two customers
    assert sorted(r.sales_trans_key for r in fact) == [1, 2, 3, 4, 5]


def test_fact_keys_do_not_depend_on_the_join(spark, store):
    from stellate.plans.loads import write_fact_with_keys
    from stellate.plans.warehouse import SALES, fact_with_keys
    sales = spark.range(0, 300, numPartitions=5).selectExpr("cast(id as string) AS transaction_id", "concat('C', id % 7) AS customer_id",
                                                            "concat('P', id % 3) AS product_id")
    cu = spark.createDataFrame([(f"C{i}", "US", i) for i in range(6)], "customer_id string, country_code string, customer_key long")
    pr = spark.createDataFrame([(f"P{i}", i) for i in range(3)], "product_id string, product_key long")
    co = spark.createDataFrame([("US", 1)], "country_code string, country_key long")

    def keys(broadcast_bytes):
        ch, high = write_fact_with_keys(store, sales, lambda rows: fact_with_keys(rows, cu, pr, co, broadcast_bytes), 10)
        assert high == 310
        return {r["transaction_id"]: r[SALES.key_column] for r in store.read_version(ch).collect()}

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert keys(1) == keys(None)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partition_scoped_merge(spark, store):
    from stellate.plans.loads import fact_source
    from stellate.plans.partitioned import merge_partitioned, month_of, publish_partitioned
    _stage_sample(spark, store, sales_extra=[("T5", "2024-03-05", "C1", "P1", "1", "3", "7.00", "CARD")])
    build_star(store)
    publish_partitioned(store, SALES.qualified, store.read(SALES.qualified), month_of())
    before = store.partitions(SALES.qualified)
    assert sorted(before) == ["2024-01", "2024-03"]
    keys_before = {r.transaction_id: r.sales_trans_key for r in store.read(SALES.qualified).collect()}
    # T2 moves from January to February, T9 is new in February; March is untouched
    stage(store, "sales_transactions", spark.createDataFrame(
        [("T2", "2024-02-10", "C2", "P2", "2", "5", "11.00", "CASH"),
         ("T9", "2024-02-11", "C1", "P1", "1", "3", "3.00", "CARD")],
        "transaction_id string, transaction_date string, customer_id string, product_id string, "
        "quantity string, unit_price string, total_amount string, payment_mode string"))
    inserted, touched = merge_partitioned(store, SALES, fact_source(store), month_of())
    assert inserted == 1 and touched == ["2024-01", "2024-02"]
    after = store.partitions(SALES.qualified)
    assert after["2024-03"] == before["2024-03"]                  # untouched files kept by reference
    rows = {r.transaction_id: r for r in store.read(SALES.qualified).collect()}
    assert len(rows) == 6 and rows["T2"].transaction_date == "2024-02-10" and rows["T2"].total_amount == "11.00"
    assert rows["T2"].sales_trans_key == keys_before["T2"] and rows["T9"].sales_trans_key == 6
    feb = store.read_partitions(SALES.qualified, ["2024-02"]).collect()
    assert sorted(r.transaction_id for r in feb) == ["T2", "T9"]


def test_partition_guards(spark, store):
    from stellate.plans.loads import fact_source
    from stellate.plans.partitioned import merge_partitioned, month_of, publish_partitioned
    _stage_sample(spark, store)
    build_star(store)
    src = store.read("staging.sales_transactions")
    with pytest.raises(ValueError):
        merge_partitioned(store, SALES, src, month_of())        # plain table: would lose matches
    publish_partitioned(store, SALES.qualified, store.read(SALES.qualified), month_of())
    assert merge_partitioned(store, SALES, fact_source(store), month_of()) == (0, [])   # nothing differs
    touched = merge_partitioned(store, SALES, fact_source(store).withColumn("payment_mode", F.lit("WIRE")), month_of())[1]
    assert touched == sorted(store.partitions(SALES.qualified))
