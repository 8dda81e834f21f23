"""One callable per operator of the inventory: ``(spark, sf_dir) -> DataFrame``.

Each query reads the supplied tables whole (or data Spark derives from
them), runs the operator through the library, and returns a DataFrame with
the columns of its SQL twin in ``stellate.oracle``. Queries that exercise
loads write to a fresh table store in the shared scratch folder. Lineage ids
and check times are random, so they are projected away or counted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from stellate import standins as si
from stellate.functions.casts import strict_decimal
from stellate.functions.columns import flatten, normalize_names
from stellate.functions.months import bad_month_rows, month_of_url, month_range_filter
from stellate.operators.checks import (fk_violations, merge_cardinality_violations, null_counts,
                                       pk_violations)
from stellate.operators.keys import assign_dense_keys
from stellate.operators.nested import child_rows, explode_list
from stellate.plans import reports as R
from stellate.plans.audit import create_error_log, error_summary, run_logged, sqlstate_of
from stellate.plans.loads import fact_source, full_load, merge_load, truncate, write_fact_with_keys
from stellate.plans.partitioned import merge_partitioned, month_of, publish_partitioned
from stellate.plans.jobs import merge_sales_by_month, run_group, run_warehouse
from stellate.plans.star import build_star
from stellate.plans.warehouse import COUNTRY, CUSTOMER, PRODUCT, SALES, fact_with_keys
from stellate.session import new_scratch_dir
from stellate.sources import json_ingest as J
from stellate.sources.csv import read_csv, source_path, write_csv
from stellate.sources.staging import load_report as staged_load_report
from stellate.sources.staging import stage, stage_csv_dir
from stellate.sources.store import StaleBase, TableStore
from stellate.streaming import ingest_new_files

LINEAGE = ["_load_id", "_row_id"]

# Slices of the test tables used as "earlier" and "later" loads (data
# attributes, every row belongs to at least one slice).
OLD_PRODUCT_MAX_SIZE = 25
MERGE_TARGET_MAX_SIZE = 35
MERGE_SOURCE_MIN_SIZE = 15
ORPHAN_SEGMENT = "BUILDING"          # customers left out of the dimension
SALES_A_BEFORE = "1998-01-01"        # fact target: sales before this date
SALES_B_FROM = "1997-01-01"          # fact source: sales from this date
RUN1 = ("1997/01", "1997/03")        # narrow archive run
RUN2 = ("1997/01", "1997/06")        # wider archive run
MISSING_MONTH = "1997/03"            # archives of this month answer 404
GAMES_PER_RECORD = 1024              # bound on games in one landed record
TURNS_PER_RECORD = 256               # bound on messages in one landed record
TRACKED_SEGMENT = "AUTOMOBILE"


# ---------------------------------------------------------------- reports
def report_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts with more than two decimals keep them in the totals."""
    t = si.tables(spark, sf_dir)
    exact = si.report_orders(t).withColumn("total_amount", (F.col("total_amount").cast("decimal(18,2)") / 1000).cast("decimal(18,5)").cast("string"))
    return R.sales_by_customer(si.report_customers(t), exact)


def above_average_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = si.tables(spark, sf_dir)
    return R.above_average_customers(si.report_customers(t), si.report_orders(t), scale=2)


def sales_by_customer(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    return R.sales_by_customer(si.report_customers(t), si.report_orders(t), scale=2)


def top_product(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    return R.top_products(si.report_products(t), si.report_lines_fact(t), k=1, scale=2)


def sales_by_country(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    return R.sales_by_country(si.report_customers(t), si.report_orders(t), scale=2)


def frequent_buyers(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    return R.frequent_buyers(si.report_customers(t), si.report_orders(t))


def report_lines(spark, sf_dir):
    return R.report_lines(above_average_customers(spark, sf_dir))


def strict_cast(spark, sf_dir):
    o = si.tables(spark, sf_dir)("orders")
    as_text = o.select("o_orderkey", si.amount_text("o_totalprice").alias("total_amount"))
    return as_text.select("o_orderkey", strict_decimal("total_amount", DecimalType(18, 2)).alias("amount"))


# ---------------------------------------------------------------- staging
def csv_scan(spark, sf_dir):
    docs = si.tables(spark, sf_dir)("documents")
    path = new_scratch_dir(spark, "csv")
    write_csv(docs.select(*[F.col(c).cast("string").alias(c) for c in docs.columns]), path)
    return read_csv(spark, path, complete_rows=True, multi_line=True)


def csv_short_rows(spark, sf_dir):
    """Lines of customers in debt lack the last field; an empty segment stays an empty text."""
    c = si.tables(spark, sf_dir)("customer")
    segment = F.when(F.col("c_mktsegment") == ORPHAN_SEGMENT, "").otherwise(F.col("c_mktsegment"))
    body = c.select(F.concat_ws(",", F.col("c_custkey").cast("string"), F.when(F.col("c_acctbal") >= 0, segment),
                                ).alias("c_custkey,segment"))
    path = new_scratch_dir(spark, "csv-short")
    body.write.options(header="true", sep="\u0001").csv(path)   # lines as they are, a header in every file
    return read_csv(spark, path, multi_line=False)


def _store(spark, tag):
    return TableStore.scratch(spark, tag)


def staging_replace(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    store = _store(spark, "replace")
    first = si.customer(t).withColumn("customer_name", F.upper("customer_name"))
    stage(store, "customer", first, disposition="replace")
    stage(store, "customer", si.customer(t), disposition="replace")
    return store.read("staging.customer").drop(*LINEAGE)


def staging_append(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    store = _store(spark, "append")
    a = si.customer(t)
    b = si.customer(t).withColumn("customer_name", F.lower("customer_name"))
    stage(store, "customer", a, disposition="replace")
    stage(store, "customer", a, disposition="append")
    stage(store, "customer", b, disposition="append")
    return store.read("staging.customer").drop(*LINEAGE)


def lineage_columns(spark, sf_dir):
    store = _store(spark, "lineage")
    stage(store, "customer", si.customer(si.tables(spark, sf_dir)))
    return store.read("staging.customer").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("_row_id").alias("n_row_ids"),
        F.count_distinct("_load_id").alias("n_load_ids"))


def load_report(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    store = _store(spark, "report")
    for name, df in (("customer", si.customer(t)), ("product", si.product(t)), ("country", si.country(t))):
        stage(store, name, df)
    return staged_load_report(store, ["customer", "product", "country"]).drop("load_id")


# ---------------------------------------------------------------- keys, star
def _keyed(df, spec):
    return assign_dense_keys(df, spec.key_column, order_by=spec.key_order)[0]


def _key_check(df, key):
    """Fact keys follow input order (no promised order), so the key column is
    replaced by what is promised: the first key and that keys are dense and
    unique over the table."""
    n = F.count(F.lit(1))
    stats = df.agg(F.struct(F.min(key).alias("first"),
                            ((F.max(key) - F.min(key) + 1 == n) & (F.count_distinct(key) == n)).alias("dense"))
                   ).scalar()   # one subquery, reused for both columns
    return df.drop(key).select("*", stats.getField("first").alias("first_key"),
                               stats.getField("dense").alias("keys_dense"))


def _lookup_dims(t):
    customers = _keyed(si.customer(t).filter(F.col("customer_type") != ORPHAN_SEGMENT), CUSTOMER)
    products = _keyed(si.product(t), PRODUCT)
    countries = _keyed(si.country(t).filter(F.col("region") != "ASIA"), COUNTRY)
    return customers, products, countries


def dim_surrogate_key(spark, sf_dir):
    return _keyed(si.customer(si.tables(spark, sf_dir)), CUSTOMER)


def fact_lookup(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    customers, products, countries = _lookup_dims(t)
    sales = si.sales(t)
    store = _store(spark, "lookup")
    written = store.read_version(write_fact_with_keys(
        store, sales, lambda rows: fact_with_keys(rows, customers, products, countries), 0)[0])
    return _key_check(written, SALES.key_column)


def key_continuation(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    store = _store(spark, "keycont")
    parts = si.product(t, with_size=True)
    stage(store, "product", parts.filter(F.col("p_size") <= OLD_PRODUCT_MAX_SIZE).drop("p_size"))
    full_load(store, PRODUCT)
    stage(store, "product", parts.filter(F.col("p_size") > OLD_PRODUCT_MAX_SIZE).drop("p_size"))
    merge_load(store, PRODUCT)
    return store.read(PRODUCT.qualified).drop(*LINEAGE)


def rebuild_table(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    store = _store(spark, "rebuild")
    first = si.customer(t).withColumn("customer_type", F.lower("customer_type"))
    for df in (first, si.customer(t)):
        store.replace(CUSTOMER.qualified, _keyed(df, CUSTOMER))
    return store.read(CUSTOMER.qualified)


def pk_violations_q(spark, sf_dir):
    return pk_violations(si.tables(spark, sf_dir)("lineitem"), ["l_orderkey", "l_linenumber"])


def fk_violations_q(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    dim = t("customer").filter(F.col("c_mktsegment") != ORPHAN_SEGMENT)
    return fk_violations(t("orders"), "o_custkey", dim, "c_custkey").select("o_orderkey", "o_custkey")


def required_columns(spark, sf_dir):
    o = si.tables(spark, sf_dir)("orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("o_orderstatus"))
    return null_counts(o, ["o_orderkey", "o_custkey", "o_orderstatus"])


# ---------------------------------------------------------------- loads
def full_load_dim(spark, sf_dir):
    store = _store(spark, "fullload")
    stage(store, "product", si.product(si.tables(spark, sf_dir)))
    full_load(store, PRODUCT)
    full_load(store, PRODUCT)     # the sequence continues after a truncate
    return store.read(PRODUCT.qualified).drop(*LINEAGE)


def _star_store(spark, t, tag, sales_df=None):
    store = _store(spark, tag)
    stage(store, "country", si.country(t).filter(F.col("region") != "ASIA"))
    stage(store, "customer", si.customer(t).filter(F.col("customer_type") != ORPHAN_SEGMENT))
    stage(store, "product", si.product(t))
    stage(store, "sales_transactions", si.sales(t) if sales_df is None else sales_df)
    return store


def full_load_fact(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    store = _star_store(spark, t, "fullfact")
    build_star(store, verify=False)
    run_group(store, "fullload")
    return _key_check(store.read(SALES.qualified).drop(*LINEAGE), SALES.key_column)


def truncate_table(spark, sf_dir):
    store = _store(spark, "truncate")
    stage(store, "customer", si.customer(si.tables(spark, sf_dir)))
    full_load(store, CUSTOMER)
    truncate(store, CUSTOMER)
    return store.read(CUSTOMER.qualified).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(CUSTOMER.qualified).alias("table_name"), "row_count")


def merge_dim(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    store = _store(spark, "mergedim")
    parts = si.product(t, with_size=True)
    stage(store, "product", parts.filter(F.col("p_size") <= MERGE_TARGET_MAX_SIZE).drop("p_size"))
    full_load(store, PRODUCT)
    changed = parts.filter(F.col("p_size") >= MERGE_SOURCE_MIN_SIZE).select(
        "product_id", F.upper("product_name").alias("product_name"), "category",
        (F.col("standard_price").cast("decimal(18,2)") + 1).cast("decimal(18,2)").cast("string").alias("standard_price"))
    stage(store, "product", changed)
    merge_load(store, PRODUCT)
    return store.read(PRODUCT.qualified).drop(*LINEAGE)


def merge_fact(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    s = si.sales(t)
    store = _star_store(spark, t, "mergefact", s.filter(F.col("transaction_date") < SALES_A_BEFORE))
    build_star(store)
    later = s.filter(F.col("transaction_date") >= SALES_B_FROM).withColumn("payment_mode", F.lower("payment_mode"))
    stage(store, "sales_transactions", later)
    merge_load(store, SALES)
    return _key_check(store.read(SALES.qualified).drop(*LINEAGE), SALES.key_column)


def merge_fact_partitioned(spark, sf_dir):
    """``merge_fact`` on a fact stored one folder per month: only the months
    holding matched keys or incoming rows are rewritten."""
    t = si.tables(spark, sf_dir)
    s = si.sales(t)
    store = _star_store(spark, t, "mergepart", s.filter(F.col("transaction_date") < SALES_A_BEFORE))
    build_star(store)
    publish_partitioned(store, SALES.qualified, store.read(SALES.qualified), month_of())
    later = s.filter(F.col("transaction_date") >= SALES_B_FROM).withColumn("payment_mode", F.lower("payment_mode"))
    stage(store, "sales_transactions", later)
    source = fact_source(store, store.read("staging.sales_transactions"))
    merge_partitioned(store, SALES, source, month_of())
    return _key_check(store.read(SALES.qualified).drop(*LINEAGE), SALES.key_column)


def merge_fact_empty_dates(spark, sf_dir):
    """The fact's merge job on sales whose dates are empty (returned ones) or
    NULL (accepted ones): these rows live in partitions of their own."""
    t = si.tables(spark, sf_dir)
    s = si.sales(t).withColumn("day", F.col("transaction_date")).withColumn("transaction_date", F.when(F.col("payment_mode") == "R", "").when(
        F.col("payment_mode") != "A", F.col("transaction_date")))
    store = _star_store(spark, t, "mergeempty", s.filter(F.col("day") < SALES_A_BEFORE).drop("day"))
    build_star(store)
    stage(store, "sales_transactions", s.filter(F.col("day") >= SALES_B_FROM).withColumn("payment_mode", F.lower("payment_mode")).drop("day"))
    merge_sales_by_month(store)
    return _key_check(store.read(SALES.qualified).drop(*LINEAGE), SALES.key_column)


def enforced_constraints(spark, sf_dir):
    """What loads may not do to a published star, one row a try: SQLSTATE,
    violations, then the fact's rows and the first customer key afterwards."""
    store = _star_store(spark, si.tables(spark, sf_dir), "enforced")
    build_star(store)
    wrong = F.when(F.col("payment_mode") == "R", F.col("product_key") + 1_000_000_000).otherwise(F.col("product_key"))

    def wrong_keys():
        publish_partitioned(store, SALES.qualified, None, month_of())
        merge_partitioned(store, SALES, fact_source(store).withColumn("product_key", wrong.cast("long")), month_of())

    def failing_group():
        staged = store.read("staging.product")
        store.replace("staging.product", staged.withColumnRenamed("product_name", "title"))
        try:
            run_group(store, "fullload")  # the third job finds no product_name
        finally:
            store.replace("staging.product", staged)

    tries = {"a dimension loaded anew without the fact": lambda: full_load(store, CUSTOMER), "merged rows with unknown keys": wrong_keys,
             "a group whose third job fails": failing_group, "a group of full loads": lambda: run_group(store, "fullload")}
    out = None
    for what, attempt in tries.items():
        state, n = "00000", 0
        try:
            attempt()
        except Exception as e:
            state, n = sqlstate_of(e), getattr(e, "violations", None) or 0
        rows = store.read(SALES.qualified).agg(F.count(F.lit(1)).alias("fact_rows")).crossJoin(
            store.read(CUSTOMER.qualified).agg(F.min("customer_key").cast("long").alias("first_customer_key")))  # one row each
        rows = rows.select(F.lit(what).alias("attempt"), F.lit(state).alias("sqlstate"), F.lit(n).cast("long").alias("violations"), "*")
        out = rows if out is None else out.unionAll(rows)
    return out


def schema_type_change(spark, sf_dir):
    """Three loads of orders whose columns change type: a count widens, a price
    widens, a text takes numbers, a customer number becomes a text."""
    o = si.tables(spark, sf_dir)("orders")
    store = _store(spark, "types")
    first = o.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").cast("long").alias("id"), F.col("o_custkey").cast("int").alias("n"), F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.col("o_orderpriority").alias("note"), F.col("o_custkey").cast("long").alias("customer"))
    second = o.filter(F.col("o_orderstatus") == "O").select(
        F.col("o_orderkey").cast("long").alias("id"), (F.col("o_custkey").cast("long") + 5_000_000_000).alias("n"),
        (F.col("o_totalprice").cast("decimal(12,2)") / 4).cast("decimal(14,4)").alias("price"),
        F.col("o_custkey").cast("long").alias("note"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer"))
    third = o.filter(F.col("o_orderstatus") == "P").select(
        F.col("o_orderkey").cast("int").alias("id"), F.lit(7).cast("short").alias("n"), F.col("o_custkey").cast("long").alias("price"),
        F.lit(True).alias("note"), F.col("o_custkey").cast("int").alias("customer"))
    for load in (first, second, third):
        store.append("staging.orders", load)
    return store.read("staging.orders")


def merge_null_keys(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    store = _store(spark, "mergenull")
    stage(store, "customer", si.customer(t))
    full_load(store, CUSTOMER)
    source = si.customer(t).withColumn(
        "customer_id", F.when(F.col("customer_type") != TRACKED_SEGMENT, F.col("customer_id")))
    stage(store, "customer", source)
    merge_load(store, CUSTOMER)
    merge_load(store, CUSTOMER)   # NULL keys never match: inserted again
    return (store.read(CUSTOMER.qualified).filter(F.col("customer_id").isNull())
            .select("customer_name", "country_code", "customer_type"))


def merge_duplicate_check(spark, sf_dir):
    c = si.customer(si.tables(spark, sf_dir))
    target = c.filter(F.col("customer_type") != "HOUSEHOLD")
    source = c.unionByName(c.filter(F.col("customer_type").isin("MACHINERY", "HOUSEHOLD")))
    return merge_cardinality_violations(source, target, ["customer_id"])


# ---------------------------------------------------------------- jobs
def error_log_summary(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    store = _store(spark, "errors")
    create_error_log(store)
    jobs = {
        "report.CAST_CUSTOMER_NAME": lambda: t("customer").select(
            strict_decimal("c_name").alias("x")).write.format("noop").mode("overwrite").save(),
        "report.PRICE_RATIO": lambda: t("orders").select(
            (F.col("o_totalprice") / (F.col("o_orderkey") - F.col("o_orderkey"))).alias("x")
        ).write.format("noop").mode("overwrite").save(),
        "fullload.LOAD_SALES_TRANSACTIONS_FACT": lambda: full_load(store, SALES),
    }
    for name, job in jobs.items():
        try:
            run_logged(store, name, job)
        except Exception:
            pass
    return error_summary(store)


def _built_star(spark, sf_dir, tag):
    """CSV landing folder -> staging -> star, as the batch run does it."""
    t = si.tables(spark, sf_dir)
    data_dir = new_scratch_dir(spark, "landing-csv")
    for name, df in (("country", si.country(t)), ("customer", si.customer(t)),
                     ("product", si.product(t)), ("sales_transactions", si.sales(t))):
        write_csv(df, f"{data_dir}/{name}.csv", compression="gzip")
    store = _store(spark, tag)
    run_warehouse(spark, data_dir, store, multi_line=False)   # key/name/number columns: no newlines
    return store


def star_row_counts(spark, sf_dir):
    store = _built_star(spark, sf_dir, "warehouse")
    parts = [store.read(spec.qualified).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(spec.name).alias("table_name"), "row_count")
             for spec in (COUNTRY, CUSTOMER, PRODUCT, SALES)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def job_group_counts(spark, sf_dir):
    """Both job groups over a built star: rows loaded, then rows inserted by
    the merges (every staged row matches), and the fact's rows afterwards."""
    store = _built_star(spark, sf_dir, "groups")
    done = {**run_group(store, "fullload"), **run_group(store, "merge_load")}
    rows = spark.createDataFrame([(k, int(v)) for k, v in done.items()], "job string, row_count bigint")
    return rows.unionAll(store.read(SALES.qualified).agg(F.lit("rows of the fact").alias("job"), F.count(F.lit(1)).alias("row_count")))


# ---------------------------------------------------------------- JSON ingest
def _land(df: DataFrame, spark, tag) -> str:
    path = new_scratch_dir(spark, tag)
    df.write.json(path)
    return path


def _username(c: str) -> F.Column:
    return F.concat(F.lit("user_"), F.col(c).cast("string"))


def profiles(spark, sf_dir):
    ev = si.tables(spark, sf_dir)("events")
    landed = ev.groupBy("user_id").agg(F.max(si.epoch_seconds("ts")).alias("last_online"),
                                       F.min(si.epoch_seconds("ts")).alias("joined"))
    landed = landed.select(_username("user_id").alias("username"), "last_online", "joined")
    path = _land(landed, spark, "profiles")
    prof = J.players_profiles(J.read_landed(spark, path, "username string, last_online bigint, joined bigint"))
    return prof.select("username", F.unix_seconds("last_online").alias("last_online_epoch"),
                       F.unix_seconds("joined").alias("joined_epoch"))


def _archive_url(name_col: str, date_col: str) -> F.Column:
    return F.concat(F.lit(si.URL_PREFIX), F.col(name_col), F.lit("/games/"), F.date_format(date_col, "yyyy/MM"))


def _land_listing(spark, t) -> DataFrame:
    o, c = t("orders"), t("customer")
    urls = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_name").alias("username"), _archive_url("c_name", "o_orderdate").alias("url"))
    # distinct months per user: bounded by the calendar, not by sales volume
    listing = urls.groupBy("username").agg(F.collect_set("url").alias("archives"))
    return J.read_landed(spark, _land(listing, spark, "listing"), "username string, archives array<string>")


def _land_bodies(spark, t) -> DataFrame:
    o, c = t("orders"), t("customer")
    games = o.join(c, o.o_custkey == c.c_custkey).select(
        _archive_url("c_name", "o_orderdate").alias("url"),
        F.floor(F.col("o_orderkey") / GAMES_PER_RECORD).alias("chunk"),
        F.struct(F.col("o_orderkey").alias("game_id"), si.epoch_seconds("o_orderdate").alias("end_time"),
                 F.col("o_orderstatus").alias("result")).alias("game"))
    bodies = games.groupBy("url", "chunk").agg(F.collect_list("game").alias("games")).select(
        "url", F.when(month_of_url("url") == MISSING_MONTH, 404).otherwise(200).alias("status"), "games")
    return J.read_landed(spark, _land(bodies, spark, "bodies"),
                         "url string, status int, games array<struct<game_id:bigint,end_time:bigint,result:string>>")


def _tracked(t) -> DataFrame:
    return t("customer").select(F.col("c_name").alias("username"))


def archive_listing(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    return J.players_archives(_land_listing(spark, t), _tracked(t))


def month_range(spark, sf_dir):
    o = si.tables(spark, sf_dir)("orders")
    urls = o.select("o_orderkey", F.concat(F.lit(si.URL_PREFIX), F.col("o_custkey").cast("string"), F.lit("/games/"),
                                           F.date_format("o_orderdate", "yyyy/MM")).alias("url"))
    return month_range_filter(urls, month_of_url("url"), *RUN2)


def bad_months(spark, sf_dir):
    o = si.tables(spark, sf_dir)("orders")
    sep = F.when(F.month("o_orderdate") % 3 == 0, F.lit("-")).otherwise(F.lit("/"))
    m = o.select("o_orderkey", F.concat(F.date_format("o_orderdate", "yyyy"), sep,
                                        F.date_format("o_orderdate", "MM")).alias("month"))
    return bad_month_rows(m, "month")


def _two_runs(spark, t, runs):
    store = _store(spark, "games")
    listing, bodies, users = _land_listing(spark, t), _land_bodies(spark, t), _tracked(t)
    for start, end in runs:
        J.load_games_incrementally(store, listing, bodies, users, start, end)
    return store


def games_incremental(spark, sf_dir):
    store = _two_runs(spark, si.tables(spark, sf_dir), [RUN1, RUN2])
    return store.read(J.GAMES_TABLE).select("url", "game_id", F.unix_seconds("end_time").alias("end_time_epoch"),
                                            "result")


def archive_ledger(spark, sf_dir):
    store = _two_runs(spark, si.tables(spark, sf_dir), [RUN1, RUN2])
    return store.read(J.LEDGER_TABLE).select("url")


def missing_archives(spark, sf_dir):
    store = _two_runs(spark, si.tables(spark, sf_dir), [RUN2])
    games = store.read(J.GAMES_TABLE).groupBy("url").agg(F.count(F.lit(1)).alias("n_games"))
    return (store.read(J.LEDGER_TABLE).select("url").join(games, "url", "left")
            .select("url", F.coalesce("n_games", F.lit(0)).cast("bigint").alias("n_games")))


def json_source_tables(spark, sf_dir):
    """The whole JSON source over two runs: rows, distinct row ids and loads of every table."""
    t = si.tables(spark, sf_dir)
    store, users = _store(spark, "json-source"), _tracked(t)
    listing, bodies = _land_listing(spark, t), _land_bodies(spark, t)
    profile = t("customer").select(F.col("c_name").alias("username"), F.lit(0).cast("bigint").alias("last_online"),
                                   F.col("c_custkey").cast("bigint").alias("joined"),
                                   F.struct(F.col("c_nationkey").alias("countryCode")).alias("homeBase"),
                                   F.array("c_mktsegment", F.lit("all")).alias("clubs"))
    status = t("customer").select(F.col("c_name").alias("username"), F.lit("offline").alias("onlineStatus"),
                                  F.lit(0).cast("bigint").alias("lastLoginDate"))
    landed = {"profiles": profile, "archives": listing, "bodies": bodies, "status": status}
    J.run_json_source(store, landed, users, *RUN1, resources=J.RESOURCES)
    J.run_json_source(store, landed, users, *RUN2)
    tables = [J.PROFILES_TABLE, f"{J.PROFILES_TABLE}__clubs", J.ARCHIVES_TABLE, J.GAMES_TABLE, J.STATUS_TABLE]
    out = None
    for name in tables:
        one = store.read(name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                                   F.countDistinct("_row_id").alias("row_ids"), F.countDistinct("_load_id").alias("loads"))
        out = one if out is None else out.unionByName(one)
    return out


def json_child_tables(spark, sf_dir):
    """Records with lists of structs: the child table's rows, found again through the parent's row id."""
    t = si.tables(spark, sf_dir)
    store = _store(spark, "json-children")
    J.load_resource(store, "landing.conversations", _land_conversations(spark, t), "replace")
    parent, child = store.read("landing.conversations"), store.read("landing.conversations__messages")
    return child.join(parent.select("conv_id", "base", F.col("_row_id").alias("_parent_id")), "_parent_id").select(
        "conv_id", (F.col("base") + F.col("_list_idx")).alias("position"), "turn", "role", "text")


def online_status(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    ev = t("events")
    latest = ev.groupBy("user_id").agg(F.max_by("event_type", "ts").alias("onlineStatus"),
                                       F.max(si.epoch_seconds("ts")).alias("lastLoginDate"))
    landed = latest.select(_username("user_id").alias("username"), "onlineStatus", "lastLoginDate")
    snaps = J.read_landed(spark, _land(landed, spark, "status"),
                          "username string, onlineStatus string, lastLoginDate bigint")
    users = t("events").select(_username("user_id").alias("username"))
    store = _store(spark, "status")
    J.load_resource(store, J.STATUS_TABLE, J.players_online_status(snaps, users), "append")
    return store.read(J.STATUS_TABLE).select("username", "online_status", "last_login_date")


STREAM_SPLIT = "2024-01-16"          # events before / after this day land in two drops


def online_status_stream(spark, sf_dir):
    """Append-only landing folder ingested by a file stream: the second run
    takes only the files of the second drop."""
    ev = si.tables(spark, sf_dir)("events")
    snaps = ev.select(_username("user_id").alias("username"), F.col("event_type").alias("onlineStatus"),
                      si.epoch_seconds("ts").alias("lastLoginDate"), F.col("ts"))
    landing = new_scratch_dir(spark, "status-landing")
    checkpoint = new_scratch_dir(spark, "status-stream")
    store = _store(spark, "status-stream")
    schema = "username string, onlineStatus string, lastLoginDate bigint"
    for name, cond in (("drop1", F.col("ts") < STREAM_SPLIT), ("drop2", F.col("ts") >= STREAM_SPLIT)):
        snaps.filter(cond).drop("ts").write.json(f"{landing}/{name}")
        ingest_new_files(spark, f"{landing}/*", schema, store, J.STATUS_TABLE, checkpoint,
                         transform=normalize_names)
    return store.read(J.STATUS_TABLE).select("username", "online_status", "last_login_date")


def stream_replays(spark, sf_dir):
    """Batches of a stream, some delivered twice, also after the table was rewritten as one version."""
    ev = si.tables(spark, sf_dir)("events").select("event_id", "user_id", "event_type")
    store = _store(spark, "replays")
    kinds = [r[0] for r in ev.select("event_type").distinct().sort("event_type").collect()]   # a handful of types
    table = "landing.events"
    for n, kind in enumerate(kinds):
        for _ in range(2):
            store.append_batch(table, ev.filter(F.col("event_type") == kind), "events", n)
        if n == 0:
            store.replace(table, store.read(table), base=store.version())
            store.append_batch(table, ev, "events", n)
    store.append_batch(table, ev.filter(F.col("event_type").isNull()), "events", len(kinds))
    return store.read(table)


def atomic_publish(spark, sf_dir):
    """Two tables in one publish: a commit of both, then one that is refused
    because a table it read was renewed, which leaves both as they were."""
    t = si.tables(spark, sf_dir)
    store, base = _store(spark, "publish"), 0
    orders = t("orders").select("o_orderkey", "o_custkey")
    customers = t("customer").select("c_custkey", "c_nationkey")

    def both(o, c):
        return {"dwh.orders": store.write_version("dwh.orders", o), "dwh.customers": store.write_version("dwh.customers", c)}

    base = store.commit(both(orders.filter("o_custkey IS NULL"), customers))
    store.commit(both(orders, customers), base=base)
    try:
        store.commit(both(orders.filter(F.lit(False)), customers.filter(F.lit(False))), base=base)
        refused = 0
    except StaleBase:
        refused = 1
    return (store.read("dwh.orders").agg(F.count(F.lit(1)).alias("row_count"), F.sum("o_custkey").cast("bigint").alias("key_sum"))
            .withColumn("table_name", F.lit("dwh.orders"))
            .unionByName(store.read("dwh.customers").agg(F.count(F.lit(1)).alias("row_count"), F.sum("c_custkey").cast("bigint").alias("key_sum"))
                         .withColumn("table_name", F.lit("dwh.customers")))
            .withColumn("refused", F.lit(refused).cast("bigint")))


def namespaces(spark, sf_dir):
    """One table name in two namespaces: each holds its own rows; making a namespace again changes nothing."""
    t, store = si.tables(spark, sf_dir), _store(spark, "namespaces")
    for ns, rows in (("buyers", t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))),
                     ("sellers", t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))):
        store.ensure_namespace(ns)
        store.replace(f"{ns}.party", rows)
        store.ensure_namespace(ns)
    return (store.read("buyers.party").withColumn("namespace", F.lit("buyers"))
            .unionByName(store.read("sellers.party").withColumn("namespace", F.lit("sellers"))))


def source_location(spark, sf_dir):
    """CSV files found by table name below the data folder and staged together."""
    t, folder = si.tables(spark, sf_dir), new_scratch_dir(spark, "data-dir")
    tables = {"region": t("region").select("r_regionkey", "r_name"), "nation": t("nation").select("n_nationkey", "n_name")}
    for name, rows in tables.items():
        write_csv(rows, source_path(folder + "/", name))
    store = _store(spark, "source-location")
    stage_csv_dir(store, folder, tables)
    return (store.read("staging.region").select(F.lit("region").alias("source"), F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
            .unionByName(store.read("staging.nation").select(F.lit("nation").alias("source"), F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))))


def flatten_json(spark, sf_dir):
    ev = si.tables(spark, sf_dir)("events")
    lines = ev.select(F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"),
                               F.lit(', "user_id": '), F.col("user_id").cast("string"),
                               F.lit(', "props": '), F.col("props"), F.lit("}")).alias("value"))
    path = new_scratch_dir(spark, "events-json")
    lines.write.text(path)
    return flatten(J.read_landed(spark, path))   # schema inferred from the data


def _land_conversations(spark, t, with_gaps: bool = False) -> DataFrame:
    conv = t("conversations").withColumn("chunk", F.floor(F.col("turn") / TURNS_PER_RECORD))
    grouped = conv.groupBy("conv_id", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("messages"),
        F.count(F.lit(1)).alias("n"))
    msgs = F.col("messages")
    if with_gaps:   # by the length of the whole conversation
        turns = F.sum("n").over(Window.partitionBy("conv_id"))
        msgs = (F.when(turns == 1, F.lit(None))
                .when(turns == 2, F.array().cast("array<struct<turn:bigint,role:string,text:string>>"))
                .otherwise(msgs))
    landed = grouped.select("conv_id", (F.col("chunk") * TURNS_PER_RECORD).cast("bigint").alias("base"),
                            msgs.alias("messages"))
    return J.read_landed(spark, _land(landed, spark, "conversations"),
                         "conv_id bigint, base bigint, messages array<struct<turn:bigint,role:string,text:string>>")


def child_table(spark, sf_dir):
    parents = _land_conversations(spark, si.tables(spark, sf_dir))
    return child_rows(parents, "conv_id", "messages", position="position", base_position="base")


def missing_lists(spark, sf_dir):
    parents = _land_conversations(spark, si.tables(spark, sf_dir), with_gaps=True)
    return explode_list(parents, "messages", ["conv_id"], "m").select("conv_id", "m.role", "m.text")


def snake_case_columns(spark, sf_dir):
    c = si.tables(spark, sf_dir)("customer")
    camel = c.toDF("cCustkey", "cName", "cNationkey", "cAcctbal", "cMktsegment")
    return normalize_names(camel)


def schema_growth(spark, sf_dir):
    c = si.tables(spark, sf_dir)("customer")
    store = _store(spark, "growth")
    store.append("landing.customers", c.drop("c_acctbal"))
    store.append("landing.customers", c)
    return store.read("landing.customers")


def tracked_users(spark, sf_dir):
    t = si.tables(spark, sf_dir)
    users = t("customer").filter(F.col("c_mktsegment") == TRACKED_SEGMENT).select(
        _username("c_custkey").alias("username"))
    ev = t("events").select("event_id", _username("user_id").alias("username"))
    return J.restrict_to_users(ev, users)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "above_average_customers": above_average_customers,
    "sales_by_customer": sales_by_customer,
    "report_precision": report_precision,
    "top_product": top_product,
    "sales_by_country": sales_by_country,
    "frequent_buyers": frequent_buyers,
    "report_lines": report_lines,
    "strict_cast": strict_cast,
    "csv_scan": csv_scan,
    "csv_short_rows": csv_short_rows,
    "staging_replace": staging_replace,
    "staging_append": staging_append,
    "lineage_columns": lineage_columns,
    "load_report": load_report,
    "dim_surrogate_key": dim_surrogate_key,
    "fact_lookup": fact_lookup,
    "key_continuation": key_continuation,
    "rebuild_table": rebuild_table,
    "pk_violations": pk_violations_q,
    "fk_violations": fk_violations_q,
    "required_columns": required_columns,
    "full_load_dim": full_load_dim,
    "schema_type_change": schema_type_change,
    "merge_fact_empty_dates": merge_fact_empty_dates,
    "enforced_constraints": enforced_constraints,
    "full_load_fact": full_load_fact,
    "truncate_table": truncate_table,
    "merge_dim": merge_dim,
    "merge_fact": merge_fact,
    "merge_fact_partitioned": merge_fact_partitioned,
    "merge_null_keys": merge_null_keys,
    "merge_duplicate_check": merge_duplicate_check,
    "error_log_summary": error_log_summary,
    "star_row_counts": star_row_counts,
    "job_group_counts": job_group_counts,
    "profiles": profiles,
    "archive_listing": archive_listing,
    "month_range": month_range,
    "bad_months": bad_months,
    "games_incremental": games_incremental,
    "archive_ledger": archive_ledger,
    "missing_archives": missing_archives,
    "json_source_tables": json_source_tables,
    "json_child_tables": json_child_tables,
    "online_status": online_status,
    "online_status_stream": online_status_stream,
    "stream_replays": stream_replays,
    "atomic_publish": atomic_publish,
    "namespaces": namespaces,
    "source_location": source_location,
    "flatten_json": flatten_json,
    "child_table": child_table,
    "missing_lists": missing_lists,
    "snake_case_columns": snake_case_columns,
    "schema_growth": schema_growth,
    "tracked_users": tracked_users,
}
