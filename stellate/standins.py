"""The supplied test tables in the shape of the reference's staging tables.

country  <- nation joined to region
customer <- customer (segment as customer type)
product  <- part
sales_transactions <- lineitem joined to orders (line grain; the id
                      concatenates the four columns that make a line unique)

Staging holds text only, as a CSV load would. Amounts become text through a
two-decimal decimal so that the text is the same in every engine. Each
Spark builder here has a SQL twin in ``stellate.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Tables = Callable[[str], DataFrame]

# Prefix of the landed archive URLs; the month is the last seven characters.
URL_PREFIX = "https://archive.example/player/"


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return lambda name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text(c: str) -> F.Column:
    return F.col(c).cast("string")


def amount_text(c: str) -> F.Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


def country(t: Tables) -> DataFrame:
    n, r = t("nation"), t("region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        text("n_nationkey").alias("country_code"), F.col("n_name").alias("country_name"),
        F.col("r_name").alias("region"))


def customer(t: Tables) -> DataFrame:
    return t("customer").select(
        text("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        text("c_nationkey").alias("country_code"), F.col("c_mktsegment").alias("customer_type"))


def product(t: Tables, with_size: bool = False) -> DataFrame:
    cols = [text("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"), amount_text("p_retailprice").alias("standard_price")]
    return t("part").select(*cols, *([F.col("p_size")] if with_size else []))


def sales(t: Tables) -> DataFrame:
    li, o = t("lineitem"), t("orders")
    tid = F.concat_ws("-", text("l_orderkey"), text("l_partkey"), text("l_suppkey"), text("l_linenumber"))
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        tid.alias("transaction_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("transaction_date"),
        text("o_custkey").alias("customer_id"),
        text("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").cast("string").alias("quantity"),
        amount_text("l_extendedprice").alias("unit_price"),
        amount_text("l_extendedprice").alias("total_amount"),
        F.col("l_returnflag").alias("payment_mode"))


# Report inputs keep the native key types of the test tables.
def report_customers(t: Tables) -> DataFrame:
    return t("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
                                F.col("c_nationkey").alias("country_code"))


def report_orders(t: Tables) -> DataFrame:
    return t("orders").select(F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("customer_id"),
                              F.col("o_totalprice").alias("total_amount"))


def report_products(t: Tables) -> DataFrame:
    return t("part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"))


def report_lines_fact(t: Tables) -> DataFrame:
    return t("lineitem").select(F.col("l_partkey").alias("product_id"), F.col("l_extendedprice").alias("total_amount"))


def epoch_seconds(c: str) -> F.Column:
    """Whole seconds since 1970 of a TIMESTAMP_NTZ, independent of the
    session time zone."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{c}`)")
