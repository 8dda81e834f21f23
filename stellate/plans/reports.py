"""The four sales reports.

Every report joins a dimension to the fact on a business key and aggregates
a decomposable measure (SUM, COUNT). The fact is first aggregated per
business key (partial aggregation on the map side, so a customer holding a
third of all sales is one row per task before the shuffle) and only those
per-key totals meet the dimension. This equals aggregating after the join,
also when the dimension repeats a business key, because SUM and COUNT
distribute over the join's row multiplication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate.functions.casts import money, strict_decimal
from stellate.functions.formatting import report_line

# Presentation names of the reference's reports (fixed values).
CUSTOMER_NAME = "Customer Name"
TOTAL_SALES = "Total Sales"
PRODUCT_NAME = "Product Name"
COUNTRY_NAME = "CountryName"
N_PURCHASES = "Number Of Purchase"


def _sum_per(fact: DataFrame, key: str, amount: str, scale: int | None) -> DataFrame:
    """Amounts summed per key, exact to six decimals; with ``scale`` every
    amount is first rounded to so many."""
    value = strict_decimal(amount) if scale is None else money(amount, scale)
    return fact.groupBy(key).agg(F.sum(value).alias("_amount"))


def _total(scale: int | None):
    total = F.sum("_amount")
    return total if scale is None else total.cast(T.DecimalType(38, scale))


def customer_totals(customers: DataFrame, fact: DataFrame, amount: str = "total_amount", scale: int | None = None) -> DataFrame:
    """Total sales per customer *name* (same-named customers are merged)."""
    per_id = _sum_per(fact, "customer_id", amount, scale)
    return (customers.select("customer_id", "customer_name").join(per_id, "customer_id")
            .groupBy("customer_name").agg(_total(scale).alias("total_sales")))


def sales_by_customer(customers: DataFrame, fact: DataFrame, **kw) -> DataFrame:
    return customer_totals(customers, fact, **kw).select(
        F.col("customer_name").alias(CUSTOMER_NAME), F.col("total_sales").alias(TOTAL_SALES))


def above_average_customers(customers: DataFrame, fact: DataFrame, **kw) -> DataFrame:
    """Customers whose total exceeds the average customer total (strictly).
    The totals are planned once; the average is a scalar subquery over the
    same plan, whose exchange Spark reuses."""
    totals = customer_totals(customers, fact, **kw)
    avg_total = totals.agg(F.avg("total_sales")).scalar()
    return (totals.filter(F.col("total_sales") > avg_total)
            .select(F.col("customer_name").alias(CUSTOMER_NAME), F.col("total_sales").alias(TOTAL_SALES)))


def top_products(products: DataFrame, fact: DataFrame, k: int = 1, amount: str = "total_amount",
                 scale: int | None = None) -> DataFrame:
    """Products (by name) with the highest total sales; NULL totals first as
    in the source database's DESC order, ties broken by name. ``k=1`` is the reference's
    report. Planned as a top-k (no global sort)."""
    per_id = _sum_per(fact, "product_id", amount, scale)
    totals = (products.select("product_id", "product_name").join(per_id, "product_id")
              .groupBy("product_name").agg(_total(scale).alias("total")))
    return (totals.orderBy(F.col("total").desc_nulls_first(), F.col("product_name").asc_nulls_last())
            .limit(k)
            .select(F.col("product_name").alias(PRODUCT_NAME), F.col("total").alias(TOTAL_SALES)))


def sales_by_country(customers: DataFrame, fact: DataFrame, amount: str = "total_amount", scale: int | None = None) -> DataFrame:
    """Total sales per customer country *code* (the report names it
    CountryName but never joins the country dimension), descending."""
    per_id = _sum_per(fact, "customer_id", amount, scale)
    return (customers.select("customer_id", "country_code").join(per_id, "customer_id")
            .groupBy("country_code").agg(_total(scale).alias("total"))
            .select(F.col("country_code").alias(COUNTRY_NAME), F.col("total").alias(TOTAL_SALES))
            .orderBy(F.col(TOTAL_SALES).desc_nulls_first()))


def frequent_buyers(customers: DataFrame, fact: DataFrame, min_purchases: int = 5) -> DataFrame:
    """Customers with more than ``min_purchases`` purchases (non-NULL
    transaction ids), by count descending."""
    per_id = fact.groupBy("customer_id").agg(F.count("transaction_id").alias("_n"))
    return (customers.select("customer_id", "customer_name").join(per_id, "customer_id")
            .groupBy("customer_id", "customer_name").agg(F.sum("_n").cast("bigint").alias("n"))
            .filter(F.col("n") > min_purchases)
            .select(F.col("customer_name").alias(CUSTOMER_NAME), F.col("n").alias(N_PURCHASES))
            .orderBy(F.col(N_PURCHASES).desc_nulls_first()))


def report_lines(report: DataFrame) -> DataFrame:
    """The printed form of a two-column report: one fixed-width line per row."""
    name, value = report.columns[:2]
    return report.select(report_line(F.col(f"`{name}`"), F.col(f"`{value}`")).alias("line"))
