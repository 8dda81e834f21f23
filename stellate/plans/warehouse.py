"""The star schema: table specs and the fact's key lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stellate.operators.lookups import Lookup, lookup_keys
from stellate.spec import TableSpec

# Table and column names of the reference's star schema (fixed values).
COUNTRY = TableSpec("countries_dim", ("country_code",),
                    ("country_code", "country_name", "region"), "country_key")
CUSTOMER = TableSpec("customers_dim", ("customer_id",),
                     ("customer_id", "customer_name", "country_code", "customer_type"), "customer_key")
PRODUCT = TableSpec("products_dim", ("product_id",),
                    ("product_id", "product_name", "category", "standard_price"), "product_key")
SALES = TableSpec("sales_transactions_fact", ("transaction_id",),
                  ("transaction_id", "transaction_date", "customer_id", "product_id",
                   "quantity", "unit_price", "total_amount", "payment_mode"), "sales_trans_key",
                  ordered_keys=False)

DIMENSIONS = (COUNTRY, CUSTOMER, PRODUCT)
FACT_KEYS = ("customer_key", "product_key", "country_key")
# staging table feeding each star table
STAGING_SOURCE = {
    COUNTRY.name: "country",
    CUSTOMER.name: "customer",
    PRODUCT.name: "product",
    SALES.name: "sales_transactions",
}


def fact_lookups(customers: DataFrame, products: DataFrame, countries: DataFrame) -> list[Lookup]:
    """Customer and product keys by business key; the country key is reached
    through the customer's ``country_code`` (snowflake lookup)."""
    return [
        Lookup(customers, "customer_id", "customer_id", "customer_key",
               carry={"country_code": "_cu_country_code"}),
        Lookup(products, "product_id", "product_id", "product_key"),
        Lookup(countries, "_cu_country_code", "country_code", "country_key"),
    ]


def fact_with_keys(sales: DataFrame, customers: DataFrame, products: DataFrame, countries: DataFrame,
                   broadcast_bytes: int | None = None) -> DataFrame:
    """``SELECT st.*, cu.customer_key, pr.product_key, co.country_key`` with
    three left joins: every staged sale survives, unknown keys are NULL."""
    return lookup_keys(sales, fact_lookups(customers, products, countries),
                       broadcast_bytes=broadcast_bytes)
