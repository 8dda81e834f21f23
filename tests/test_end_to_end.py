"""The whole batch path on reference-style CSV files: landing -> staging ->
star -> loads/merges -> reports, plus the command line."""

from decimal import Decimal

from stellate.__main__ import main as cli
from stellate.plans import reports as R
from stellate.plans.jobs import run_group, run_warehouse
from stellate.plans.warehouse import CUSTOMER, PRODUCT, SALES
from stellate.session import new_scratch_dir
from stellate.sources.store import TableStore

FILES = {
    "country.csv": "country_code,country_name,region\nUS,United States,North America\nOM,Oman,Middle East\n",
    "customer.csv": "﻿customer_id,customer_name,country_code,customer_type\n"
                    "C0001,Customer_1,US,RETAIL\nC0002,Customer_2,OM,CORPORATE\nC0003,Customer_3,US,RETAIL\n",
    "product.csv": "product_id,product_name,category,standard_price\nP001,Product_1,Travel,255\nP002,Product_2,Retail,21\n",
    "sales_transactions.csv":
        "transaction_id,transaction_date,customer_id,product_id,quantity,unit_price,total_amount,payment_mode\n"
        + "".join(f"T{i:03d},2024-01-{1 + i % 28:02d},C000{1 + i % 3},P00{1 + i % 2},1,10,{10 + i}.50,CARD\n"
                  for i in range(20))
        + "T999,2024-02-01,C0099,P001,1,10,5.00,CASH\n",
}


def _landing(spark, tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_csv_to_reports(spark, tmp_path):
    store = TableStore(spark, new_scratch_dir(spark, "e2e"))
    counts = run_warehouse(spark, _landing(spark, tmp_path), store)
    assert counts == {"countries_dim": 2, "customers_dim": 3, "products_dim": 2, "sales_transactions_fact": 21}
    cu, pr, fa = store.read(CUSTOMER.qualified), store.read(PRODUCT.qualified), store.read(SALES.qualified)
    assert fa.filter("transaction_id = 'T999'").collect()[0].customer_key is None   # unknown customer kept
    totals = {r[0]: r[1] for r in R.sales_by_customer(cu, fa).collect()}
    assert sum(totals.values()) == sum(Decimal(f"{10 + i}.50") for i in range(20))
    buyers = {r[0]: r[1] for r in R.frequent_buyers(cu, fa).collect()}
    assert buyers == {"Customer_1": 7, "Customer_2": 7, "Customer_3": 6}
    top = R.top_products(pr, fa).collect()
    assert len(top) == 1
    # a second full-load round renews keys above the old maximum
    run_group(store, "fullload")
    assert sorted(r.customer_key for r in store.read(CUSTOMER.qualified).collect()) == [4, 5, 6]


def test_command_line(spark, tmp_path, capsys):
    root = new_scratch_dir(spark, "cli")
    assert cli(["warehouse", "--data-dir", _landing(spark, tmp_path), "--store", root]) == 0
    assert cli(["report", "top_product", "--store", root]) == 0
    out = capsys.readouterr().out.strip().splitlines()
    assert out[-1].startswith("Product_") and len(out[-1]) >= 26
    assert cli(["job", "merge_load.MERGE_PRODUCT_DIM", "--store", root]) == 0
