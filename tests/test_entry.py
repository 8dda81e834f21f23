import duckdb

import __spark_entry__ as E
from conftest import SF001
from tools.check_oracle import canon

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["Customer Name", "Total Sales"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_reports_match_oracle_small(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    for name in ["above_average_customers", "frequent_buyers", "top_product", "merge_dim", "child_table"]:
        df = E.queries()[name](spark, SF001)
        cur = con.execute(E.oracle_sql()[name])
        ocols = [d[0] for d in cur.description]
        assert sorted(df.columns) == sorted(ocols), name
        assert canon(df.columns, df.collect()) == canon(ocols, cur.fetchall()), name
