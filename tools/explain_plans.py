"""Write the formatted physical plan of selected queries to docs/plans/.

    python tools/explain_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys

ROOT = __file__.rsplit("/tools/", 1)[0]
sys.path.insert(0, ROOT)

from stellate.queries import QUERIES  # noqa: E402
from stellate.session import build_session  # noqa: E402

def MERGE_PLAN(spark, sf_dir):
    """The merged table of a dimension merge, before it is written."""
    from pyspark.sql import functions as F

    from stellate import standins as si
    from stellate.operators.keys import assign_dense_keys
    from stellate.operators.merge import merge_type1
    t = si.tables(spark, sf_dir)
    parts = si.product(t, with_size=True)
    target, high = assign_dense_keys(parts.filter("p_size <= 35").drop("p_size"), "product_key", order_by=["product_id"])
    source = parts.filter("p_size >= 15").drop("p_size").withColumn("product_name", F.upper("product_name"))
    return merge_type1(target, source, ["product_id"], "product_key", high)[0]


DEFAULT = ["merge_type1", "above_average_customers", "top_product", "sales_by_country", "frequent_buyers",
           "fact_lookup", "merge_dim", "pk_violations", "fk_violations", "games_incremental"]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or DEFAULT
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "16"})
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    for name in names:
        df = MERGE_PLAN(spark, sf_dir) if name == "merge_type1" else QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as f:
            f.write(plan)
        print(name, "written")


if __name__ == "__main__":
    main()
