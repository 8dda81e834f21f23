"""Command line: the batch jobs and reports over a table store.

    python -m stellate warehouse --data-dir DIR --store ROOT    stage the CSVs, build the star
    python -m stellate job fullload.LOAD_COUNTRY_DIM --store ROOT
    python -m stellate group merge_load --store ROOT
    python -m stellate report above_average --store ROOT         fixed-width lines
    python -m stellate json --landed DIR --users a,b --start 2022/11 --end 2022/12 --store ROOT
"""

from __future__ import annotations

import argparse
import sys

from pyspark import SparkConf

from stellate.plans import reports as R
from stellate.plans.jobs import JOBS, run_group, run_job, run_warehouse
from stellate.plans.warehouse import CUSTOMER, PRODUCT, SALES
from stellate.session import build_session
from stellate.sources.json_ingest import RESOURCES, run_json_source
from stellate.sources.store import TableStore

REPORTS = {
    "above_average": lambda s: R.above_average_customers(s.read(CUSTOMER.qualified), s.read(SALES.qualified)),
    "top_product": lambda s: R.top_products(s.read(PRODUCT.qualified), s.read(SALES.qualified)),
    "sales_by_country": lambda s: R.sales_by_country(s.read(CUSTOMER.qualified), s.read(SALES.qualified)),
    "frequent_buyers": lambda s: R.frequent_buyers(s.read(CUSTOMER.qualified), s.read(SALES.qualified)),
}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="stellate")
    ap.add_argument("command", choices=["warehouse", "job", "group", "report", "json"])
    ap.add_argument("name", nargs="?")
    ap.add_argument("--store", required=True, help="root folder of the table store")
    ap.add_argument("--data-dir", help="CSV landing folder (default: $DATA_DIR)")
    ap.add_argument("--single-line", action="store_true", help="no field holds a newline: files are split across tasks")
    ap.add_argument("--landed", help="json: folder with profiles, archives, bodies and status")
    ap.add_argument("--users", default="", help="json: tracked users, separated by commas")
    ap.add_argument("--start", help="json: first month, YYYY/MM")
    ap.add_argument("--end", help="json: last month, YYYY/MM")
    ap.add_argument("--resources", help=f"json: some of {', '.join(RESOURCES)}")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    # scratch tables go below the store unless the cluster names a shared folder
    shared = SparkConf().get("spark.checkpoint.dir", None) or f"{args.store.rstrip('/')}/_scratch"
    spark = build_session(args.master, conf={"spark.checkpoint.dir": shared})
    store = TableStore(spark, args.store)
    if args.command == "warehouse":
        print(run_warehouse(spark, args.data_dir, store, multi_line=not args.single_line))
    elif args.command == "job":
        if args.name not in JOBS:
            ap.error(f"job must be one of {sorted(JOBS)}")
        print(args.name, run_job(store, args.name))
    elif args.command == "json":
        landed = {k: f"{args.landed}/{k}" for k in ("profiles", "archives", "bodies", "status")}
        print(run_json_source(store, landed, [u for u in args.users.split(",") if u], args.start, args.end,
                              args.resources.split(",") if args.resources else None))
    elif args.command == "group":
        print(run_group(store, args.name))
    else:
        if args.name not in REPORTS:
            ap.error(f"report must be one of {sorted(REPORTS)}")
        for row in R.report_lines(REPORTS[args.name](store)).toLocalIterator():
            print(row.line)
    return 0


if __name__ == "__main__":
    sys.exit(main())
