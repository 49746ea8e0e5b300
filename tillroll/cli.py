"""Command line: load files into a warehouse, run an analytic or SQL on it.

    python -m tillroll.cli load --warehouse W --products P.csv --customers C.csv \\
        --transactions DIR [--format csv|parquet] [--stream [--max-bytes N]] [--batch-id B]
        [--dedup order_id,product_id]
    python -m tillroll.cli query --warehouse W q1_top_products_daytype --param year=2015
    python -m tillroll.cli sql --warehouse W "SELECT COUNT(*) FROM sales_fact_v2" [--suffix _v2]

Results are shown with ``DataFrame.show`` (a bounded number of rows) or
written with ``--out PATH`` as Parquet.  ``--warehouse`` defaults to a folder
under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import SparkSession

from tillroll import etl
from tillroll.plans import basket, demographics, growth, rollup, spikes, topn, views
from tillroll.sources.masters import read_customer_master, read_product_master
from tillroll.sources.transactions import read_transactions
from tillroll.streaming.pipeline import backfill
from tillroll.warehouse import Warehouse

ANALYTICS = {
    "fact_row_count": views.fact_row_count,
    "available_years": views.available_years,
    "q1_top_products_daytype": topn.q1_top_products_daytype,
    "q2_demographics": demographics.q2_demographics,
    "q3_category_occupation": demographics.q3_category_occupation,
    "q4_gender_age_quarter": demographics.q4_gender_age_quarter,
    "q5_top_occupations": topn.q5_top_occupations,
    "q6_city_marital_recent": demographics.q6_city_marital_recent,
    "q7_avg_purchase": demographics.q7_avg_purchase,
    "q8_top_cities": topn.q8_top_cities,
    "q9_mom_growth": growth.q9_mom_growth,
    "q10_age_daytype": demographics.q10_age_daytype,
    "q11_top_products_category": topn.q11_top_products_category,
    "q12_store_growth": growth.q12_store_growth,
    "q13_store_supplier_product": rollup.q13_store_supplier_product,
    "q14_seasonal": rollup.q14_seasonal,
    "q15_volatility": growth.q15_volatility,
    "q16_basket_pairs": basket.q16_basket_pairs,
    "q17_rollup": rollup.q17_rollup,
    "q18_half_year": rollup.q18_half_year,
    "q19_spikes": spikes.q19_spikes,
    "q19_spike_flags": spikes.q19_spike_flags,
    "q20_store_quarterly_view": views.q20_store_quarterly_view,
}


def _warehouse(spark: SparkSession, root: str | None) -> Warehouse:
    return Warehouse(spark, root) if root else Warehouse.in_shared_dir(spark, "default")


def _params(fn, pairs: list[str]) -> dict:
    """``name=value`` pairs, typed after the function's defaults."""
    sig = inspect.signature(fn).parameters
    out = {}
    for pair in pairs:
        name, value = pair.split("=", 1)
        if name not in sig:
            raise SystemExit(f"unknown parameter {name!r}; has {list(sig)[1:]}")
        default = sig[name].default
        out[name] = type(default)(value) if default is not inspect.Parameter.empty else value
    return out


def _stored_master(wh: Warehouse, name: str, master):
    """The de-duplicated master as a Parquet copy: every batch of the load reads that instead of the files."""
    path = f"{wh.root}/_masters/{name}"
    master.write.mode("overwrite").parquet(path)
    return wh.spark.read.schema(master.schema).parquet(path)


def cmd_table(spark: SparkSession, a: argparse.Namespace) -> None:
    wh = _warehouse(spark, a.warehouse)
    {"create": wh.create, "drop": wh.drop_all}[a.cmd]()
    print(f"{a.cmd}: {wh.root}")


def cmd_load(spark: SparkSession, a: argparse.Namespace) -> None:
    wh = _warehouse(spark, a.warehouse)
    products = _stored_master(wh, "products", read_product_master(spark, a.products, a.master_format))
    customers = _stored_master(wh, "customers", read_customer_master(spark, a.customers, a.master_format))
    dedup = [k for k in (a.dedup or "").split(",") if k]
    if a.stream:
        results = backfill(wh, a.transactions, products, customers, fmt=a.format,
                           max_bytes_per_trigger=a.max_bytes, dedup_keys=dedup or None)
    else:
        batch = a.batch_id if a.batch_id is not None else wh.last_batch() + 1
        tx = read_transactions(spark, a.transactions, a.format, with_position=bool(dedup))
        results = [etl.load_batch(wh, tx, products, customers, batch, dedup_keys=dedup or None)]
    for r in results:
        print(f"batch {r.batch_id}: read {r.input_rows}, loaded {r.matched_rows}, set aside {r.quarantined_rows}"
              + (f", duplicates dropped {r.duplicates_dropped}" if r.duplicates_dropped else ""))
    print(f"warehouse: {wh.root}")


def _emit(df, a: argparse.Namespace) -> None:
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
        print(f"written: {a.out}")
    else:
        df.show(a.rows, truncate=False)


def cmd_query(spark: SparkSession, a: argparse.Namespace) -> None:
    fn = ANALYTICS[a.name]
    _emit(fn(_warehouse(spark, a.warehouse).star(), **_params(fn, a.param)), a)


def cmd_sql(spark: SparkSession, a: argparse.Namespace) -> None:
    star = _warehouse(spark, a.warehouse).star()
    star.register(suffix=a.suffix)
    views.create_store_quarterly_view(star)
    _emit(spark.sql(a.text), a)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tillroll")
    sub = p.add_subparsers(dest="cmd", required=True)

    load = sub.add_parser("load", help="load master and transaction files")
    load.add_argument("--warehouse")
    load.add_argument("--products", required=True)
    load.add_argument("--customers", required=True)
    load.add_argument("--transactions", required=True)
    load.add_argument("--format", default="csv", help="transactions: csv or parquet")
    load.add_argument("--master-format", default="csv")
    load.add_argument("--stream", action="store_true", help="availableNow stream in bounded batches")
    load.add_argument("--max-bytes", type=int, default=64 << 30)
    load.add_argument("--batch-id", type=int,
                      help="default: one past the last loaded batch; give the last batch's id to redo it")
    load.add_argument("--dedup", help="opt-in: keep the first line per these comma-separated keys")

    for name, help_ in (("query", "run a named analytic"), ("sql", "run SQL on the star views")):
        q = sub.add_parser(name, help=help_)
        q.add_argument("--warehouse")
        q.add_argument("--rows", type=int, default=20)
        q.add_argument("--out")
        if name == "query":
            q.add_argument("name", choices=sorted(ANALYTICS))
            q.add_argument("--param", action="append", default=[], help="name=value")
        else:
            q.add_argument("text")
            q.add_argument("--suffix", default="", help="view-name suffix, e.g. _v2")

    for name, help_ in (("create", "create the tables, empty, where absent"), ("drop", "drop the tables")):
        sub.add_parser(name, help=help_).add_argument("--warehouse")

    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("tillroll").getOrCreate()
    {"load": cmd_load, "query": cmd_query, "sql": cmd_sql}.get(a.cmd, cmd_table)(spark, a)


if __name__ == "__main__":
    main()
