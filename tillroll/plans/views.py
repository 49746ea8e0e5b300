"""A0, A0b, A20 (S10): checks and the store-quarter view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.exprs import mean
from tillroll.plans.common import fact, money
from tillroll.warehouse import Star

STORE_QUARTERLY_SALES = "STORE_QUARTERLY_SALES"


def fact_row_count(star: Star) -> DataFrame:
    return star.sales_fact.agg(F.count(F.lit(1)).alias("total_records"))


def available_years(star: Star) -> DataFrame:
    return star.date_dim.select(F.year("date").alias("year")).distinct().orderBy("year")


def store_quarterly_sales(star: Star) -> DataFrame:
    """The view body: per store, year and quarter."""
    f = fact(star, "store_sk", "date_sk", "customer_sk", "total_price", "quantity")
    d = star.date_dim.where(F.col("date").isNotNull()).select("date_sk", "year", F.quarter("date").alias("quarter"))
    per_store = f.join(d, "date_sk").groupBy("store_sk", "year", "quarter").agg(
        F.sum("total_price").alias("_rev"),
        F.sum("quantity").cast("bigint").alias("quarterly_quantity"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.countDistinct("customer_sk").alias("unique_customers"),
    )
    s = star.store_dim.where(F.col("store_id").isNotNull()).select("store_sk", "store_id", "store_name")
    return per_store.join(s, "store_sk").select(
        "store_sk", "store_id", "store_name", "year", F.col("quarter").cast("int").alias("quarter"),
        money("_rev", "quarterly_revenue"), "quarterly_quantity", "transaction_count",
        mean("_rev", "transaction_count").alias("avg_transaction_value"), "unique_customers",
    )


def create_store_quarterly_view(star: Star) -> str:
    """DROP VIEW IF EXISTS + CREATE VIEW: a temp view, expanded at each read."""
    spark = star.sales_fact.sparkSession
    spark.catalog.dropTempView(STORE_QUARTERLY_SALES)
    store_quarterly_sales(star).createOrReplaceTempView(STORE_QUARTERLY_SALES)
    return STORE_QUARTERLY_SALES


def q20_store_quarterly_view(star: Star) -> DataFrame:
    view = create_store_quarterly_view(star)
    spark = star.sales_fact.sparkSession
    return spark.table(view).orderBy("store_name", F.col("year").desc(), F.col("quarter").desc())
