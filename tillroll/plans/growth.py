"""Period-over-period change.

A9 and A12 compare with the previous *present* row (LAG); A15 compares with
the previous *calendar* month of the same year and treats a gap as no
previous month.  A15 is also done with LAG -- one shuffle instead of the
self-join's two -- keeping the previous row only when it is exactly the month
before.  Every window partition holds at most 12 (or 4) rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.exprs import as_double, pct_change, round_half_up
from tillroll.plans.common import dates, fact, money
from tillroll.warehouse import Star


def q9_mom_growth(star: Star, year: int = 2020) -> DataFrame:
    f = fact(star, "product_sk", "date_sk", "total_price", year=year)
    per_product = (
        f.join(dates(star, "year", "month", year=year), "date_sk")
        .groupBy("product_sk", "year", "month")
        .agg(F.sum("total_price").alias("_rev"))
    )
    monthly = (
        per_product.join(star.product_dim.select("product_sk", "product_category"), "product_sk")
        .groupBy("product_category", F.col("year").alias("yr"), F.col("month").alias("mon"))
        .agg(F.sum("_rev").alias("_rev"))
    )
    prev = F.lag("_rev").over(Window.partitionBy("product_category").orderBy("mon"))
    return (
        monthly.withColumn("_prev", prev)
        .select(
            "product_category", "yr", "mon", money("_rev", "revenue"),
            round_half_up(pct_change("_rev", "_prev")).alias("mom_growth_percent"),
        )
        .orderBy("product_category", "mon")
    )


def q12_store_growth(star: Star, year: int = 2017) -> DataFrame:
    """Quarter-on-quarter by store; the store name comes from product_dim."""
    f = fact(star, "product_sk", "date_sk", "total_price", year=year)
    per_product = (
        f.join(dates(star, "year", "quarter", year=year), "date_sk")
        .groupBy("product_sk", "year", "quarter")
        .agg(F.sum("total_price").alias("_rev"))
    )
    quarterly = (
        per_product.join(star.product_dim.select("product_sk", "store_name"), "product_sk")
        .groupBy("store_name", F.col("year").alias("yr"), F.col("quarter").cast("int").alias("qtr"))
        .agg(F.sum("_rev").alias("_rev"))
    )
    prev = F.lag("_rev").over(Window.partitionBy("store_name").orderBy("qtr"))
    return (
        quarterly.withColumn("_prev", prev)
        .select(
            "store_name", "yr", "qtr", money("_rev", "revenue"),
            round_half_up(pct_change("_rev", "_prev")).alias("growth_rate_percent"),
        )
        .orderBy("store_name", "qtr")
    )


def q15_volatility(star: Star) -> DataFrame:
    f = fact(star, "store_sk", "supplier_sk", "date_sk", "total_price")
    per_month = (
        f.join(dates(star, "year", "month"), "date_sk")
        .groupBy("store_sk", "supplier_sk", "year", "month")
        .agg(F.sum("total_price").alias("_rev"))
    )
    s = star.store_dim.where(F.col("store_id").isNotNull()).select("store_sk", "store_id", "store_name")
    p = star.supplier_dim.where(F.col("supplier_id").isNotNull()).select("supplier_sk", "supplier_id", "supplier_name")
    monthly = per_month.join(s, "store_sk").join(p, "supplier_sk")
    w = Window.partitionBy("store_id", "supplier_id", "year").orderBy("month")
    lag_month, lag_rev = F.lag("month").over(w), F.lag("_rev").over(w)
    with_prev = monthly.withColumn("_lm", lag_month).withColumn("_lr", lag_rev)
    adjacent = F.col("_lm") == F.col("month") - 1
    prev_month = F.when(adjacent, F.col("_lm"))
    prev_rev = F.when(adjacent, F.col("_lr"))
    volatility = F.when(prev_rev > 0, F.abs(pct_change("_rev", prev_rev)))
    return (
        with_prev.select(
            "store_id", "store_name", "supplier_id", "supplier_name", "year",
            F.col("month").alias("current_month"),
            money("_rev", "current_revenue"),
            prev_month.alias("previous_month"),
            as_double(prev_rev).alias("previous_revenue"),
            F.coalesce(volatility, F.lit(0.0)).alias("volatility_percentage"),
        )
        .orderBy("store_name", "supplier_name", F.col("year").desc(), F.col("current_month").desc())
    )
