"""Customer breakdowns.

Where the reference groups by a column and shows ``COALESCE(col,'Unknown')``,
the grouping is on the raw column (so NULL and a literal 'Unknown' stay two
rows) and the COALESCE is applied to the output only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.exprs import mean
from tillroll.plans.common import by_customer, dates, fact, money
from tillroll.plans.topn import category_by_customer
from tillroll.warehouse import Star

# Fixed value: the label shown for a missing customer attribute.
UNKNOWN = "Unknown"


def _unknown(c: str) -> F.Column:
    return F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(c)


def q2_demographics(star: Star) -> DataFrame:
    """Revenue, quantity and distinct orders by gender, age group, city."""
    # Grouped once by (attributes, order): the distinct-order count is then a
    # row count, and one more exchange on the attributes finishes it.
    attrs = ["gender", "age_group", "city_category"]
    rows = fact(star, "customer_sk", "order_id", "total_price", "quantity").join(star.customer_dim.select("customer_sk", *attrs), "customer_sk")
    return (
        _by_order(rows, attrs)
        .select(
            _unknown("gender"), _unknown("age_group"), _unknown("city_category"),
            money("_rev", "total_revenue"), "total_quantity", "orders_count",
        )
        .orderBy(F.col("total_revenue").desc())
    )


def _by_order(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Revenue, quantity and number of distinct orders (NULL not counted) by ``keys``."""
    per_order = rows.groupBy(*keys, "order_id").agg(F.sum("total_price").alias("_rev"), F.sum("quantity").cast("bigint").alias("_qty"))
    return per_order.groupBy(*keys).agg(
        F.sum("_rev").alias("_rev"), F.sum("_qty").cast("bigint").alias("total_quantity"), F.count("order_id").alias("orders_count")
    )


def q3_category_occupation(star: Star) -> DataFrame:
    rev = category_by_customer(star, "occupation").withColumnRenamed("_qty", "qty")
    return rev.select(
        _unknown("product_category"), _unknown("occupation"), money("_rev", "revenue"), "qty"
    ).orderBy("product_category", F.col("revenue").desc())


def q4_gender_age_quarter(star: Star, year: int = 2019) -> DataFrame:
    rows = fact(star, "customer_sk", "date_sk", "total_price", "quantity", year=year).join(
        dates(star, "quarter", year=year), "date_sk"
    )
    customers = star.customer_dim.select("customer_sk", "gender", "age_group")
    return (
        by_customer(rows, customers, ["quarter"], [("_rev", "total_price"), ("_qty", "quantity")])
        .select(_unknown("gender"), _unknown("age_group"), F.col("quarter").cast("int").alias("quarter"),
                money("_rev", "revenue"), F.col("_qty").cast("bigint").alias("quantity"))
        .orderBy("quarter", "gender", "age_group")
    )


def q6_city_marital_recent(star: Star, months: int = 6) -> DataFrame:
    """By city, marital status and month over the latest ``months`` months of date_dim."""
    # Global top-k over the distinct months: ``months`` rows at most, so the
    # list may come to the driver and turn into static filters -- the fact
    # scan then reads only the partitions of those months' years.
    recent = [
        (r.year, r.month)
        for r in star.date_dim.select("year", "month").distinct()
        .orderBy(F.col("year").desc(), F.col("month").desc()).limit(months).collect()
    ]
    if not recent:
        recent = [(None, None)]
    years = sorted({y for y, _ in recent if y is not None})
    in_recent = F.struct("year", "month").isin([F.struct(F.lit(y), F.lit(m)) for y, m in recent])
    d = star.date_dim.where(F.col("year").isin(years) & in_recent).select("date_sk", "year", "month")
    f = fact(star, "customer_sk", "date_sk", "order_id", "total_price", "quantity", years=years)
    rows = f.join(d, "date_sk").join(star.customer_dim.select("customer_sk", "city_category", "marital_status"), "customer_sk")
    return (
        _by_order(rows, ["city_category", "marital_status", "year", "month"])
        .select("city_category", "marital_status", "year", "month", money("_rev", "total_revenue"),
                "total_quantity", "orders_count")
        .orderBy("year", "month", "city_category", "marital_status")
    )


def q7_avg_purchase(star: Star) -> DataFrame:
    """Mean line value by stay length (grouped after COALESCE) and gender (raw)."""
    customers = star.customer_dim.select(
        "customer_sk",
        F.coalesce(F.col("stay_in_current_city_years"), F.lit(UNKNOWN)).alias("stay_years"),
        "gender",
    )
    rows = fact(star, "customer_sk", "total_price")
    return (
        by_customer(rows, customers, [], [("_rev", "total_price"), ("_n", None)])
        .select("stay_years", _unknown("gender"), mean("_rev", "_n").alias("avg_purchase_amount"))
        .orderBy("stay_years", "gender")
    )


def q10_age_daytype(star: Star, year: int = 2020) -> DataFrame:
    rows = fact(star, "customer_sk", "date_sk", "total_price", year=year).join(
        dates(star, "day_type", year=year), "date_sk"
    )
    customers = star.customer_dim.select("customer_sk", "age_group")
    return (
        by_customer(rows, customers, ["day_type"], [("_rev", "total_price")])
        .select("age_group", "day_type", money("_rev", "total_revenue"))
        .orderBy("age_group", "day_type")
    )


__all__ = [
    "q2_demographics", "q3_category_occupation", "q4_gender_age_quarter", "q6_city_marital_recent",
    "q7_avg_purchase", "q10_age_daytype",
]
