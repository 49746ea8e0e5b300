"""Top-N per group.

``row_number() <= n`` over a partitioned window is planned by Spark as a
``WindowGroupLimit`` before the shuffle as well as after it, so each group
ships at most n rows per map task: a huge group never reaches one task whole.
Ties in revenue are broken by the entity id (the reference leaves them open).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.plans.common import by_customer, dates, fact, money
from tillroll.warehouse import Star


def _top(df: DataFrame, part: list[str], tie: list[str], n: int) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(F.col("_rev").desc(), *[F.col(c).asc_nulls_first() for c in tie])
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)


def q1_top_products_daytype(star: Star, year: int = 2015, n: int = 5) -> DataFrame:
    """Per year, month and weekday/weekend: the n products with most revenue."""
    f = fact(star, "product_sk", "date_sk", "total_price", year=year)
    d = dates(star, "year", "month", "day_type", year=year)
    per_product = (
        f.join(d, "date_sk")
        .groupBy("year", "month", "day_type", "product_sk")
        .agg(F.sum("total_price").alias("_rev"))
        .join(star.product_dim.select("product_sk", "product_id"), "product_sk")
    )
    return (
        _top(per_product, ["year", "month", "day_type"], ["product_id"], n)
        .select("year", "month", "day_type", "product_id", money("_rev", "revenue"))
        .orderBy("year", "month", "day_type", F.col("revenue").desc(), "product_id")
    )


def category_by_customer(star: Star, attr: str) -> DataFrame:
    """Revenue ``_rev`` and quantity ``_qty`` by (product_category, a customer attribute), raw group values."""
    rows = fact(star, "product_sk", "customer_sk", "total_price", "quantity").join(
        star.product_dim.select("product_sk", "product_category"), "product_sk"
    )
    customers = star.customer_dim.select("customer_sk", attr)
    out = by_customer(rows, customers, ["product_category"], [("_rev", "total_price"), ("_qty", "quantity")])
    return out.withColumn("_qty", F.col("_qty").cast("bigint"))


def q5_top_occupations(star: Star, n: int = 5) -> DataFrame:
    rev = category_by_customer(star, "occupation")
    return (
        _top(rev, ["product_category"], ["occupation"], n)
        .select("product_category", "occupation", money("_rev", "revenue"))
        .orderBy("product_category", F.col("revenue").desc(), "occupation")
    )


def q8_top_cities(star: Star, n: int = 5) -> DataFrame:
    """As A5 by city; the rank ``rn`` is part of the output (``SELECT *``)."""
    rev = category_by_customer(star, "city_category")
    return (
        _top(rev, ["product_category"], ["city_category"], n)
        .select("product_category", "city_category", money("_rev", "revenue"), F.col("rn").cast("int").alias("rn"))
        .orderBy("product_category", F.col("revenue").desc(), "city_category")
    )


def q11_top_products_category(star: Star, year: int = 2020, n: int = 5) -> DataFrame:
    f = fact(star, "product_sk", "date_sk", "total_price", year=year)
    d = dates(star, F.col("month").alias("mon"), "day_type", year=year)
    per_product = (
        f.join(d, "date_sk")
        .groupBy("mon", "day_type", "product_sk")
        .agg(F.sum("total_price").alias("_rev"))
        .join(star.product_dim.select("product_sk", "product_id", "product_category"), "product_sk")
    )
    return (
        _top(per_product, ["mon", "day_type"], ["product_id"], n)
        .select("mon", "day_type", "product_id", "product_category", money("_rev", "revenue"))
        .orderBy("mon", "day_type", F.col("revenue").desc(), "product_id")
    )
