"""Multi-level and pivoted totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.exprs import as_double, mean, season_rank
from tillroll.plans.common import dates, fact, money, revenue_aggs, rollup_aggs
from tillroll.warehouse import Star


def _valued(prefix: str = "") -> list[F.Column]:
    return [
        money("_rev", f"total_{prefix}sales" if prefix else "total_sales"),
        F.col("_qty").alias("total_quantity"),
        F.col("_n").alias("transaction_count"),
        mean("_rev", "_n").alias("avg_transaction_value"),
    ]


def q13_store_supplier_product(star: Star) -> DataFrame:
    # (store_sk, supplier_sk, product_sk) maps one-to-one onto the six output
    # attributes, so one aggregation on keys is the whole grouping.
    per_key = fact(star, "store_sk", "supplier_sk", "product_sk", "total_price", "quantity").groupBy(
        "store_sk", "supplier_sk", "product_sk"
    ).agg(*revenue_aggs())
    s = star.store_dim.where(F.col("store_id").isNotNull()).select("store_sk", "store_id", "store_name")
    p = star.supplier_dim.where(F.col("supplier_id").isNotNull()).select("supplier_sk", "supplier_id", "supplier_name")
    pr = star.product_dim.select("product_sk", "product_id", "product_category")
    return (
        per_key.join(s, "store_sk").join(p, "supplier_sk").join(pr, "product_sk")
        .select("store_id", "store_name", "supplier_id", "supplier_name", "product_id", "product_category", *_valued())
        .orderBy("store_name", "supplier_name", "product_category", F.col("total_sales").desc())
    )


def q14_seasonal(star: Star) -> DataFrame:
    f = fact(star, "product_sk", "date_sk", "total_price", "quantity")
    per_key = (
        f.join(dates(star, "season"), "date_sk")
        .groupBy("product_sk", "season")
        .agg(*revenue_aggs())
        .where(F.col("season").isNotNull())
    )
    pr = star.product_dim.select("product_sk", "product_id", "product_category")
    return (
        per_key.join(pr, "product_sk")
        .select("product_id", "product_category", "season", *_valued())
        .orderBy("product_category", "product_id", season_rank("season"))
    )


def q17_rollup(star: Star) -> DataFrame:
    """ROLLUP(year, store, supplier, category) with ``level_id`` = grouping_id().

    The finest level is aggregated first on keys, so the rollup's row
    expansion runs over that small result rather than over the fact.
    ``sale_year`` is year(date) of the row, i.e. ``date_dim.year``.
    """
    per_key = fact(star, "sale_year", "store_sk", "supplier_sk", "product_sk", "total_price", "quantity").groupBy(
        "sale_year", "store_sk", "supplier_sk", "product_sk"
    ).agg(*revenue_aggs())
    base = (
        per_key.join(star.store_dim.select("store_sk", "store_name"), "store_sk")
        .join(star.supplier_dim.select("supplier_sk", "supplier_name"), "supplier_sk")
        .join(star.product_dim.select("product_sk", "product_category"), "product_sk")
        .groupBy(F.col("sale_year").alias("year"), "store_name", "supplier_name", "product_category")
        .agg(*rollup_aggs())
    )
    keys = ["year", "store_name", "supplier_name", "product_category"]
    return (
        base.rollup(*keys)
        .agg(*rollup_aggs(), F.grouping_id().alias("level_id"))
        .select(*keys, money("_rev", "total_revenue"), F.col("_qty").alias("total_quantity"),
                F.col("_n").alias("transaction_count"), "level_id")
        .orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    )


def q18_half_year(star: Star) -> DataFrame:
    """H1 / H2 / all-time totals per product; an empty half stays NULL."""
    f = fact(star, "product_sk", "date_sk", "total_price", "quantity")
    m = F.col("month")
    h1, h2 = m.between(1, 6), m.between(7, 12)
    per_product = (
        f.join(dates(star, "month"), "date_sk")
        .groupBy("product_sk")
        .agg(
            F.sum(F.when(h1, F.col("total_price"))).alias("_h1r"),
            F.sum(F.when(h1, F.col("quantity"))).cast("bigint").alias("h1_quantity"),
            F.sum(F.when(h2, F.col("total_price"))).alias("_h2r"),
            F.sum(F.when(h2, F.col("quantity"))).cast("bigint").alias("h2_quantity"),
            F.sum("total_price").alias("_yr"),
            F.sum("quantity").cast("bigint").alias("yearly_quantity"),
        )
    )
    return (
        per_product.join(star.product_dim.select("product_sk", "product_id", "product_category"), "product_sk")
        .select(
            "product_id", "product_category",
            as_double("_h1r").alias("h1_revenue"), "h1_quantity",
            as_double("_h2r").alias("h2_revenue"), "h2_quantity",
            as_double("_yr").alias("yearly_revenue"), "yearly_quantity",
        )
        .orderBy(F.col("yearly_revenue").desc())
    )
