"""Daily revenue spikes against the product's average selling day.

The average over a product's selling days is a window over the daily rows of
that product (at most one row per calendar day), not a second aggregate
joined back.  The spike test ``daily > factor x avg`` is evaluated exactly as
``daily_cents x n > factor x sum_cents`` in integers: at the test scale 15
days sit exactly on 2 x the average and a floating average mis-flags some.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.exprs import as_double, cents, format_cents, round_half_up
from tillroll.plans.common import fact, money
from tillroll.warehouse import Star

# Flag and message texts of the two spike reports.
SPIKE_FLAG = "OUTLIER - Spike Detected"
SPIKE_STATUS = "Spike / Outlier"
NORMAL = "Normal"
SPIKE_PREFIX = "Sales spike: "
SPIKE_MIDDLE = " exceeds {factor}x average of "


def _daily(star: Star) -> DataFrame:
    daily = fact(star, "product_sk", "date_sk", "total_price").groupBy("product_sk", "date_sk").agg(
        F.sum("total_price").alias("_day")
    )
    w = Window.partitionBy("product_sk")
    return (
        daily.withColumn("_c", cents("_day"))
        .withColumn("_sum_c", F.sum("_c").over(w))
        .withColumn("_days", F.count(F.lit(1)).over(w))
    )


def _is_spike(factor: int) -> F.Column:
    return F.col("_c") * F.col("_days") > F.lit(factor) * F.col("_sum_c")


def _avg() -> F.Column:
    return (as_double("_sum_c") / 100.0 / as_double("_days")).alias("avg_daily_revenue")


def q19_spikes(star: Star, factor: int = 2) -> DataFrame:
    spikes = _daily(star).where(_is_spike(factor))
    avg_cents = F.expr("(2 * _sum_c + _days) div (2 * _days)")  # half-up, whole cents
    text = F.concat(
        F.lit(SPIKE_PREFIX), format_cents("_c"), F.lit(SPIKE_MIDDLE.format(factor=factor)), format_cents(avg_cents)
    )
    return (
        spikes.join(star.product_dim.select("product_sk", "product_id", "product_category"), "product_sk")
        .join(star.date_dim.select("date_sk", F.col("date").alias("date_value")), "date_sk")
        .select(
            "product_id", "product_category", "date_value",
            money("_day", "daily_revenue"), _avg(),
            F.lit(SPIKE_FLAG).alias("anomaly_flag"), text.alias("explanation"),
        )
        .orderBy("product_category", "product_id", F.col("date_value").desc())
    )


def q19_spike_flags(star: Star, factor: int = 2) -> DataFrame:
    daily = _daily(star)
    multiple = F.try_divide(as_double("_c") * as_double("_days"), as_double("_sum_c"))
    return (
        daily.join(star.product_dim.select("product_sk", "product_id"), "product_sk")
        .join(star.date_dim.select("date_sk", F.col("date").alias("date_value")), "date_sk")
        .select(
            "product_id", "date_value", money("_day", "daily_revenue"), _avg(),
            F.when(_is_spike(factor), F.lit(SPIKE_STATUS)).otherwise(F.lit(NORMAL)).alias("status"),
            round_half_up(multiple).alias("multiple_of_avg"),
        )
        .orderBy("product_id", "date_value")
    )
