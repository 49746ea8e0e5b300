"""Star-join building blocks shared by the analytics.

Two habits run through the plans:

* **Prune early.** Year-filtered queries filter the fact's ``sale_year``
  partition column as well as ``date_dim.year``, so the scan reads only that
  year's directories.
* **Aggregate on keys, then join.** Where the grouping is coarser than the
  fact (per day, month, product ...), the fact is aggregated on surrogate
  keys first (partial aggregation map-side) and the dimensions are joined to
  the much smaller result.  Dimension attributes are functions of their key,
  so the groups are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.exprs import as_double, day_type, season
from tillroll.warehouse import Star


def fact(star: Star, *cols: str, year: int | None = None, years: list[int] | None = None) -> DataFrame:
    """The fact's columns, optionally pruned to some ``sale_year`` partitions."""
    f = star.sales_fact
    if year is not None:
        f = f.where(F.col("sale_year") == F.lit(year))
    if years is not None:
        f = f.where(F.col("sale_year").isin(years) if years else F.lit(False))
    return f.select(*cols)


def dates(star: Star, *attrs: str | Column, year: int | None = None) -> DataFrame:
    """date_dim projected to date_sk + derived attributes (by name)."""
    d = star.date_dim
    if year is not None:
        d = d.where(F.col("year") == F.lit(year))
    derived = {
        "day_type": day_type("date").alias("day_type"),
        "quarter": F.quarter("date").alias("quarter"),
        "season": season("month").alias("season"),
    }
    return d.select("date_sk", *[derived.get(a, a) if isinstance(a, str) else a for a in attrs])


def money(c: str, alias: str | None = None) -> Column:
    return as_double(c).alias(alias or c)


def revenue_aggs(price: str = "total_price", qty: str = "quantity") -> list[Column]:
    """Exact sums plus a row count: the building block of every average."""
    return [
        F.sum(price).alias("_rev"),
        F.sum(qty).cast("bigint").alias("_qty"),
        F.count(F.lit(1)).alias("_n"),
    ]


def rollup_aggs() -> list[Column]:
    """Re-aggregate ``revenue_aggs`` partials."""
    return [
        F.sum("_rev").alias("_rev"),
        F.sum("_qty").cast("bigint").alias("_qty"),
        F.sum("_n").cast("bigint").alias("_n"),
    ]


def by_customer(
    rows: DataFrame, customers: DataFrame, keys: list[str], measures: list[tuple[str, str | None]]
) -> DataFrame:
    """Aggregate fact-side ``rows`` (with ``customer_sk``) by ``keys`` plus the
    attributes in ``customers``.  ``measures`` are (name, column) sums, or
    (name, None) row counts.

    The rows are first aggregated per (customer, keys) -- sums and counts
    re-aggregate exactly -- so that the join moves one row per customer and key
    and not every line, whatever the size of the customer dimension.
    """
    attrs = [c for c in customers.columns if c != "customer_sk"]

    def agg(col: str | None, name: str) -> Column:
        return (F.count(F.lit(1)) if col is None else F.sum(col)).alias(name)

    partial = rows.groupBy("customer_sk", *keys).agg(*[agg(c, n) for n, c in measures])
    return (
        partial.join(customers, "customer_sk")
        .groupBy(*keys, *attrs)
        .agg(*[F.sum(n).alias(n) for n, _ in measures])
    )
