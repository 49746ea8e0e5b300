"""Uniqueness and reference checks over a loaded star.

Parquet enforces no keys, so the reference's PRIMARY KEY / UNIQUE / FOREIGN
KEY declarations become a report: one row per constraint with the number of
violating rows.  Each check is an aggregate or an anti join -- distributed,
nothing collected.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.schemas import DIMENSIONS
from tillroll.warehouse import Star


def _dup_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows whose (non-null) key value occurs more than once."""
    return (
        df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1).agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("violations"))
    )


def _orphans(star: Star) -> DataFrame:
    """Fact rows whose key a dimension lacks, for all references in one scan.

    Rows are counted per (reference, key) first (partial aggregation), so the
    anti join sees one row per distinct key and not every fact row.
    """
    refs = {sk: table for table, (_, _, sk) in DIMENSIONS.items()}
    label = lambda sk: F.lit(f"sales_fact.{sk} references {refs[sk]}")
    each = F.explode(F.array(*[F.struct(label(sk).alias("check_name"), F.col(sk).alias("k")) for sk in refs]))
    used = star.sales_fact.select(each.alias("r")).select("r.*").where("k IS NOT NULL")
    used = used.groupBy("check_name", "k").agg(F.count(F.lit(1)).alias("_n"))
    known = reduce(DataFrame.unionByName, [getattr(star, t).select(label(sk).alias("check_name"), F.col(sk).alias("k")) for sk, t in refs.items()])
    lost = used.join(known, ["check_name", "k"], "left_anti").select("check_name", "_n")
    none = used.sparkSession.createDataFrame([(f"sales_fact.{sk} references {t}", 0) for sk, t in refs.items()], "check_name string, _n bigint")
    return lost.unionByName(none).groupBy("check_name").agg(F.sum("_n").cast("bigint").alias("violations"))


def constraint_report(star: Star) -> DataFrame:
    checks: list[DataFrame] = [_orphans(star)]
    for table, (_, natural, sk) in DIMENSIONS.items():
        dim = getattr(star, table)
        checks.append(_dup_rows(dim, sk).select(F.lit(f"{table}.{sk} primary key").alias("check_name"), "violations"))
        checks.append(_dup_rows(dim, natural).select(F.lit(f"{table}.{natural} unique").alias("check_name"), "violations"))
    pk = _dup_rows(star.sales_fact, "sale_id")
    checks.append(pk.select(F.lit("sales_fact.sale_id primary key").alias("check_name"), "violations"))
    return reduce(DataFrame.unionByName, checks)


def broken_star(star: Star) -> Star:
    """The star with dimension rows missing and repeated by fixed rules, to see the report find them."""
    c, s, u, f = star.customer_dim, star.store_dim, star.supplier_dim, star.sales_fact
    return replace(
        star,
        sales_fact=f.unionByName(f.where("cast(order_id as bigint) % 13 = 4")),
        store_dim=s.unionByName(s.where("store_sk % 4 = 1").withColumn("store_sk", F.col("store_sk") + 1000)),
        supplier_dim=u.unionByName(u.where("supplier_sk % 3 = 2").withColumn("supplier_id", F.lit("again"))),
        product_dim=star.product_dim.where("product_sk % 7 <> 3"),
        date_dim=star.date_dim.where("date_sk % 5 <> 1"),
        customer_dim=c.unionByName(c.where("customer_sk % 11 = 0")),
    )
