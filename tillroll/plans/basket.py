"""The n product pairs bought together most often.

The reference counts *row* pairs: two lines of products a and b in one order
(a's key below b's) count once each, so a product on two lines of an order
counts twice.  With ``m_a(o)`` lines of a in order o the count is
``C(a, b) = sum_o m_a(o) * m_b(o)``.  Pairs rank by
``(C desc, product_a, product_b)`` (ids as text; the reference leaves ties open).

One way at every size:

1. The fact is collapsed once to basket lines ``(order, product, m)``, a narrow
   table in the shared folder that the steps below read.
2. With ``s(a) = sum_o m_a(o)^2``, no pair of products counts more than
   ``sqrt(s(a) s(b))``.  The ``SEED`` products of largest ``s`` are paired among
   themselves; their n-th best count ``T`` is a lower bound of the final n-th
   count, so products with ``s(a) max(s) < T^2`` can be in no answer and go.
3. An order of up to ``BLOCK`` products is one array, and its pairs are made
   inside the row.  A larger order is cut into blocks and joined on (order,
   block, block): its pairs are made by as many tasks as it has pairs of blocks,
   and no row holds more than a block.
4. Pairs are counted with partial aggregation; ids are joined onto pairs that
   reach the n-th largest count.

Nothing is cached: what is collected is ``SEED`` products and ``n`` counts, and
a later call reads the tables as they are then.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.plans.common import fact
from tillroll.session import fs_delete, shared_path
from tillroll.warehouse import Star

SEED = 64
BLOCK = 128


def basket_lines(star: Star) -> DataFrame:
    return fact(star, "order_id", "product_sk").groupBy("order_id", "product_sk").agg(F.count(F.lit(1)).alias("m"))


def _counted(pairs: DataFrame) -> DataFrame:
    """C(a, b) from (sk_1, m_1, sk_2, m_2) rows."""
    return pairs.groupBy(F.least("sk_1", "sk_2").alias("sk_a"), F.greatest("sk_1", "sk_2").alias("sk_b")).agg(
        F.sum(F.col("m_1") * F.col("m_2")).alias("times_bought_together")
    )


def pairs_inside(lines: DataFrame) -> DataFrame:
    """Pairs of the lines of each order, made from one array an order."""
    orders = lines.groupBy("order_id").agg(F.collect_list(F.struct("product_sk", "m")).alias("ps")).where(F.size("ps") > 1)
    first = orders.select("ps", F.posexplode("ps").alias("i", "x"))
    rest = F.slice("ps", F.col("i") + 2, F.size("ps"))
    return first.select(F.col("x.product_sk").alias("sk_1"), F.col("x.m").alias("m_1"), F.explode(rest).alias("y")).select(
        "sk_1", "m_1", F.col("y.product_sk").alias("sk_2"), F.col("y.m").alias("m_2")
    )


def pairs_across(lines: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """Pairs of the lines of orders with ``_d`` products, joined block by block."""
    blocks = F.ceil(F.col("_d") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("product_sk"), blocks.cast("bigint")).cast("int")
    cut = lines.join(sizes, "order_id").select("order_id", "product_sk", "m", blocks.alias("_blocks"), own.alias("_own"))
    a = cut.select(
        "order_id", F.col("_own").alias("i"), F.explode(F.sequence("_own", F.col("_blocks") - 1)).alias("j"),
        F.col("product_sk").alias("sk_1"), F.col("m").alias("m_1"),
    )
    b = cut.select(
        "order_id", F.explode(F.sequence(F.lit(0), "_own")).alias("i"), F.col("_own").alias("j"),
        F.col("product_sk").alias("sk_2"), F.col("m").alias("m_2"),
    )
    met = a.join(b, ["order_id", "i", "j"]).where((F.col("i") < F.col("j")) | (F.col("sk_1") < F.col("sk_2")))
    return met.select("sk_1", "m_1", "sk_2", "m_2")


def pair_counts(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """C(a, b) for every pair of product keys a < b sharing an order."""
    large = lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("_d")).where(F.col("_d") > F.lit(block))
    usual = lines.join(large.select("order_id"), "order_id", "left_anti")
    return _counted(pairs_inside(usual).unionByName(pairs_across(lines, large, block)))


def _nth_count(counts: DataFrame, n: int) -> int:
    """The n-th largest count, 0 if there are fewer pairs."""
    top = counts.select("times_bought_together").orderBy(F.col("times_bought_together").desc()).limit(n).collect()
    return int(top[-1][0]) if len(top) == n else 0


def q16_basket_pairs(star: Star, n: int = 5, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """Top-n product pairs (see the module notes)."""
    spark = star.sales_fact.sparkSession
    folder = shared_path(spark, "basket", uuid.uuid4().hex)
    basket_lines(star).write.parquet(f"{folder}/lines")
    try:
        lines = spark.read.schema("order_id string, product_sk bigint, m bigint").parquet(f"{folder}/lines")
        squares = lines.groupBy("product_sk").agg(F.sum(F.col("m") * F.col("m")).cast("decimal(38,0)").alias("s"))
        top = squares.orderBy(F.col("s").desc(), "product_sk").limit(max(seed, n + 1)).collect()
        least = _nth_count(pair_counts(lines.where(F.col("product_sk").isin([r[0] for r in top])), block), n) if top else 0
        kept = lines
        if least > 1:
            enough = squares.where(F.col("s") * F.lit(int(top[0]["s"])).cast("decimal(38,0)") >= F.lit(least * least).cast("decimal(38,0)"))
            kept = lines.join(enough, "product_sk", "left_semi")
        ids = star.product_dim.select("product_sk", "product_id")
        best = (
            pair_counts(kept, block)
            .where(F.col("times_bought_together") >= F.lit(least))
            .join(ids.select(F.col("product_sk").alias("sk_a"), F.col("product_id").alias("id_a")), "sk_a")
            .join(ids.select(F.col("product_sk").alias("sk_b"), F.col("product_id").alias("id_b")), "sk_b")
            .select(F.least("id_a", "id_b").alias("product_a"), F.greatest("id_a", "id_b").alias("product_b"), "times_bought_together")
        )
        order = [F.col("times_bought_together").desc(), "product_a", "product_b"]
        best.orderBy(*order).limit(n).coalesce(1).write.parquet(f"{folder}/best")
    finally:
        fs_delete(spark, f"{folder}/lines")
    return spark.read.schema("product_a string, product_b string, times_bought_together bigint").parquet(f"{folder}/best").orderBy(*order)
