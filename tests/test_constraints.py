"""Keys on offer against the filters of stored keys."""

from __future__ import annotations

from conftest import customer, product, tx
from pyspark.sql import functions as F

from tillroll.etl import load_batch
from tillroll.operators import constraints as C
from tillroll.schemas import CUSTOMER_MASTER, PRODUCT_MASTER, TRANSACTIONS


def test_filters_miss_no_stored_key_and_few_others_pass(spark, wh):
    keys = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("sale_id"))
    for batch, (lo, hi) in enumerate([(0, 5000), (5000, 5100), (10_000, 30_000)]):
        rows = keys(lo, hi).withColumn("sale_year", F.lit(2020))
        for f in ("order_id", "customer_sk", "product_sk", "store_sk", "supplier_sk", "date_sk", "quantity", "total_price"):
            rows = rows.withColumn(f, F.lit(None).cast("string"))
        wh.write("sales_fact", rows, batch)
        C.note_keys(wh, batch)
        wh.commit(batch, {})
    offered = keys(0, 60_000).select(F.lit(C.SALE).alias("kind"), F.col("sale_id").cast("string").alias("key"))
    may = C.candidates(wh, offered, wh.done()).where(F.col("kind") == C.SALE)
    held = may.where("cast(key as bigint) < 5000 and batch_id = 0").count(), may.where("cast(key as bigint) between 10000 and 29999 and batch_id = 2").count()
    assert held == (5000, 20_000)
    assert may.count() - 25_100 < 0.02 * 3 * 60_000  # two in a hundred at most pass wrongly
    got = C.stored(wh, offered, wh.done())
    assert got.count() == 25_100 and got.agg(F.max(F.col("key").cast("bigint"))).first()[0] == 29_999
    words = wh.read("key_filters").groupBy("batch_id").agg(F.max("words").alias("w")).collect()
    assert {r.batch_id: r.w for r in words} == {0: 11, 1: 5, 2: 13}


def test_report_of_a_load(spark, wh):
    pm, cm = spark.createDataFrame([product("p1")], PRODUCT_MASTER), spark.createDataFrame([customer("c1")], CUSTOMER_MASTER)
    lines = spark.createDataFrame([tx(f"o{i}", "c1", "p1", 1, "2020-01-01") for i in range(4)], TRANSACTIONS)
    load_batch(wh, lines, pm, cm, 0, maintain=[C.note_keys])
    fact, dim = wh.star().sales_fact, wh.star().customer_dim
    clean = C.check_load(wh, {"sales_fact": fact.withColumn("sale_id", -F.col("sale_id") - 1)}, 1).collect()
    assert len(clean) == 6 and all(r.violations == 0 for r in clean)
    bad = {
        "sales_fact": fact.where("order_id = 'o1'").unionByName(fact.withColumn("sale_id", F.lit(-7)).withColumn("store_sk", F.lit(99))),
        "customer_dim": dim.withColumn("customer_sk", F.lit(5)),
    }
    got = {r.check_name: r.violations for r in C.check_load(wh, bad, 1).collect()}
    assert got[f"{C.SALE} unique"] == 5 and got["customer_dim.customer_id unique"] == 1 and got["customer_dim.customer_sk unique"] == 0
    assert got["sales_fact references store_dim.store_sk"] == 4 and got["sales_fact references customer_dim.customer_sk"] == 0
    # the last batch run again is not held against itself
    assert C.check_load(wh, {"customer_dim": dim}, 0).agg(F.sum("violations")).first()[0] == 0
    null = fact.withColumn("store_sk", F.lit(None).cast("bigint")).withColumn("sale_id", F.lit(None).cast("bigint"))
    assert C.check_load(wh, {"sales_fact": null}, 1).agg(F.sum("violations")).first()[0] == 0
