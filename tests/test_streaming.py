"""Stream = batch, and a replayed micro-batch changes nothing."""

from __future__ import annotations

import os

from conftest import SF_SMALL
from pyspark.sql import functions as F

from tillroll.schemas import TRANSACTIONS
from tillroll.sources import testdata
from tillroll.sources.transactions import stream_transactions
from tillroll.streaming.pipeline import run_to_end
from tillroll.warehouse import Star, Warehouse


def natural_facts(star: Star):
    """Fact rows expressed in natural keys (surrogates depend on batch cuts)."""
    f = star.sales_fact
    out = (
        f.join(star.customer_dim.select("customer_sk", "customer_id"), "customer_sk")
        .join(star.product_dim.select("product_sk", "product_id", "store_id", "supplier_id"), "product_sk")
        .join(star.date_dim.select("date_sk", "date"), "date_sk")
        .select("order_id", "customer_id", "product_id", "store_id", "supplier_id", "date", "quantity", "total_price")
    )
    return sorted(map(tuple, out.collect()))


def test_stream_equals_batch_and_replay(spark, tmp_path):
    from tillroll.etl import testdata_star

    src = str(tmp_path / "incoming")
    tx = testdata.transactions(spark, SF_SMALL)
    # Four files cut by order date, so batches bring new dates and products.
    tx.withColumn("_f", F.year("date") % 4).repartition(4, "_f").drop("_f").write.parquet(src)
    pm, cm = testdata.product_master(spark, SF_SMALL), testdata.customer_master(spark, SF_SMALL)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    ckpt = str(tmp_path / "ckpt")

    stream = stream_transactions(spark, src, fmt="parquet", max_files_per_trigger=1, schema=TRANSACTIONS)
    results = run_to_end(wh, stream, pm, cm, ckpt)
    assert len(results) >= 2
    assert sum(r.matched_rows for r in results) == tx.count()

    batch = testdata_star(spark, SF_SMALL)
    assert natural_facts(wh.star()) == natural_facts(batch)
    for t in ("customer_dim", "product_dim", "store_dim", "supplier_dim", "date_dim"):
        nat = {"customer_dim": "customer_id", "product_dim": "product_id", "store_dim": "store_id",
               "supplier_dim": "supplier_id", "date_dim": "date"}[t]
        d = wh.read(t)
        assert d.count() == d.select(nat).distinct().count() == getattr(batch, t).count()
        assert sorted(r[0] for r in d.select(d.columns[0]).collect()) == list(range(1, d.count() + 1))

    # Crash after the last batch's tables but before its commit: drop the
    # commit marker, restart, and the last batch is replayed.
    commits = os.path.join(ckpt, "commits")
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    before = natural_facts(wh.star()), sorted(map(tuple, wh.read("product_dim").collect()))
    replay = run_to_end(wh, stream_transactions(spark, src, fmt="parquet", max_files_per_trigger=1, schema=TRANSACTIONS),
                        pm, cm, ckpt)
    assert [r.batch_id for r in replay] == [last]
    after = natural_facts(wh.star()), sorted(map(tuple, wh.read("product_dim").collect()))
    assert after == before


def test_csv_backfill_in_bounded_batches(spark, tmp_path):
    from tillroll.streaming.pipeline import backfill

    src = str(tmp_path / "csv")
    tx = testdata.transactions(spark, SF_SMALL)
    raw = tx.select(
        F.col("order_id").alias("orderID"), F.col("customer_id").alias("Customer_ID"),
        F.col("product_id").alias("Product_ID"), F.col("quantity").cast("string").alias("quantity"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
    )
    raw.repartition(6).write.option("header", True).csv(src)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    pm, cm = testdata.product_master(spark, SF_SMALL), testdata.customer_master(spark, SF_SMALL)
    results = backfill(wh, src, pm, cm, str(tmp_path / "ckpt"), fmt="csv", max_bytes_per_trigger=40_000)
    assert len(results) >= 2
    assert sum(r.input_rows for r in results) == tx.count() == wh.read("sales_fact").count()
    assert sum(r.quarantined_rows for r in results) == 0


def test_stream_dedup_drops_repeated_lines_only(spark, tmp_path):
    from tillroll.streaming.pipeline import start_ingest

    src = str(tmp_path / "dup")
    tx = testdata.transactions(spark, SF_SMALL)
    tx.write.parquet(src + "/a")
    tx.where(F.col("quantity") > 40).write.parquet(src + "/b")  # the same lines again
    wh = Warehouse(spark, str(tmp_path / "wh"))
    pm, cm = testdata.product_master(spark, SF_SMALL), testdata.customer_master(spark, SF_SMALL)
    stream = stream_transactions(spark, src + "/*", fmt="parquet", max_files_per_trigger=1, schema=TRANSACTIONS)
    keys = ["order_id", "customer_id", "product_id", "quantity", "date"]
    q = start_ingest(wh, stream, pm, cm, str(tmp_path / "ckpt"), dedup_keys=keys)
    q.awaitTermination()
    assert wh.read("sales_fact").count() == tx.dropDuplicates(keys).count()


def test_stream_after_batch_load_does_not_overwrite(spark, tmp_path):
    from tillroll.etl import load_batch, testdata_star

    tx = testdata.transactions(spark, SF_SMALL)
    early = F.col("date") < F.lit("1998-01-01").cast("date")
    pm, cm = testdata.product_master(spark, SF_SMALL), testdata.customer_master(spark, SF_SMALL)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    load_batch(wh, tx.where(early), pm, cm, 0)
    src = str(tmp_path / "later")
    tx.where(~early).repartition(2).write.parquet(src)
    ckpt = str(tmp_path / "ckpt")
    stream = stream_transactions(spark, src, fmt="parquet", max_files_per_trigger=1, schema=TRANSACTIONS)
    results = run_to_end(wh, stream, pm, cm, ckpt)
    assert [r.batch_id for r in results] == [1, 2]
    assert wh.read("sales_fact").count() == tx.count()
    assert natural_facts(wh.star()) == natural_facts(testdata_star(spark, SF_SMALL))
