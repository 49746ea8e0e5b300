"""ETL operators: keys, dimensions, quarantine, fact."""

from __future__ import annotations

from conftest import M, customer, product, tx
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.etl import load_batch
from tillroll.operators.keys import dense_keys
from tillroll.schemas import CUSTOMER_MASTER, PRODUCT_MASTER, TRANSACTIONS


def test_dense_keys_equal_row_number(spark):
    df = spark.range(0, 5000).select(F.format_string("id%05d", (F.col("id") * 7919) % 5000).alias("k"))
    want = df.withColumn("sk", F.row_number().over(Window.orderBy("k")) + 100)
    distributed = dense_keys(df, ["k"], "sk", start=100, num_partitions=7)
    single = dense_keys(df, ["k"], "sk", start=100)
    for got in (distributed, single):
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_dense_keys_empty(spark):
    df = spark.createDataFrame([], "k string")
    assert dense_keys(df, ["k"], "sk").count() == 0
    assert dense_keys(df, ["k"], "sk").count() == 0


def test_unmatched_rows_are_quarantined(load, wh):
    star = load(
        [product("p1")],
        [customer("c1")],
        [tx("o1", "c1", "p1", 2, "2020-01-05"), tx("o2", "c1", "nope", 1, "2020-01-05"),
         tx("o3", "ghost", "p1", 1, "2020-01-05"), tx("o4", "c1", "p1", None, "2020-01-05"),
         tx("o5", "c1", "p1", 1, None)],
    )
    q = {r.order_id: r.reason for r in wh.read("quarantine").collect()}
    assert q == {"o2": "unmatched_product", "o3": "unmatched_customer", "o4": "malformed_quantity",
                 "o5": "malformed_date"}
    facts = star.sales_fact.collect()
    assert [f.order_id for f in facts] == ["o1"]
    assert facts[0].total_price == M("20.00")


def test_raw_csv_malformed_values(spark, tmp_path, wh):
    from tillroll.sources.transactions import read_transactions

    p = tmp_path / "tx.csv"
    p.write_text("orderID,Customer_ID,Product_ID,quantity,date\n"
                 "o1,c1,p1,3,2020-02-01\no2,c1,p1,x,2020-02-01\no3,c1,p1,1,2020-13-01\n")
    t = read_transactions(spark, str(p))
    pm = spark.createDataFrame([product("p1", price="1.10")], PRODUCT_MASTER)
    cm = spark.createDataFrame([customer("c1")], CUSTOMER_MASTER)
    r = load_batch(wh, t, pm, cm, 0)
    assert (r.input_rows, r.matched_rows, r.quarantined_rows) == (3, 1, 2)
    q = {x.order_id: x.reason for x in wh.read("quarantine").collect()}
    assert q == {"o2": "malformed_quantity", "o3": "malformed_date"}
    assert wh.read("sales_fact").first().total_price == M("3.30")


def test_first_write_wins_and_incremental_keys(spark, wh):
    pm1 = spark.createDataFrame([product("p2", cat="old"), product("p1")], PRODUCT_MASTER)
    cm = spark.createDataFrame([customer("c1")], CUSTOMER_MASTER)
    t1 = spark.createDataFrame([tx("o1", "c1", "p2", 1, "2020-01-01"), tx("o2", "c1", "p1", 1, "2020-01-02")], TRANSACTIONS)
    load_batch(wh, t1, pm1, cm, 0)
    # Batch 1: p2 comes back with new attributes, p0 is new.
    pm2 = spark.createDataFrame([product("p2", cat="new"), product("p0")], PRODUCT_MASTER)
    t2 = spark.createDataFrame([tx("o3", "c1", "p2", 1, "2020-01-03"), tx("o4", "c1", "p0", 1, "2020-01-03")], TRANSACTIONS)
    load_batch(wh, t2, pm2, cm, 1)
    dim = {r.product_id: (r.product_sk, r.product_category, r.batch_id) for r in wh.read("product_dim").collect()}
    assert dim == {"p1": (1, "Cat", 0), "p2": (2, "old", 0), "p0": (3, "Cat", 1)}
    dates = sorted((r.date.isoformat(), r.date_sk) for r in wh.read("date_dim").collect())
    assert dates == [("2020-01-01", 1), ("2020-01-02", 2), ("2020-01-03", 3)]
    assert wh.read("customer_dim").count() == 1


def test_replaying_a_batch_changes_nothing(spark, wh):
    pm = spark.createDataFrame([product("p1"), product("p2", store="S2")], PRODUCT_MASTER)
    cm = spark.createDataFrame([customer("c1"), customer("c2")], CUSTOMER_MASTER)
    t0 = spark.createDataFrame([tx("o1", "c1", "p1", 1, "2020-01-01")], TRANSACTIONS)
    t1 = spark.createDataFrame([tx("o2", "c2", "p2", 2, "2020-01-02"), tx("o2", "c2", "p1", 1, "2020-01-02")], TRANSACTIONS)
    load_batch(wh, t0, pm, cm, 0)
    load_batch(wh, t1, pm, cm, 1)

    def snapshot():
        tabs = {}
        for t in ("customer_dim", "product_dim", "store_dim", "date_dim", "sales_fact"):
            cols = [c for c in wh.read(t).columns if c != "sale_id"]
            tabs[t] = sorted(map(tuple, wh.read(t).select(*cols).collect()))
        return tabs

    before = snapshot()
    load_batch(wh, t1, pm, cm, 1)  # replay the last batch
    assert snapshot() == before


def test_store_name_conflict_takes_smallest_product(load):
    star = load(
        [product("p2", store="S1", store_name="Beta"), product("p1", store="S1", store_name="Alpha")],
        [customer("c1")],
        [tx("o1", "c1", "p2", 1, "2020-01-01"), tx("o2", "c1", "p1", 1, "2020-01-01")],
    )
    assert [(r.store_id, r.store_name) for r in star.store_dim.collect()] == [("S1", "Alpha")]


def test_keep_last_master_row_from_csv(spark, tmp_path):
    from tillroll.sources.masters import read_customer_master

    p = tmp_path / "cust.csv"
    p.write_text("Customer_ID,Gender,Age,Occupation,City_Category,Stay_In_Current_City_Years,Marital_Status\n"
                 "c1,M,18-25,O1,A,1,0\nc2,F,26-35,O2,B,2,1\nc1,F,36+,O3,C,4+,1\n")
    rows = {r.customer_id: r for r in read_customer_master(spark, str(p)).collect()}
    assert rows["c1"].gender == "F" and rows["c1"].age_group == "36+" and rows["c1"].marital_status == 1
    assert len(rows) == 2


def test_dedup_keeps_first_line(spark, wh):
    from tillroll.operators.facts import dedup_lines

    df = spark.createDataFrame(
        [("o1", "p1", 5, (1, 1)), ("o1", "p1", 7, (1, 2)), ("o2", "p1", 1, (2, 1))],
        "order_id string, product_id string, quantity int, _pos struct<a:int,b:int>",
    )
    got = sorted(map(tuple, dedup_lines(df, ["order_id", "product_id"]).collect()))
    assert got == [("o1", "p1", 5), ("o2", "p1", 1)]


def test_constraint_report_is_clean(load):
    from tillroll.operators.quality import constraint_report

    star = load([product("p1"), product("p2")], [customer("c1")],
                [tx("o1", "c1", "p1", 1, "2020-01-01"), tx("o1", "c1", "p2", 1, "2020-01-01")])
    rows = constraint_report(star).collect()
    assert len(rows) == 16 and all(r.violations == 0 for r in rows)


def test_constraint_report_finds_orphans(load, spark):
    from tillroll.operators.quality import constraint_report
    from tillroll.warehouse import Star

    star = load([product("p1")], [customer("c1")], [tx("o1", "c1", "p1", 1, "2020-01-01")])
    broken = Star(star.customer_dim.limit(0), star.product_dim, star.store_dim, star.supplier_dim,
                  star.date_dim, star.sales_fact)
    got = {r.check_name: r.violations for r in constraint_report(broken).collect()}
    assert got["sales_fact.customer_sk references customer_dim"] == 1


def test_batch_dedup_with_and_without_position(spark, tmp_path):
    from tillroll.sources.transactions import read_transactions
    from tillroll.warehouse import Warehouse

    p = tmp_path / "tx.csv"
    p.write_text("orderID,Customer_ID,Product_ID,quantity,date\n"
                 "o1,c1,p1,3,2020-02-01\no1,c1,p1,5,2020-02-01\no2,c1,p1,1,2020-02-02\n")
    pm = spark.createDataFrame([product("p1")], PRODUCT_MASTER)
    cm = spark.createDataFrame([customer("c1")], CUSTOMER_MASTER)
    for with_position, want in ((True, [1, 3]), (False, [1, 3])):
        wh = Warehouse(spark, str(tmp_path / f"wh{with_position}"))
        t = read_transactions(spark, str(p), with_position=with_position)
        r = load_batch(wh, t, pm, cm, 0, dedup_keys=["order_id", "product_id"])
        assert sorted(x.quantity for x in wh.read("sales_fact").collect()) == want
        assert (r.input_rows, r.matched_rows, r.duplicates_dropped) == (3, 2, 1)


def test_keep_last_across_files_and_parquet(spark, tmp_path):
    from tillroll.sources.masters import read_product_master

    d = tmp_path / "products"
    d.mkdir()
    header = "Product_ID,Product_Category,price$,storeID,supplierID,storeName,supplierName\n"
    (d / "part-0.csv").write_text(header + "p1,Old,1.00,S1,P1,Store S1,Supp P1\np2,Keep,2.50,S1,P1,Store S1,Supp P1\n")
    (d / "part-1.csv").write_text(header + "p1,New,1.10,S2,P1,Store S2,Supp P1\n")
    rows = {r.product_id: r for r in read_product_master(spark, str(d)).collect()}
    assert rows["p1"].product_category == "New" and str(rows["p1"].price) == "1.10"
    assert rows["p2"].product_category == "Keep" and len(rows) == 2

    pq = tmp_path / "products_pq"
    spark.read.option("header", True).csv(str(d / "part-0.csv")).write.parquet(str(pq / "a"))
    spark.read.option("header", True).csv(str(d / "part-1.csv")).write.parquet(str(pq / "b"))
    rows = {r.product_id: r for r in read_product_master(spark, str(pq / "*"), fmt="parquet").collect()}
    assert rows["p1"].product_category == "New" and len(rows) == 2


def test_batches_cannot_go_backwards(spark, wh):
    import pytest

    pm = spark.createDataFrame([product("p1")], PRODUCT_MASTER)
    cm = spark.createDataFrame([customer("c1")], CUSTOMER_MASTER)
    t = spark.createDataFrame([tx("o1", "c1", "p1", 1, "2020-01-01")], TRANSACTIONS)
    load_batch(wh, t, pm, cm, 3)
    load_batch(wh, t, pm, cm, 3)  # the latest may run again
    assert wh.committed_batches() == [3]
    with pytest.raises(ValueError):
        load_batch(wh, t, pm, cm, 2)
