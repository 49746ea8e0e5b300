"""Batches that are done and batches that are not, unloadable lines, CSV by header name, basket pairs without caches."""

from __future__ import annotations

import pytest
from conftest import customer, product, tx
from pyspark.sql import functions as F

from tillroll.etl import load_batch
from tillroll.functions.exprs import format_cents
from tillroll.operators import facts as X
from tillroll.plans import basket
from tillroll.schemas import CUSTOMER_MASTER, PRODUCT_MASTER, TRANSACTIONS
from tillroll.sources.masters import read_product_master
from tillroll.sources.transactions import parse_transactions, read_transactions


def _frames(spark, transactions, products=None, customers=None):
    return (
        spark.createDataFrame(transactions, TRANSACTIONS),
        spark.createDataFrame(products or [product("p1"), product("p2", store="S2")], PRODUCT_MASTER),
        spark.createDataFrame(customers or [customer("c1")], CUSTOMER_MASTER),
    )


def test_a_batch_that_is_run_again_leaves_nothing_of_its_first_run(spark, wh):
    load_batch(wh, *_frames(spark, [tx("o0", "c1", "p1", 1, "2020-01-01")]), 0)
    bad = [tx("o1", "c1", "p1", 1, "2020-01-02"), tx("o2", "c1", "p2", 2, "2021-01-02"), tx("o3", "nobody", "p1", 1, "2020-01-02")]
    first = load_batch(wh, *_frames(spark, bad), 1)
    assert (first.matched_rows, first.quarantined_rows) == (2, 1)
    again = load_batch(wh, *_frames(spark, bad[:1]), 1)
    assert (again.matched_rows, again.quarantined_rows) == (1, 0)
    assert sorted(r.order_id for r in wh.star().sales_fact.collect()) == ["o0", "o1"]
    assert wh.read("quarantine").count() == 0
    assert {r.product_id for r in wh.star().product_dim.collect()} == {"p1"} and wh.star().store_dim.count() == 1
    assert {r.sale_year for r in wh.read_batch("sales_fact", 1).collect()} == {2020}  # its partition of 2021 is gone


def test_what_is_not_committed_is_not_seen(spark, wh, monkeypatch):
    load_batch(wh, *_frames(spark, [tx("o0", "c1", "p1", 1, "2020-01-01")]), 0)
    monkeypatch.setattr(wh, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        load_batch(wh, *_frames(spark, [tx("o1", "c1", "p2", 1, "2020-01-02")]), 1)
    assert wh.star().sales_fact.count() == 1 and wh.star().product_dim.count() == 1 and wh.committed_batches() == [0]
    monkeypatch.undo()
    load_batch(wh, *_frames(spark, [tx("o1", "c1", "p2", 1, "2020-01-02")]), 1)
    assert {r.product_sk for r in wh.star().product_dim.collect()} == {1, 2}


def test_done_batches_are_ranges_and_a_lost_one_stays_out(spark, wh, monkeypatch):
    for b in (0, 1, 3, 4):
        load_batch(wh, *_frames(spark, [tx(f"o{b}", "c1", f"p{b % 2 + 1}", b + 1, f"202{b}-01-01")]), b)
    assert wh.done().ranges == [(0, 1), (3, 4)] and wh.done(before_batch=4).ranges == [(0, 1), (3, 3)]
    assert wh.done().max_keys["product_dim"] == 2 and wh.last_batch() == 4
    assert len({r.sale_id for r in wh.star().sales_fact.collect()}) == 4  # unique over batches
    monkeypatch.setattr(wh, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    for lost in (4, 5):  # the last batch run again, and a new one
        with pytest.raises(RuntimeError):
            load_batch(wh, *_frames(spark, [tx("x", "c1", "p3", 1, "2025-01-01")], products=[product("p3")]), lost)
    monkeypatch.undo()
    assert wh.done().ranges == [(0, 1), (3, 3)]
    assert {r.order_id for r in wh.star().sales_fact.collect()} == {"o0", "o1", "o3"}
    load_batch(wh, *_frames(spark, [tx("o6", "c1", "p9", 1, "2025-01-01")], products=[product("p9")]), 6)
    assert wh.done().ranges == [(0, 1), (3, 3), (6, 6)]
    assert {r.product_id: r.product_sk for r in wh.star().product_dim.collect()} == {"p1": 1, "p2": 2, "p9": 3}
    plan = wh.star().sales_fact._jdf.queryExecution().executedPlan().toString()
    assert "batch_id" in plan.split("PartitionFilters: ")[1].split("]")[0] and "Join" not in plan


def test_a_new_batch_without_lines_writes_nothing(spark, wh):
    load_batch(wh, *_frames(spark, [tx("o0", "c1", "p1", 1, "2020-01-01")]), 0)
    load_batch(wh, *_frames(spark, []), 1)
    assert wh.committed_batches() == [0]
    load_batch(wh, *_frames(spark, []), 0)  # but an empty run replaces what was there
    assert wh.star().sales_fact.count() == 0 and wh.committed_batches() == [0]


def test_every_line_that_cannot_be_loaded_is_set_aside_with_its_text(spark):
    raw = spark.createDataFrame(
        [("o1", "c1", "p1", "x", "2020-01-01"), ("o2", "c1", "p1", "1", "2020-13-01"), (None, "c1", "p1", "1", "2020-01-01"),
         ("o4", "c1", "noprice", "1", "2020-01-01"), ("o5", "c1", "dear", "2000000000", "2020-01-01"), ("o6", "c1", "p1", " 2 ", "2020-01-01")],
        "orderID string, Customer_ID string, Product_ID string, quantity string, date string",
    )
    _, pm, cm = _frames(spark, [], products=[product("p1"), (*product("noprice")[:2], None, *product("noprice")[3:]), product("dear", price="99999999.00")])
    e = X.enrich(parse_transactions(raw), pm, cm)
    got = {r.order_id: r for r in X.quarantined_rows(e).collect()}
    assert {k: r.reason for k, r in got.items()} == {
        "o1": X.MALFORMED_QUANTITY, "o2": X.MALFORMED_DATE, None: X.MISSING_ORDER, "o4": X.MALFORMED_PRICE, "o5": X.AMOUNT_OVERFLOW}
    assert got["o1"].raw_quantity == "x" and got["o2"].raw_date == "2020-13-01"
    assert [r.quantity for r in X.matched_rows(e).collect()] == [2]


def test_csv_by_header_name_with_standard_quotes(spark, tmp_path):
    (tmp_path / "p.csv").write_text('storeID,extra,Product_ID,price$,supplierID,storeName,supplierName,Product_Category\nS1,x,P1,2.50,U1,"Store ""A"" x, y",Sup,Cat\n')
    r = read_product_master(spark, str(tmp_path / "p.csv")).first()
    assert (r.product_id, str(r.price), r.store_id, r.store_name) == ("P1", "2.50", "S1", 'Store "A" x, y')
    (tmp_path / "m.csv").write_text('Product_ID,storeName,Product_Category,price$,storeID,supplierID,supplierName\nP2,"two\nlines",C,1,S,U,N\n')
    assert read_product_master(spark, str(tmp_path / "m.csv"), multi_line=True).first().store_name == "two\nlines"
    (tmp_path / "t.csv").write_text("index,date,Product_ID,quantity,orderID,Customer_ID\n0,2020-01-02,P1,3,O1,C1\n")
    t = read_transactions(spark, str(tmp_path / "t.csv")).first()
    assert (t.order_id, t.customer_id, t.product_id, t.quantity, str(t.date)) == ("O1", "C1", "P1", 3, "2020-01-02")
    (tmp_path / "u.csv").write_text("orderID,Customer_ID,Product_ID,quantity,date\nO2,C1,P1,4,2020-01-03\n")
    both = read_transactions(spark, [str(tmp_path / "t.csv"), str(tmp_path / "u.csv")]).collect()  # each by its own header
    assert {(r.order_id, r.quantity, str(r.date)) for r in both} == {("O1", 3, "2020-01-02"), ("O2", 4, "2020-01-03")}
    (tmp_path / "bad.csv").write_text("orderID,Product_ID,quantity,date\nO1,P1,3,2020-01-02\n")
    with pytest.raises(ValueError, match="Customer_ID"):
        read_transactions(spark, str(tmp_path / "bad.csv"))


def test_text_of_cents(spark):
    df = spark.createDataFrame([(123456,), (-123,), (-5,), (0,), (9007199254740993,)], "c bigint")
    assert [r[0] for r in df.select(format_cents("c")).collect()] == ["1234.56", "-1.23", "-0.05", "0.00", "90071992547409.93"]


def test_basket_pairs_see_new_rows(spark, wh):
    rows = [tx("o1", "c1", "p1", 1, "2020-01-01"), tx("o1", "c1", "p2", 1, "2020-01-01")]
    load_batch(wh, *_frames(spark, rows), 0)
    assert basket.q16_basket_pairs(wh.star()).first().times_bought_together == 1
    load_batch(wh, *_frames(spark, [tx(f"n{i}", "c1", p, 1, "2020-01-02") for i in range(3) for p in ("p1", "p2")]), 1)
    assert basket.q16_basket_pairs(wh.star()).first().times_bought_together == 4


def test_a_giant_order_is_cut_into_many_units(spark):
    lines = spark.range(600).select(F.lit("big").alias("order_id"), F.col("id").alias("product_sk"), F.lit(1).cast("bigint").alias("m"))
    counts = basket.pair_counts(lines, block=50)
    assert counts.count() == 600 * 599 // 2 and counts.agg(F.max("times_bought_together")).first()[0] == 1
    joined = [r for r in counts._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in r]
    assert any(" i#" in r.replace("(", " ") and "j#" in r for r in joined)  # order, block and block are the key
