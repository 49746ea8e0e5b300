"""De-duplication in Spark's state store, the listener's counters, CSV streams and changing masters."""

from __future__ import annotations

import pytest
from conftest import customer, product, tx
from pyspark.sql import functions as F

from tillroll.schemas import CUSTOMER_MASTER, PRODUCT_MASTER, TRANSACTIONS
from tillroll.sources.masters import VersionedMaster
from tillroll.sources.transactions import stream_file_names, stream_transactions
from tillroll.streaming import dedup
from tillroll.streaming.pipeline import csv_lines, run_to_end
from tillroll.streaming.progress import IngestProgress

KEYS = ["order_id", "product_id", "quantity", "date"]


def _masters(spark):
    return spark.createDataFrame([product("p1")], PRODUCT_MASTER), spark.createDataFrame([customer("c1")], CUSTOMER_MASTER)


def _feed(spark, folder):
    return stream_transactions(spark, folder, fmt="parquet", max_files_per_trigger=1, schema=TRANSACTIONS)


def test_state_dedup_counts_late_and_repeated_lines(spark, wh, tmp_path):
    pm, cm = _masters(spark)
    feed = str(tmp_path / "feed")
    line = lambda o, d, c="c1": tx(o, c, "p1", 1, d)
    files = [
        [line("a", "2020-01-01"), line("a", "2020-01-01"), line("b", "2020-02-01"), line("n", None)],
        [line("a", "2020-01-01"), line("b", "2020-02-01"), line("c", "2020-01-25"), line("edge", "2020-01-22")],  # mark: 22 January
        [line("c", "2020-01-25"), line("x", "2020-02-02", "nobody"), line("x", "2020-02-02", "nobody"), line("d", "2020-03-01")],
    ]
    got = []
    for rows in files:  # a stop after every file
        spark.createDataFrame(rows, TRANSACTIONS).coalesce(1).write.mode("append").parquet(feed)
        got.append(dedup.run_to_end(wh, _feed(spark, feed), pm, cm, KEYS, delay_days=10))
    assert [(g.loaded_rows, g.repeated_rows, g.late_rows, g.other_quarantined_rows) for g in got] == [(2, 1, 0, 1), (1, 1, 2, 0), (1, 2, 0, 1)]
    assert sorted(r.order_id for r in wh.star().sales_fact.collect()) == ["a", "b", "c", "d"]
    aside = sorted((r.order_id, r.reason) for r in wh.read("quarantine").collect())
    assert aside == [("a", "late"), ("edge", "late"), ("n", "malformed_date"), ("x", "unmatched_customer")]


def test_state_dedup_does_not_read_the_fact(spark, wh, tmp_path, monkeypatch):
    pm, cm = _masters(spark)
    feed = str(tmp_path / "feed")
    spark.createDataFrame([tx("a", "c1", "p1", 1, "2020-01-01")] * 3, TRANSACTIONS).coalesce(1).write.parquet(feed)
    read = wh.read
    monkeypatch.setattr(wh, "read", lambda table, **k: pytest.fail("fact read") if table == "sales_fact" else read(table, **k))
    assert dedup.run_to_end(wh, _feed(spark, feed), pm, cm, KEYS, 10).repeated_rows == 2


def test_listener_rows_add_up_and_come_live(spark, wh, tmp_path):
    pm, cm = _masters(spark)
    feed = str(tmp_path / "feed")
    for k in range(3):
        rows = [tx(f"o{k}{i}", "c1" if i else "nobody", "p1", 1, "2020-01-01") for i in range(k + 1)]
        spark.createDataFrame(rows, TRANSACTIONS).coalesce(1).write.mode("append").parquet(feed)
    live = []
    with IngestProgress(spark, on_row=live.append) as seen:
        results = run_to_end(wh, _feed(spark, feed), pm, cm)
    rows = [(r.batch_id, r.input_rows, r.matched_rows, r.quarantined_rows) for r in seen.table().orderBy("batch_id").collect()]
    assert rows == [(r.batch_id, r.input_rows, r.matched_rows, r.quarantined_rows) for r in results] == [(0, 1, 0, 1), (1, 2, 1, 1), (2, 3, 2, 1)]
    assert [r["input_rows"] for r in live] == [1, 2, 3]
    other = IngestProgress(spark, "another query")
    with other:
        pass
    assert not other.rows


def test_csv_stream_binds_each_file_by_its_header(spark, wh, tmp_path):
    pm, cm = _masters(spark)
    feed = tmp_path / "csv"
    feed.mkdir()
    (feed / "1.csv").write_text("orderID,Customer_ID,Product_ID,quantity,date\no1,c1,p1,3,2020-01-01\n")
    (feed / "2.csv").write_text('date,"note, long",orderID,quantity,Product_ID,Customer_ID\n2020-01-02,"x, y",o2,4,p1,c1\n2020-01-02,,o3,four,p1,c1\n')
    run = lambda: run_to_end(wh, stream_file_names(spark, str(feed)), pm, cm, read=csv_lines(wh))
    assert [(r.input_rows, r.quarantined_rows) for r in run()] == [(3, 1)]  # both orders in one micro-batch
    (feed / "3.csv").write_text("orderID,Product_ID,quantity,date\no4,p1,1,2020-01-01\n")
    with pytest.raises(Exception, match="Customer_ID"):
        run()
    assert sorted((r.order_id, r.quantity) for r in wh.star().sales_fact.collect()) == [("o1", 3), ("o2", 4)]
    assert [(r.raw_quantity, r.reason) for r in wh.read("quarantine").collect()] == [("four", "malformed_quantity")]


def test_a_master_version_is_in_force_from_the_next_micro_batch(spark, wh, tmp_path):
    _, cm = _masters(spark)
    products = VersionedMaster(spark, str(tmp_path / "pm"), PRODUCT_MASTER)
    with pytest.raises(ValueError):
        products()
    publish = lambda *rows: products.publish(spark.createDataFrame(rows, PRODUCT_MASTER))
    assert publish(product("p1", price="1.00")) == 0
    feed = str(tmp_path / "feed")
    for k in range(2):
        rows = [tx(f"o{k}", "c1", "p1", 1, "2020-01-01"), tx(f"n{k}", "c1", "p2", 1, "2020-01-01")]
        spark.createDataFrame(rows, TRANSACTIONS).coalesce(1).write.mode("append").parquet(feed)
    change = lambda r: r.batch_id == 0 and publish(product("p1", price="9.00", cat="new"), product("p2", price="2.00"))
    results = run_to_end(wh, _feed(spark, feed), products, cm, on_batch=change)
    assert [(r.matched_rows, r.quarantined_rows) for r in results] == [(1, 1), (2, 0)] and products.versions() == [0, 1]
    price = {r.order_id: float(r.total_price) for r in wh.star().sales_fact.collect()}
    assert price == {"o0": 1.0, "o1": 9.0, "n1": 2.0}  # the line's price is the one in force
    dim = {r.product_id: (float(r.price), r.product_category) for r in wh.star().product_dim.collect()}
    assert dim == {"p1": (1.0, "Cat"), "p2": (2.0, "Cat")}  # the dimension keeps its first
    assert wh.read("product_dim").agg(F.max("product_sk")).first()[0] == 2


def test_state_is_kept_in_rocksdb_unless_the_session_names_a_store(spark, wh, tmp_path):
    pm, cm = _masters(spark)
    feed = str(tmp_path / "feed")
    spark.createDataFrame([tx("a", "c1", "p1", 1, "2020-01-01")] * 3, TRANSACTIONS).coalesce(1).write.parquet(feed)
    assert dedup.run_to_end(wh, _feed(spark, feed), pm, cm, KEYS, 10).repeated_rows == 2
    logged = [r.value for r in spark.read.text(f"{wh.root}/_dedup_checkpoint/offsets/0").collect()]
    assert any("RocksDBStateStoreProvider" in x for x in logged)
    provider = "spark.sql.streaming.stateStore.providerClass"
    assert spark.conf.get(provider, None) is None  # other queries of the session are left alone
    own = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(provider, own)
    try:
        with dedup.state_store(spark):
            assert spark.conf.get(provider) == own
        assert spark.conf.get(provider) == own
    finally:
        spark.conf.unset(provider)
