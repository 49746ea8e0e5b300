"""What a load moves: narrow rows in the stream's own plan, one copy of a line in the de-duplication, one look-up of a large batch."""

from __future__ import annotations

import pytest
from conftest import customer, product, tx

from tillroll.etl import BATCH_COLUMNS, load_batch
from tillroll.operators import facts as X
from tillroll.schemas import CUSTOMER_MASTER, PRODUCT_MASTER, TRANSACTIONS
from tillroll.sources.transactions import stream_transactions
from tillroll.streaming import pipeline

KEYS = ["order_id", "product_id", "quantity", "date"]


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _masters(spark):
    return spark.createDataFrame([product("p1"), product("p2")], PRODUCT_MASTER), spark.createDataFrame([customer("c1")], CUSTOMER_MASTER)


def _feed(spark, folder, rows):
    spark.createDataFrame(rows, TRANSACTIONS).coalesce(1).write.mode("append").parquet(folder)
    return stream_transactions(spark, folder, fmt="parquet", schema=TRANSACTIONS)


def test_the_stream_carries_no_master_attributes_that_the_load_leaves(spark, wh, tmp_path, monkeypatch):
    seen, load = [], pipeline.load_enriched
    monkeypatch.setattr(pipeline, "load_enriched", lambda wh, rows, *a, **k: (seen.append(rows.columns), load(wh, rows, *a, **k))[1])
    pipeline.run_to_end(wh, _feed(spark, str(tmp_path / "f"), [tx("o1", "c1", "p1", 1, "2020-01-01"), tx("o2", "nobody", "p1", 1, "2020-01-01")]), *_masters(spark))
    assert seen == [BATCH_COLUMNS]
    assert [r.order_id for r in wh.star().sales_fact.collect()] == ["o1"] and [r.order_id for r in wh.read("quarantine").collect()] == ["o2"]


def test_lines_without_a_position_keep_the_smallest_and_move_once(spark):
    rows = [("o1", "p1", 5, None), ("o1", "p1", 5, "b"), ("o1", "p1", 5, "a"), ("o2", None, 1, "z"), ("o2", None, 1, "y"), (None, "p1", 1, "x")]
    got = X.dedup_lines(spark.createDataFrame(rows, "order_id string, product_id string, quantity int, customer_id string"), ["order_id", "product_id"])
    assert got.columns == ["order_id", "product_id", "quantity", "customer_id"]
    assert {tuple(r) for r in got.collect()} == {("o1", "p1", 5, None), ("o2", None, 1, "y"), (None, "p1", 1, "x")}
    assert "min_by" not in _plan(got)


def test_a_large_batch_is_looked_up_once(spark):
    schema = "order_id string, product_sk bigint, quantity int, date_sk bigint, sale_year int"
    fact = spark.createDataFrame([("a", 1, 1, 1, 2020), ("a", 1, 2, 1, 2020), ("b", 1, 1, 1, 2020), (None, 1, 1, 1, 2020)], schema)
    stored = spark.createDataFrame([("a", 1, 1, 1, 2020), ("a", 1, 1, 1, 2020), (None, 1, 1, 1, 2020), ("b", 1, 1, 1, 2021)], schema)
    once, twice = (X.without_stored(fact, stored, KEYS, small) for small in (False, True))
    rows = lambda df: sorted((str(r.order_id), r.quantity) for r in df.collect())
    assert rows(once) == rows(twice) == [("None", 1), ("a", 2), ("b", 1)]
    assert "LeftSemi" not in _plan(once) and "LeftSemi" in _plan(twice)


@pytest.mark.parametrize("bound", [0, X.SMALL_BATCH])
def test_repeated_lines_load_once_whatever_the_size_of_a_batch(spark, wh, tmp_path, monkeypatch, bound):
    monkeypatch.setattr(X, "SMALL_BATCH", bound)
    feed, first = str(tmp_path / "f"), [tx("o1", "c1", "p1", 1, "2020-01-01")]
    for rows in (first, [*first, *first, tx("o1", "c1", "p2", 1, "2020-01-01"), tx("o1", "c1", "p1", 1, "2021-01-01")]):
        results = pipeline.run_to_end(wh, _feed(spark, feed, rows), *_masters(spark), dedup_keys=KEYS)
    assert (results[-1].matched_rows, results[-1].duplicates_dropped) == (2, 2)
    assert sorted((r.sale_year, r.product_sk) for r in wh.star().sales_fact.collect()) == [(2020, 1), (2020, 2), (2021, 1)]


def test_ids_of_a_large_batch_are_not_moved_to_narrow_the_stored_ones(spark):
    from tillroll.operators import dims

    candidates = spark.createDataFrame([("b", 1), ("c", 2)], "id string, x int")
    existing = spark.createDataFrame([("a", 1), ("b", 9)], "id string, sk int")
    for few in (True, False):
        new = dims.new_members(candidates, existing, "id", few)
        assert [tuple(r) for r in new.collect()] == [("c", 2)]
        assert ("LeftSemi" in new._jdf.queryExecution().optimizedPlan().toString()) == few


def test_large_and_small_batches_get_the_same_keys(spark, tmp_path, monkeypatch):
    from tillroll.operators import dims
    from tillroll.warehouse import Warehouse

    pm, cm = _masters(spark)
    given, upsert = [], dims.upsert_all
    facts = []
    for known in (True, False):
        monkeypatch.setattr(dims, "upsert_all", lambda *a, lines, known=known: given.append(lines) or upsert(*a, lines=lines if known else 0))
        wh = Warehouse(spark, str(tmp_path / str(known)))
        for k in range(2):
            load_batch(wh, spark.createDataFrame([tx(f"o{k}{i}", "c1", "p1", 1, f"2020-01-0{i + 1}") for i in range(4)], TRANSACTIONS), pm, cm, k)
        facts.append(sorted(tuple(r) for r in wh.star().sales_fact.drop("sale_id").collect()))
    assert given == [4, 4, 4, 4]
    assert facts[0] == facts[1] and len(facts[0]) == 8
