"""Sides of joins are broadcast by their rows, not by the bytes of their files alone."""

from __future__ import annotations

import pytest
from conftest import customer, product, tx

from tillroll.etl import load_batch
from tillroll.operators import dims, keys
from tillroll.operators import facts as X
from tillroll.schemas import CUSTOMER_MASTER, PRODUCT_MASTER, TRANSACTIONS
from tillroll.streaming import testfeeds
from tillroll.streaming.pipeline import run_to_end
from tillroll.warehouse import Warehouse


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hinted(df) -> bool:
    return "strategy=merge" in df._jdf.queryExecution().analyzed().toString()


@pytest.fixture()
def masters(spark, tmp_path):
    pm = spark.createDataFrame([product(f"p{i}", price=f"{i}.00") for i in range(1, 4)], PRODUCT_MASTER)
    cm = spark.createDataFrame([customer(f"c{i}") for i in range(4)], CUSTOMER_MASTER)
    for name, df in (("p", pm), ("c", cm)):
        df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / "p")), spark.read.parquet(str(tmp_path / "c"))


LINES = [tx(f"o{i}", f"c{i % 5}", f"p{1 + i % 4}", 1 + i % 3, f"2020-01-0{1 + i % 4}") for i in range(40)]


def test_a_side_of_many_rows_is_dealt_however_small_its_files(spark, masters, monkeypatch):
    _, cm = masters
    lines = spark.createDataFrame(LINES, TRANSACTIONS)
    monkeypatch.setattr(keys, "BROADCAST_ROWS", 4)
    assert "BroadcastHashJoin" in _plan(lines.join(keys.by_rows(cm), "customer_id", "left"))  # as many as may be
    assert not _hinted(keys.by_rows(cm, 4)) and _hinted(keys.by_rows(cm, 5))
    monkeypatch.setattr(keys, "BROADCAST_ROWS", 3)
    plan = _plan(lines.join(keys.by_rows(cm), "customer_id", "left"))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("streamed", [True, False])
def test_loads_deal_large_masters_and_maps_and_give_the_same_rows(spark, masters, tmp_path, monkeypatch, streamed):
    pm, cm = masters
    given, maps = [], []
    enrich, build = X.enrich, X.build_fact
    monkeypatch.setattr(X, "enrich", lambda t, p, c: (given.append((_hinted(p), _hinted(c))), enrich(t, p, c))[1])
    monkeypatch.setattr(X, "build_fact", lambda m, sold, d, *a, **k: (maps.append((_hinted(sold), _hinted(d["customer_dim"]))), build(m, sold, d, *a, **k))[1])
    rows = {}
    for most in (2, 1000):
        monkeypatch.setattr(keys, "BROADCAST_ROWS", most)
        wh = Warehouse(spark, str(tmp_path / f"wh{most}"))
        for k in range(2):
            part = spark.createDataFrame(LINES[20 * k: 20 * k + 20], TRANSACTIONS)
            if streamed:
                testfeeds._append(part, f"{wh.root}/_feed")
                run_to_end(wh, testfeeds._parquet(spark, f"{wh.root}/_feed"), pm, cm)
            else:
                load_batch(wh, part, pm, cm, k)
        star = wh.star()
        fact = sorted(tuple(r) for r in star.sales_fact.drop("sale_id").collect())
        rows[most] = fact, sorted(tuple(r) for r in wh.read("quarantine").collect()), sorted(tuple(r) for r in star.customer_dim.collect())
    assert rows[2] == rows[1000] and len(rows[2][0]) == 24 and len(rows[2][1]) == 16
    assert given == [(True, True)] * 2 + [(False, False)] * 2
    assert maps == [(True, True)] * 2 + [(False, False)] * 2


def test_stored_ids_of_a_large_dimension_are_dealt(spark, monkeypatch):
    candidates = spark.createDataFrame([("b", 1), ("c", 2)], "id string, x int")
    existing = spark.createDataFrame([("a", 1), ("b", 9)], "id string, sk int")
    monkeypatch.setattr(keys, "BROADCAST_ROWS", 1)
    for few in (True, False):
        new = dims.new_members(candidates, existing, "id", few, stored=2, lines=2)
        assert [tuple(r) for r in new.collect()] == [("c", 2)]
        assert "BroadcastHashJoin" not in _plan(new)
