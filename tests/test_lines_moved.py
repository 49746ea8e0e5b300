"""How often a load moves a line, and what it carries then."""

from __future__ import annotations

import pytest
from conftest import customer, product, tx

from tillroll import etl
from tillroll.operators import constraints
from tillroll.operators import facts as X
from tillroll.plans import incremental
from tillroll.schemas import CUSTOMER_MASTER, PRODUCT_MASTER, TRANSACTIONS


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _load(spark, wh, monkeypatch, products, lines, batch_id=0, **kw):
    """Loads and returns the plan of the fact."""
    seen, number = [], X.number_and_cluster
    monkeypatch.setattr(X, "number_and_cluster", lambda fact, b: (seen.append(_plan(fact) + _plan(number(fact, b))), number(fact, b))[1])
    pm, cm = spark.createDataFrame(products, PRODUCT_MASTER), spark.createDataFrame([customer("c1"), customer("c2")], CUSTOMER_MASTER)
    etl.load_batch(wh, spark.createDataFrame(lines, TRANSACTIONS), pm, cm, batch_id, **kw)
    monkeypatch.undo()
    return seen[0]


LINES = [tx("o1", "c1", "p1", 2, "2020-01-01"), tx("o2", "c2", "p1", 1, "2021-01-01"), tx("o3", "c1", "p2", 1, "2020-01-01"), tx("o3", "c1", "p2", 1, "2020-01-01")]


def _facts(wh):
    s = wh.star()
    f = s.sales_fact.join(s.product_dim.select("product_sk", "product_id"), "product_sk").join(s.store_dim.select("store_sk", "store_id"), "store_sk", "left")
    return sorted((r.order_id, r.product_id, str(r.total_price), r.store_id or "-", r.supplier_sk is None) for r in f.collect())


def test_lines_carry_no_price_store_or_supplier_and_are_not_dealt_again(spark, wh, monkeypatch):
    plan = _load(spark, wh, monkeypatch, [product("p1", price="3.00"), product("p2", store=None, supplier=None)], LINES)
    assert "RepartitionByExpression" not in plan
    carried = [x for x in plan.splitlines() if "Project [" in x and "order_id#" in x and "customer_id#" in x]
    assert carried and not any(c in x for x in carried for c in ("price#", "store_id#", "supplier_id#"))
    assert _facts(wh) == [("o1", "p1", "6.00", "S1", False), ("o2", "p1", "3.00", "S1", False), ("o3", "p2", "10.00", "-", True), ("o3", "p2", "10.00", "-", True)]
    ids = [r.sale_id for r in wh.star().sales_fact.collect()]
    assert len(set(ids)) == 4


def test_a_product_that_is_twice_in_the_master_keeps_its_prices_apart(spark, wh, monkeypatch):
    products = [product("p1", price="3.00"), product("p1", price="4.00"), product("p2", store=None), product("p2", store=None, price="5.00")]
    _load(spark, wh, monkeypatch, products, LINES)
    assert _facts(wh) == sorted([
        ("o1", "p1", "6.00", "S1", False), ("o1", "p1", "8.00", "S1", False), ("o2", "p1", "3.00", "S1", False), ("o2", "p1", "4.00", "S1", False),
        *[("o3", "p2", p, "-", False) for p in ("10.00", "10.00", "5.00", "5.00")]])
    assert len({r.sale_id for r in wh.star().sales_fact.collect()}) == 8


@pytest.fixture()
def kept(spark, wh, monkeypatch):
    keep = [incremental.maintain, constraints.note_keys]
    _load(spark, wh, monkeypatch, [product("p1"), product("p2", store=None)], LINES, 0, maintain=keep)
    _load(spark, wh, monkeypatch, [product("p1"), product("p3")], [tx("o4", "c1", "p1", 1, "2020-02-01"), tx("o5", "c2", "p3", 4, "2020-02-01")], 1, maintain=keep)
    return wh


def test_key_filters_are_looked_up_once_for_all_kinds(spark, kept):
    fact = kept.star().sales_fact
    report = constraints.check_load(kept, {"sales_fact": fact.where("order_id = 'o1'")}, 2)
    assert _plan(report).count("slot") == 0  # the filters are not in the report's plan
    assert {r.check_name: r.violations for r in report.collect()}[f"{constraints.SALE} unique"] == 1


def test_sums_of_a_quarter_do_not_pass_through_customers(spark, kept, monkeypatch):
    plans, write = {}, kept.write
    monkeypatch.setattr(kept, "write", lambda t, df, b: (plans.setdefault(t, _plan(df)), write(t, df, b))[1])
    incremental.maintain(kept, 2)
    adding = [x for x in plans["store_quarter_sums"].splitlines() if "Aggregate [" in x and "sum(" in x]
    assert adding and not any("customer_sk" in x for x in adding)
    monkeypatch.undo()
    got = {(r.store_id, r.quarter, r.year): (r.transaction_count, r.quarterly_quantity, r.unique_customers) for r in incremental.q20_incremental(kept).collect()}
    assert got == {("S1", 1, 2020): (3, 7, 2), ("S1", 1, 2021): (1, 1, 1)}
