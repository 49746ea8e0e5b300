"""Catalog tables and views, bucketed copies, and the aggregate kept up to date."""

from __future__ import annotations

import re

import pytest
from conftest import SF_SMALL, customer, product, tx
from pyspark.sql import functions as F

from tillroll import etl
from tillroll.catalog import StarCatalog
from tillroll.etl import load_batch
from tillroll.plans import demographics, incremental, views
from tillroll.schemas import CUSTOMER_MASTER, PRODUCT_MASTER, TRANSACTIONS


def _load(spark, wh, rows, batch, **options):
    pm = spark.createDataFrame([product("p1"), product("p2", store="S2"), product("p3", store=None)], PRODUCT_MASTER)
    cm = spark.createDataFrame([customer("c1"), customer("c2")], CUSTOMER_MASTER)
    load_batch(wh, spark.createDataFrame(rows, TRANSACTIONS), pm, cm, batch, **options)


def _plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture()
def catalog(spark, wh):
    c = StarCatalog(wh, "star_test")
    yield c
    c.drop()


def test_catalog_of_an_empty_warehouse_then_loads(spark, wh, catalog):
    catalog.create()
    assert catalog.sql("SELECT * FROM sales_fact").count() == 0
    _load(spark, wh, [tx("o1", "c1", "p1", 2, "2020-01-04"), tx("o2", "c1", "p2", 1, "2021-05-04")], 0)
    catalog.refresh()
    catalog.create()  # again: nothing is lost
    assert catalog.sql("SELECT order_id FROM sales_fact ORDER BY 1").collect() == [("o1",), ("o2",)]
    assert catalog.sql("SELECT * FROM sales_fact").columns == [c for c in wh.star().sales_fact.columns if c not in ("batch_id", "sale_year")]
    wh.begin(0)  # being run again: out of every table at once
    catalog.refresh()
    assert catalog.sql("SELECT * FROM sales_fact").count() == 0 == catalog.sql("SELECT * FROM customer_dim").count()


def test_view_prunes_and_tables_have_statistics(spark, wh, catalog):
    _load(spark, wh, [tx(f"o{y}", "c1", "p1", 1, f"20{y}-03-04") for y in range(10, 20)], 0)
    catalog.create()
    catalog.analyze()
    q = catalog.sql("SELECT * FROM STORE_QUARTERLY_SALES WHERE year = 2015")
    assert [r.quarterly_quantity for r in q.collect()] == [1]
    fact = next(s for s in _plan(q).split("\n\n") if "sales_fact" in s and "PartitionFilters" in s)
    assert re.search(r"sale_year#\d+ = 2015", fact), fact
    stats = catalog.sql("DESCRIBE EXTENDED sales_fact_files").where("col_name = 'Statistics'").first().data_type
    assert "10 rows" in stats
    column = catalog.sql("DESCRIBE EXTENDED customer_dim_files customer_sk").where("info_name = 'distinct_count'").first().info_value
    assert column == "1"
    catalog.drop()
    assert not spark.catalog.databaseExists(catalog.db) and wh.star().sales_fact.count() == 10  # the files stay


def test_temp_views_hide_no_table(spark, wh, catalog):
    """Names that the session has as temp views too (S7's, S10's) mean the catalog's."""
    _load(spark, wh, [tx("o1", "c1", "p1", 2, "2020-01-04")], 0)
    catalog.create()
    names = ("STORE_QUARTERLY_SALES", "sales_fact")
    try:
        for name in names:
            spark.range(0).createOrReplaceTempView(name)
        assert [r.quarterly_quantity for r in catalog.sql("SELECT * FROM STORE_QUARTERLY_SALES").collect()] == [2]
        assert [r.order_id for r in catalog.sql("SELECT * FROM sales_fact").collect()] == ["o1"]
        assert spark.table("sales_fact").count() == 0  # the caller's session is as it was
    finally:
        for name in names:
            spark.catalog.dropTempView(name)


def test_customer_breakdowns_do_not_move_a_bucketed_fact(spark):
    wh = etl.testdata_warehouse(spark, SF_SMALL)
    c = StarCatalog(wh, "star_buckets")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for _ in range(2):  # written, then declared over its files
            star = c.bucketed_star(buckets=4)
            for k, v in conf.items():
                spark.conf.set(k, v)
            for fn, name in ((demographics.q2_demographics, "q2"), (demographics.q7_avg_purchase, "q7")):
                plan = fn(star)._jdf.queryExecution().executedPlan().toString()
                join = plan[plan.index("SortMergeJoin") :]
                assert "Exchange" not in join and "Bucketed: true" in join, name
                assert sorted(map(tuple, fn(star).collect()), key=str) == sorted(map(tuple, fn(wh.star()).collect()), key=str)
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
            c.drop()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_maintained_view_equals_the_view_after_every_load_and_redo(spark, wh):
    keep = {"maintain": [incremental.maintain]}
    lines = [tx("o1", "c1", "p1", 2, "2020-01-04"), tx("o2", "c2", "p1", 1, "2020-02-04"), tx("o3", "c1", "p3", 1, "2020-02-04")]
    again = [tx("o4", "c1", "p1", 5, "2020-03-01"), tx("o5", "c1", "p2", 1, "2020-03-01"), tx("o6", "c2", "p2", 1, "2021-03-01")]

    def same():
        want = sorted(map(tuple, views.store_quarterly_sales(wh.star()).collect()), key=str)
        assert sorted(map(tuple, incremental.q20_incremental(wh).collect()), key=str) == want and want

    _load(spark, wh, lines, 0, **keep)
    same()
    _load(spark, wh, again, 1, **keep)
    same()
    _load(spark, wh, again[1:], 1, **keep)  # the last batch with fewer lines
    same()
    assert wh.read_batch("store_quarter_sums", 1).agg(F.sum("new_customers")).first()[0] == 2
