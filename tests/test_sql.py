"""SQL users: the star as views (S7, S10) queried by Spark SQL, and create / drop."""

from __future__ import annotations

from conftest import customer, product, tx


def test_sql_on_views(load, spark):
    star = load(
        [product("p1"), product("p2", store="S2")],
        [customer("c1"), customer("c2", gender=None)],
        [tx("o1", "c1", "p1", 2, "2020-01-04"), tx("o1", "c1", "p2", 1, "2020-01-04"),
         tx("o2", "c2", "p1", 1, "2020-07-06")],
    )
    star.register(suffix="_t")
    by_order = spark.sql("SELECT order_id, sum(quantity) n FROM sales_fact_t GROUP BY order_id HAVING n > 1").collect()
    assert [tuple(r) for r in by_order] == [("o1", 3)]
    first, last = spark.sql("SELECT min(date), max(date) FROM date_dim_t").first()
    assert (str(first), str(last)) == ("2020-01-04", "2020-07-06")
    levels = spark.sql("""
        SELECT store_id, month, grouping_id() g, sum(total_price) v
        FROM sales_fact_t NATURAL JOIN (SELECT store_sk, store_id FROM store_dim_t) NATURAL JOIN (SELECT date_sk, month FROM date_dim_t)
        GROUP BY ROLLUP (store_id, month)""").collect()
    assert sorted(r.g for r in levels) == [0, 0, 0, 1, 1, 3] and max(r.v for r in levels) == 40
    days = spark.sql("SELECT quantity, weekday(date) > 4 AS weekend FROM sales_fact_t JOIN date_dim_t USING (date_sk)").collect()
    assert sum(r.quantity for r in days if r.weekend) == 3  # 2020-01-04 is a Saturday
    unknown = spark.sql("SELECT count_if(gender IS NULL) FROM customer_dim_t").first()[0]
    assert unknown == 1
    cols = spark.table("sales_fact_t").columns
    assert "batch_id" not in cols and "sale_year" not in cols


def test_create_and_drop(wh):
    wh.create()
    assert wh.read("sales_fact").count() == 0 and wh.exists("customer_dim")
    wh.drop_all()
    assert not wh.exists("sales_fact") and not wh.exists("customer_dim")
