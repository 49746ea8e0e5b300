"""Analytics edge cases on hand-made rows (FIXTURES 4), loaded through the ETL."""

from __future__ import annotations

from conftest import customer, product, tx

from tillroll.plans import basket, demographics, growth, rollup, spikes, topn, views


def test_null_and_literal_unknown_stay_two_groups(load):
    star = load(
        [product("p1")],
        [customer("c1", gender=None), customer("c2", gender="Unknown")],
        [tx("o1", "c1", "p1", 1, "2020-01-01"), tx("o2", "c2", "p1", 2, "2020-01-01")],
    )
    rows = demographics.q2_demographics(star).collect()
    assert sorted((r.gender, r.total_quantity) for r in rows) == [("Unknown", 1), ("Unknown", 2)]


def test_mom_growth_previous_present_month_and_zero(load):
    star = load(
        [product("p1", price="10.00"), product("p0", price="0.00")],
        [customer("c1")],
        [tx("o1", "c1", "p1", 1, "2020-01-10"), tx("o2", "c1", "p1", 3, "2020-03-10"),
         tx("o3", "c1", "p0", 1, "2020-04-10"), tx("o4", "c1", "p1", 1, "2020-05-10")],
    )
    got = [(r.mon, r.mom_growth_percent) for r in growth.q9_mom_growth(star, year=2020).collect()]
    # Jan first (NULL); Mar vs Jan (gap skipped) = +200%; Apr revenue 0 -> -100%; May vs 0 -> NULL.
    assert got == [(1, None), (3, 200.0), (4, -100.0), (5, None)]


def test_volatility_calendar_month_same_year(load):
    star = load(
        [product("p1", price="10.00")],
        [customer("c1")],
        [tx("o1", "c1", "p1", 1, "2019-12-10"), tx("o2", "c1", "p1", 2, "2020-01-10"),
         tx("o3", "c1", "p1", 5, "2020-03-10"), tx("o4", "c1", "p1", 4, "2020-04-10")],
    )
    got = {(r.year, r.current_month): (r.previous_month, r.volatility_percentage)
           for r in growth.q15_volatility(star).collect()}
    assert got[(2020, 1)] == (None, 0.0)   # December of the previous year does not count
    assert got[(2020, 3)] == (None, 0.0)   # February missing: no previous month
    assert got[(2020, 4)] == (3, 20.0)     # |40 - 50| / 50


def test_half_year_empty_half_is_null(load):
    star = load([product("p1")], [customer("c1")], [tx("o1", "c1", "p1", 1, "2020-02-01")])
    r = rollup.q18_half_year(star).first()
    assert r.h1_revenue == 10.0 and r.h2_revenue is None and r.h2_quantity is None


def test_basket_pairs_count_row_pairs(load):
    star = load(
        [product("A"), product("B"), product("C")],
        [customer("c1")],
        [tx("o1", "c1", "A", 1, "2020-01-01"), tx("o1", "c1", "A", 1, "2020-01-01"),
         tx("o1", "c1", "B", 1, "2020-01-01"), tx("o2", "c1", "B", 1, "2020-01-01"),
         tx("o2", "c1", "C", 1, "2020-01-01")],
    )
    got = [tuple(r) for r in basket.q16_basket_pairs(star, n=5, seed=1, block=1).collect()]
    assert got == [("A", "B", 2), ("B", "C", 1)]


def test_basket_pruning_is_exact_on_test_data(spark):
    from tillroll.etl import testdata_star

    star = testdata_star(spark, "/root/testdata/sf0.001")
    pruned = [tuple(r) for r in basket.q16_basket_pairs(star, n=5, seed=8, block=2).collect()]
    full = (basket.pair_counts(basket.basket_lines(star))
            .join(star.product_dim.selectExpr("product_sk as sk_a", "product_id as a"), "sk_a")
            .join(star.product_dim.selectExpr("product_sk as sk_b", "product_id as b"), "sk_b")
            .selectExpr("least(a, b) as x", "greatest(a, b) as y", "times_bought_together as c")
            .orderBy("c", "x", "y", ascending=[False, True, True]).limit(5))
    assert pruned == [tuple(r) for r in full.collect()]


def test_spike_exactly_twice_average_is_normal(load):
    # Daily revenues 10, 10, 40: average 20, so 40 is exactly 2x -> Normal.
    star = load(
        [product("p1", price="10.00")],
        [customer("c1")],
        [tx("o1", "c1", "p1", 1, "2020-01-01"), tx("o2", "c1", "p1", 1, "2020-01-02"),
         tx("o3", "c1", "p1", 4, "2020-01-03")],
    )
    assert spikes.q19_spikes(star).count() == 0
    flags = {r.date_value.day: (r.status, r.multiple_of_avg) for r in spikes.q19_spike_flags(star).collect()}
    assert flags[3] == ("Normal", 2.0) and flags[1] == ("Normal", 0.5)


def test_spike_text(load):
    star = load(
        [product("p1", price="10.05")],
        [customer("c1")],
        [tx("o1", "c1", "p1", 1, "2020-01-01"), tx("o2", "c1", "p1", 1, "2020-01-02"),
         tx("o3", "c1", "p1", 1, "2020-01-04"), tx("o4", "c1", "p1", 9, "2020-01-03")],
    )
    r = spikes.q19_spikes(star).first()
    # (3 x 10.05 + 90.45) / 4 = 30.15
    assert r.explanation == "Sales spike: 90.45 exceeds 2x average of 30.15"
    assert r.anomaly_flag == "OUTLIER - Spike Detected"


def test_rollup_null_store_name_distinct_from_subtotal(load):
    star = load(
        [product("p1", store="S1", store_name=None), product("p2", store="S2", store_name="Two")],
        [customer("c1")],
        [tx("o1", "c1", "p1", 1, "2020-01-01"), tx("o2", "c1", "p2", 1, "2020-01-01")],
    )
    rows = rollup.q17_rollup(star).collect()
    null_store = [(r.level_id, r.total_revenue) for r in rows if r.year == 2020 and r.store_name is None]
    assert sorted(null_store) == [(0, 10.0), (1, 10.0), (3, 10.0), (7, 20.0)]
    assert [r.total_revenue for r in rows if r.level_id == 15] == [20.0]


def test_top_n_ties_broken_by_id(load):
    star = load(
        [product("p3"), product("p1"), product("p2")],
        [customer("c1")],
        [tx("o1", "c1", "p3", 1, "2020-01-01"), tx("o2", "c1", "p1", 1, "2020-01-01"),
         tx("o3", "c1", "p2", 1, "2020-01-01")],
    )
    got = [r.product_id for r in topn.q1_top_products_daytype(star, year=2020, n=2).collect()]
    assert got == ["p1", "p2"]


def test_view_and_counts(load, spark):
    star = load(
        [product("p1"), product("p2", store="S2")],
        [customer("c1"), customer("c2")],
        [tx("o1", "c1", "p1", 1, "2020-01-01"), tx("o2", "c2", "p1", 1, "2020-05-01"),
         tx("o3", "c2", "p2", 1, "2020-05-01")],
    )
    assert views.fact_row_count(star).first().total_records == 3
    v = {(r.store_id, r.quarter): r.unique_customers for r in views.q20_store_quarterly_view(star).collect()}
    assert v == {("S1", 1): 1, ("S1", 2): 1, ("S2", 2): 1}
    assert spark.table("STORE_QUARTERLY_SALES").count() == 3


def test_basket_hot_order_prunes_to_dominant_products(load):
    # One big order with two dominant products (5 lines each) and many
    # one-line products; small orders elsewhere.
    items = [f"x{i:02d}" for i in range(20)]
    rows = [tx("big", "c1", "A", 1, "2020-01-01")] * 5 + [tx("big", "c1", "B", 1, "2020-01-01")] * 5
    rows += [tx("big", "c1", i, 1, "2020-01-01") for i in items]
    rows += [tx("o2", "c1", "A", 1, "2020-01-02"), tx("o2", "c1", "x00", 1, "2020-01-02")]
    star = load([product(p) for p in ["A", "B", *items]], [customer("c1")], rows)
    got = [tuple(r) for r in basket.q16_basket_pairs(star, n=3, seed=4, block=2).collect()]
    assert got == [("A", "B", 25), ("A", "x00", 6), ("A", "x01", 5)]


def test_basket_flat_giant_order_matches_brute_force(load, spark):
    """A giant order whose products all have tiny, equal counts: exact answer,
    decided by the id tie-break, without pairing the whole order."""
    from pyspark.sql import functions as F

    items = [f"g{i:02d}" for i in range(30)]
    rows = [tx("giant", "c1", i, 1, "2020-01-01") for i in items]
    rows += [tx("s1", "c1", "g17", 1, "2020-01-02"), tx("s1", "c1", "g25", 1, "2020-01-02"),
             tx("s2", "c1", "g03", 1, "2020-01-02"), tx("s2", "c1", "z9", 1, "2020-01-02")]
    star = load([product(p) for p in [*items, "z9"]], [customer("c1")], rows)
    got = [tuple(r) for r in basket.q16_basket_pairs(star, n=5, seed=2, block=3).collect()]
    brute = (basket.pair_counts(basket.basket_lines(star))
             .join(star.product_dim.selectExpr("product_sk as sk_a", "product_id as a"), "sk_a")
             .join(star.product_dim.selectExpr("product_sk as sk_b", "product_id as b"), "sk_b")
             .select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), "times_bought_together")
             .orderBy(F.col("times_bought_together").desc(), "x", "y").limit(5))
    assert got == [tuple(r) for r in brute.collect()]
    assert got[0] == ("g17", "g25", 2)


def test_basket_pruning_random_against_brute_force(load):
    """Random baskets with one giant order and skewed multiplicities: the
    pruned answer equals counting every row pair."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(7)
    for trial in range(2):
        prods = [f"p{i:03d}" for i in range(40)]
        rows = []
        for i in rng.sample(prods, 30):  # the giant order
            rows += [tx("giant", "c1", i, 1, "2020-01-01")] * rng.choice([1, 1, 1, 2, 3])
        for o in range(25):  # small orders with popular products
            for i in rng.sample(prods[:12], rng.randint(2, 4)):
                rows += [tx(f"o{o}", "c1", i, 1, "2020-01-02")] * rng.choice([1, 1, 2])
        star = load([product(p) for p in prods], [customer("c1")], rows, batch_id=trial)
        got = [tuple(r) for r in basket.q16_basket_pairs(star, n=5, seed=3, block=5).collect()]
        brute = (basket.pair_counts(basket.basket_lines(star))
                 .join(star.product_dim.selectExpr("product_sk as sk_a", "product_id as a"), "sk_a")
                 .join(star.product_dim.selectExpr("product_sk as sk_b", "product_id as b"), "sk_b")
                 .select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), "times_bought_together")
                 .orderBy(F.col("times_bought_together").desc(), "x", "y").limit(5))
        assert got == [tuple(r) for r in brute.collect()], trial
