"""Conservation properties over the sf0.001 warehouse."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tillroll.plans import basket, rollup, spikes, views


@pytest.fixture(scope="module")
def star(spark):
    from tillroll.etl import testdata_star

    return testdata_star(spark, SF_SMALL)


def _fact_total(star) -> float:
    return float(star.sales_fact.agg(F.sum("total_price")).first()[0])


def test_rollup_grand_total_is_fact_sum(star):
    rows = rollup.q17_rollup(star).where(F.col("level_id") == 15).collect()
    assert len(rows) == 1
    assert rows[0].total_revenue == _fact_total(star)
    assert rows[0].transaction_count == star.sales_fact.count()


def test_half_years_add_up(star):
    bad = rollup.q18_half_year(star).where(
        F.abs(F.coalesce("h1_revenue", F.lit(0.0)) + F.coalesce("h2_revenue", F.lit(0.0)) - F.col("yearly_revenue")) > 1e-6
    )
    assert bad.count() == 0
    q = rollup.q18_half_year(star).agg(F.sum("yearly_quantity")).first()[0]
    assert q == star.sales_fact.agg(F.sum("quantity")).first()[0]


def test_store_supplier_product_covers_fact(star):
    agg = rollup.q13_store_supplier_product(star).agg(F.sum("total_sales"), F.sum("transaction_count")).first()
    assert abs(agg[0] - _fact_total(star)) < 1e-6 and agg[1] == star.sales_fact.count()


def test_view_covers_fact(star):
    agg = views.q20_store_quarterly_view(star).agg(F.sum("transaction_count")).first()[0]
    assert agg == star.sales_fact.count()


def test_spike_report_is_subset_of_flags(star):
    flagged = spikes.q19_spike_flags(star).where(F.col("status") != "Normal").count()
    assert spikes.q19_spikes(star).count() == flagged


def test_matched_plus_quarantined_is_input(spark):
    from tillroll.etl import testdata_inputs
    from tillroll.operators.facts import enrich
    from tillroll.etl import ingest_metrics

    m = ingest_metrics(enrich(*testdata_inputs(spark, SF_SMALL))).first()
    assert m.input_rows == m.matched_rows + m.quarantined_rows > 0


def test_basket_counts_match_brute_force(star):
    """A16's pruned answer equals counting every row pair with plain SQL logic."""
    f = star.sales_fact.select("order_id", "product_sk")
    a, b = f.alias("a"), f.alias("b")
    brute = (
        a.join(b, (F.col("a.order_id") == F.col("b.order_id")) & (F.col("a.product_sk") < F.col("b.product_sk")))
        .groupBy(F.col("a.product_sk").alias("x"), F.col("b.product_sk").alias("y")).count()
    )
    ids = star.product_dim.select("product_sk", "product_id")
    brute = (
        brute.join(ids.withColumnRenamed("product_sk", "x").withColumnRenamed("product_id", "ix"), "x")
        .join(ids.withColumnRenamed("product_sk", "y").withColumnRenamed("product_id", "iy"), "y")
        .select(F.least("ix", "iy").alias("a"), F.greatest("ix", "iy").alias("b"), F.col("count").alias("c"))
        .orderBy(F.col("c").desc(), "a", "b").limit(5)
    )
    assert [tuple(r) for r in basket.q16_basket_pairs(star).collect()] == [tuple(r) for r in brute.collect()]
