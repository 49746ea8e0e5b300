"""Plan-shape guards for the scale properties the README claims."""

from __future__ import annotations

import re

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    own = {n: fn for n, fn in E.queries().items() if E.corpus is None or n not in E.corpus.QUERIES}
    return {name: _plan(fn(spark, SF_SMALL)) for name, fn in own.items()}


def test_no_cross_or_nested_loop_joins(plans):
    bad = {n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p}
    assert not bad


def test_year_filters_prune_fact_partitions(plans):
    for name in ("q1_top_products_daytype", "q4_gender_age_quarter", "q9_mom_growth",
                 "q10_age_daytype", "q11_top_products_category", "q12_store_growth", "q6_city_marital_recent"):
        assert re.search(r"PartitionFilters: \[[^\]]*sale_year#\d+ = \d{4}", plans[name]) or \
            re.search(r"PartitionFilters: \[[^\]]*sale_year#\d+ IN \(", plans[name]), name


def test_fact_scan_reads_only_needed_columns(plans):
    scans = re.findall(r"sales_fact\][^\n]*ReadSchema: (struct<[^>]*>)", plans["q1_top_products_daytype"])
    assert scans and all(s == "struct<product_sk:bigint,date_sk:bigint,total_price:decimal(10,2)>" for s in scans)


def test_top_n_uses_window_group_limit(plans):
    for name in ("q1_top_products_daytype", "q5_top_occupations", "q8_top_cities", "q11_top_products_category"):
        assert "WindowGroupLimit" in plans[name], name


def test_rollup_expands_pre_aggregated_base(plans):
    p = plans["q17_rollup"]
    expand = p.index("Expand")
    assert "HashAggregate" in p[expand:], "an aggregation must sit below the Expand"
