"""All registered queries that have SQL against DuckDB at sf0.001.

``TILLROLL_ORACLE_DIR`` names another input.  With ``TILLROLL_NO_BROADCAST=1``
every join runs as a shuffle join, as the dimension joins would on a large
cluster.
"""

from __future__ import annotations

import os

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E

DIR = os.environ.get("TILLROLL_ORACLE_DIR", SF_SMALL)


def test_every_warehouse_query_has_sql():
    own = {n for n in E.queries() if E.corpus is None or n not in E.corpus.QUERIES}
    assert own <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "month", "day_type", "product_id", "revenue"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_sql(spark, name):
    from oracle_harness import compare, duck

    if os.environ.get("TILLROLL_NO_BROADCAST") == "1":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")

    r = compare(spark, duck(DIR), name, E.queries()[name], E.oracle_sql()[name], DIR)
    assert r["status"].startswith("ok"), r
