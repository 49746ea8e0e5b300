from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tillroll.schemas import CUSTOMER_MASTER, PRODUCT_MASTER, TRANSACTIONS  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="tillroll-tests")
    yield s


@pytest.fixture()
def wh(spark, tmp_path):
    from tillroll.warehouse import Warehouse

    return Warehouse(spark, str(tmp_path / "wh"))


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def M(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


_DEFAULT = object()


def product(pid, cat="Cat", price="10.00", store="S1", supplier="P1", store_name=_DEFAULT, supplier_name=_DEFAULT):
    sn = f"Store {store}" if store_name is _DEFAULT else store_name
    pn = f"Supp {supplier}" if supplier_name is _DEFAULT else supplier_name
    return (pid, cat, M(price), store, supplier, sn, pn)


def customer(cid, gender="M", age="18-25", occ="O1", city="A", stay="1", marital=0):
    return (cid, gender, age, occ, city, stay, marital)


def tx(order, cid, pid, qty, date):
    return (order, cid, pid, qty, D(date) if isinstance(date, str) else date)


@pytest.fixture()
def load(spark, wh):
    """Load hand-made rows through the real ETL; returns the star."""
    from tillroll.etl import load_batch

    def run(products, customers, transactions, batch_id=0):
        pm = spark.createDataFrame(products, PRODUCT_MASTER)
        cm = spark.createDataFrame(customers, CUSTOMER_MASTER)
        t = spark.createDataFrame(transactions, TRANSACTIONS)
        load_batch(wh, t, pm, cm, batch_id)
        return wh.star()

    return run
