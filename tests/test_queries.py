"""Every registered query against its check SQL, over the whole small tables."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

import __spark_entry__ as driver
import oracle_compare
from tillflow.plans.catalogue import QUERIES

SF_DIR = os.environ.get("TILLFLOW_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle_compare.connect(SF_DIR)


def test_every_query_has_check_sql():
    assert set(QUERIES) <= set(driver.queries())
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = driver.queries()[name](spark, SF_DIR)
    assert oracle_compare.differences(frame, con, driver.oracle_sql()[name]) == []


def test_entry(spark):
    assert driver.entry(spark).columns == driver.queries()["gold_daily_sales"](spark, SF_DIR).columns
