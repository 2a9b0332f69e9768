"""Every registered query against its SQL counterpart, over whole tables."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
# pairs of opened and merged pull requests are too rare in the smallest data set
LARGER = {"pr_lead_time": "/root/testdata/sf0.01"}


@pytest.fixture(scope="module")
def duck():
    return {folder: connect(folder) for folder in {SF_DIR, *LARGER.values()}}


def test_every_query_has_sql():
    assert set(entry.analytics_queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(entry.analytics_queries()))
def test_query(spark, duck, name):
    folder = LARGER.get(name, SF_DIR)
    assert compare(spark, duck[folder], name, folder) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
