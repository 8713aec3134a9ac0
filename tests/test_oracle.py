"""Every registered query against DuckDB on the same tables."""

import pytest

from sluice.plans.catalog import QUERIES
from sluice.plans.oracle import ORACLE

import __spark_entry__ as driver
from compare import connect, differences

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    found = differences(QUERIES[name](spark, SF), duck, ORACLE[name])
    assert found is None, found


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["topic", "key", "value"]
    # Route counts of the smallest tables, as listed in FIXTURES.md.
    counts = {r["topic"].split("_1018")[0]: r["count"] for r in result.groupBy("topic").count().collect()}
    assert counts == {
        "DWD_ERROR_LOG_TOPIC": 199, "DWD_PAGE_LOG_TOPIC": 595, "DWD_START_LOG_TOPIC": 221,
        "DWD_PAGE_DISPLAY_TOPIC": 284, "DWD_PAGE_ACTION_TOPIC": 323,
    }
