"""Every registered query against its oracle, and the flagship entry."""

import __spark_entry__ as driver
import pytest
from compare import difference, oracle_connection

from hushline.plans import catalogue, oracles

QUERIES = catalogue.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(name, spark, sf_dir, con):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_flag_counts_are_the_documented_ones(spark):
    row = QUERIES["context_flag_counts"](spark, "/root/testdata/sf0.01").first()
    assert tuple(row)[:10] == (60000, 1430, 1430, 1429, 18571, 2142, 1428, 2142, 1428, 1430)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["conv_id", "redacted_transcript", "redacted_entity"]
    assert df.count() == 1500
