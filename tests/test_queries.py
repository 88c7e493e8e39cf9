import pytest
import twins

import __spark_entry__ as spark_entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return twins.duck(SF)


def test_every_query_has_a_counterpart():
    assert set(spark_entry.table_queries()) == set(spark_entry.table_sql())


@pytest.mark.parametrize("name", spark_entry.table_queries())
def test_query_matches_its_counterpart(spark, database, name):
    good, text = twins.check(spark, database, name, SF)
    assert good, text


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 1
