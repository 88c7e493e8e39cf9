import pytest
import twins

from evenkeel.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return twins.duck(SF)


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query_matches_its_counterpart(spark, database, name):
    good, text = twins.check(spark, database, name, SF)
    assert good, text
