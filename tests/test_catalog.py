import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return check.database(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, database, name):
    assert check.compare(spark, database, name, SF) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 1


def test_registration():
    assert set(entry.oracle_sql()) <= set(entry.queries())
