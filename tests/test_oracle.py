"""Every registered query against its SQL on the smallest data set."""

import compare
import pytest

import __spark_entry__ as contract

SQL = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, sf_dir, name):
    columns, rows = compare.spark_rows(QUERIES[name](spark, sf_dir))
    names, wanted, _ = compare.duck_rows(duck, SQL[name])
    assert columns == names
    assert rows == wanted
    assert rows


def test_entry_has_the_feature_schema(spark):
    from loadcast.schemas import FEATURES

    df = contract.entry(spark)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in FEATURES]
    assert df.count() == 998
