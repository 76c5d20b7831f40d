import pytest

from tidemark.plans.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_gives_the_rows_of_its_sql(spark, sf, same, name):
    same(QUERIES[name](spark, sf), ORACLE_SQL[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
