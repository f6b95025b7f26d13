import pytest

from larder.plans.registry import ORACLES, QUERIES

from .oracle import same


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    same(spark, QUERIES[name], ORACLES[name])


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
