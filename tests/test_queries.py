import pytest

from tessitura import plans

from .oracle import compare


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_against_sql(spark, sf_dir, name):
    compare(spark, plans.QUERIES[name], plans.ORACLES[name], sf_dir)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLES)))
def test_runs(spark, sf_dir, name):
    df = plans.QUERIES[name](spark, sf_dir)
    assert df.columns and df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
