import pytest
from oracle import compare, connect

from docloom import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, tiny_dir, name):
    mine, other, kinds = compare(catalogue.queries()[name](spark, tiny_dir), connect(tiny_dir), catalogue.oracle_sql()[name])
    assert mine == other
    assert not kinds


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_without_sql_runs(spark, tiny_dir, name):
    assert catalogue.queries()[name](spark, tiny_dir).count() > 0


def test_entry_has_rows(spark, tiny_dir):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
