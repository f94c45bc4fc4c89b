import pytest

from ledgerlens.oracles import ORACLES
from ledgerlens.queries import QUERIES

from .compare import differences


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name not in ORACLES:
        assert df.count() > 0
        return
    got, want = differences(df, ORACLES[name], sf_dir)
    assert got == want
    assert got


def test_entry_works_alone():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
