import pytest

from textmill.queries import ORACLES, QUERIES
from tests.oracle import difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert difference(df, ORACLES[name], SF_DIR) is None
    else:
        assert df.collect()


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 20
