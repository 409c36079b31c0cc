import pytest

from framelake.plans import catalog
from tests.helpers import SMALL, same


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, name):
    same(catalog.QUERIES[name](spark, SMALL), catalog.ORACLES[name], SMALL)


def test_entry_has_all(spark):
    import __spark_entry__ as e

    assert set(catalog.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.entry(spark).columns) == 4
