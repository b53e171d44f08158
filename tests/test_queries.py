"""Every registered query against its oracle, over whole tables at the smallest scale."""

import pytest

from compare import duck, duck_rows, spark_rows
from conftest import SF
from tallyforge.registry import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def db():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, db, key):
    names, rows = spark_rows(QUERIES[key](spark, SF))
    if key in ORACLE_SQL:
        assert (names, rows) == duck_rows(db, ORACLE_SQL[key])
    else:
        assert names


def test_entry_points(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
