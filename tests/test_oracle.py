"""Every query of the engine's catalogue against SQL on the same tables."""

import __spark_entry__ as entry
import pytest
from compare import connect, differences
from pointloom.plans import oracle, queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_engine_query_has_sql():
    assert set(queries.ALL) == set(oracle.ALL)
    assert set(queries.ALL) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.ALL))
def test_query(spark, sf_dir, con, name):
    mine, theirs, extra, missing, notes = differences(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name])
    assert not notes
    assert (extra, missing) == ([], [])
    assert mine == theirs
