"""Every registered query for training data on the smallest data: it runs, and gives the rows of its SQL."""

import pytest

from termweave.llm import queries

MODULES = [queries]
QUERIES = {k: f for m in MODULES for k, f in m.queries().items()}
SQL = {k: s for m in MODULES for k, s in m.oracle_sql().items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(same_as_sql, name):
    same_as_sql(QUERIES[name], SQL.get(name))


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
