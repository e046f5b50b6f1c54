"""Every registered query has an oracle and matches DuckDB at sf0.01."""

import pytest

from framewright.plans.catalog import load_all
from tests.conftest import SF01
from tests.oracle import compare

QUERIES = load_all()
WITH_ORACLE = sorted(n for n, q in QUERIES.items() if q.oracle)
WITHOUT_ORACLE = sorted(n for n, q in QUERIES.items() if not q.oracle)


@pytest.mark.parametrize("name", WITH_ORACLE)
def test_matches_duckdb(spark, duck01, name):
    q = QUERIES[name]
    compare(q.build(spark, SF01), duck01, q.oracle)


def test_every_query_has_an_oracle():
    assert WITHOUT_ORACLE == []
