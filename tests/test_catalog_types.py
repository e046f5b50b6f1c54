"""Spark result types and DuckDB oracle types agree column by column."""

import pytest

from framewright.plans.catalog import load_all
from tests.conftest import SF01

QUERIES = load_all()
WITH_ORACLE = sorted(n for n, q in QUERIES.items() if q.oracle)
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


@pytest.mark.parametrize("name", WITH_ORACLE)
def test_types_agree(spark, duck01, name):
    q = QUERIES[name]
    spark_types = dict(q.build(spark, SF01).dtypes)
    duck_types = {d[0]: str(d[1]) for d in duck01.execute(f"SELECT * FROM ({q.oracle}) LIMIT 0").description}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in spark_types.items()} == duck_types
