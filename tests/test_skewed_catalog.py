"""Every oracle query still matches DuckDB when a third of the rows share one key, and when join
and grouping keys hold nulls.

The fixture folder holds hot-key copies of lineitem, orders and events (a third of lineitem rows
on one supplier, another third on one order; a third of orders on one customer; a third of events
on one user) and links to the other tables of sf0.01.
"""

import os
import tempfile

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

from framewright.plans.catalog import load_all
from framewright.sources.tables import TABLES
from tests.conftest import SF01
from tests.oracle import compare, duck

QUERIES = load_all()
WITH_ORACLE = sorted(n for n, q in QUERIES.items() if q.oracle)


def _hot(table: pa.Table, column: str, residue: int, value) -> pa.Table:
    hot = pa.array([i % 3 == residue for i in range(table.num_rows)])
    col = table[column]
    new = pc.if_else(hot, pa.scalar(value, col.type), col)
    return table.set_column(table.schema.get_field_index(column), column, new)


@pytest.fixture(scope="module")
def skewed_dir():
    d = tempfile.mkdtemp(prefix="fw-skew-")
    li = pq.read_table(f"{SF01}/lineitem.parquet")
    li = _hot(_hot(li, "l_suppkey", 0, 1), "l_orderkey", 1, 7)
    orders = _hot(pq.read_table(f"{SF01}/orders.parquet"), "o_custkey", 0, 5)
    events = _hot(pq.read_table(f"{SF01}/events.parquet"), "user_id", 0, 3)
    written = {"lineitem": li, "orders": orders, "events": events}
    for t in TABLES:
        if t in written:
            pq.write_table(written[t], f"{d}/{t}.parquet")
        else:
            os.symlink(f"{SF01}/{t}.parquet", f"{d}/{t}.parquet")
    return d


@pytest.fixture(scope="module")
def duck_skewed(skewed_dir):
    return duck(skewed_dir)


def _nulled(table: pa.Table, column: str, every: int, residue: int) -> pa.Table:
    mask = pa.array([i % every == residue for i in range(table.num_rows)])
    col = table[column]
    new = pc.if_else(mask, pa.scalar(None, col.type), col)
    return table.set_column(table.schema.get_field_index(column), column, new)


@pytest.fixture(scope="module")
def null_key_dir():
    """Null join and grouping keys: lineitem supplier and order keys, order customers, event users."""
    d = tempfile.mkdtemp(prefix="fw-nullkeys-")
    li = _nulled(_nulled(pq.read_table(f"{SF01}/lineitem.parquet"), "l_suppkey", 7, 3), "l_orderkey", 11, 5)
    orders = _nulled(pq.read_table(f"{SF01}/orders.parquet"), "o_custkey", 13, 2)
    events = _nulled(pq.read_table(f"{SF01}/events.parquet"), "user_id", 17, 4)
    written = {"lineitem": li, "orders": orders, "events": events}
    for t in TABLES:
        if t in written:
            pq.write_table(written[t], f"{d}/{t}.parquet")
        else:
            os.symlink(f"{SF01}/{t}.parquet", f"{d}/{t}.parquet")
    return d


@pytest.mark.parametrize("name", WITH_ORACLE)
def test_matches_duckdb_on_hot_keys(spark, skewed_dir, duck_skewed, name):
    q = QUERIES[name]
    compare(q.build(spark, skewed_dir), duck_skewed, q.oracle)


@pytest.fixture(scope="module")
def duck_null_keys(null_key_dir):
    return duck(null_key_dir)


@pytest.mark.parametrize("name", WITH_ORACLE)
def test_matches_duckdb_with_null_keys(spark, null_key_dir, duck_null_keys, name):
    q = QUERIES[name]
    compare(q.build(spark, null_key_dir), duck_null_keys, q.oracle)
