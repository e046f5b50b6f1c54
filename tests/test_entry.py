"""The driver contract of __spark_entry__.py."""

import __spark_entry__ as entry_module
from framewright.plans.catalog import load_all


def test_entry_has_rows_and_stable_schema(spark):
    a = entry_module.entry(spark)
    b = entry_module.entry(spark)
    assert a.count() == 5 and a.schema == b.schema
    assert a.columns == ["s_suppkey", "s_name", "total_quantity"]


def test_oracles_name_registered_queries():
    q, o = entry_module.queries(), entry_module.oracle_sql()
    assert set(o) <= set(q)
    assert set(load_all()) <= set(o)                    # every query of the library's own catalogue
    assert all(callable(f) for f in q.values()) and all(isinstance(s, str) and s for s in o.values())


def test_command_line_list(capsys):
    from framewright.__main__ import main
    assert main(["list"]) == 0
    out = capsys.readouterr().out.splitlines()
    assert len(out) == len(load_all()) and out[0].split("\t")[0] == "agg_approx"
