"""User-defined aggregates and table functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewright.functions.aggregates import GeometricMean, LargestMean, Slope, aggregate_by
from framewright.functions.tables import register_runs, value_runs
from framewright.plans.catalog import register
from framewright.sources.tables import Tables


@register("udaf_supplier_prices", covers=("user-defined aggregate",), oracle="""
SELECT l_suppkey, round(exp(avg(ln(l_extendedprice))), 4) AS typical_price,
       round(list_avg(list_slice(list_reverse_sort(list(l_extendedprice)), 1, 5)), 4) AS top_price,
       round(regr_slope(l_extendedprice, l_quantity), 4) AS price_per_unit
FROM lineitem GROUP BY l_suppkey
""")
def udaf_supplier_prices(spark, sf_dir):
    """Three aggregates with states of their own in one pass over lineitem, by supplier."""
    return _prices(Tables(spark, sf_dir).lineitem, ["l_suppkey"])


@register("udaf_total_prices", covers=("user-defined aggregate",), oracle="""
SELECT round(exp(avg(ln(l_extendedprice))), 4) AS typical_price,
       round(list_avg(list_slice(list_reverse_sort(list(l_extendedprice)), 1, 5)), 4) AS top_price,
       round(regr_slope(l_extendedprice, l_quantity), 4) AS price_per_unit
FROM lineitem
""")
def udaf_total_prices(spark, sf_dir):
    """The same without keys: one state per task meets in the last one."""
    return _prices(Tables(spark, sf_dir).lineitem, [])


def _prices(lines, keys):
    price = "l_extendedprice"
    found = aggregate_by(lines, keys, {"typical_price": (GeometricMean(), [price]), "top_price": (LargestMean(5), [price]),
                                       "price_per_unit": (Slope(), [price, "l_quantity"])})
    return found.select(*keys, *[F.round(c, 4).alias(c) for c in ("typical_price", "top_price", "price_per_unit")])


_RUNS_SQL = """
WITH o AS (
  SELECT user_id, ts, event_type,
         row_number() OVER w - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts NULLS FIRST) AS run
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_type NULLS FIRST))
SELECT user_id, event_type, min(ts) AS run_start, max(ts) AS run_end, count(*) AS n_rows
FROM o GROUP BY user_id, event_type, run
"""


@register("udtf_event_runs", covers=("user-defined table function",), oracle=_RUNS_SQL)
def udtf_event_runs(spark, sf_dir):
    """Runs of equal event types of each user, found slice by slice."""
    return value_runs(Tables(spark, sf_dir).events, ["user_id"], "ts", "event_type", "7 days")


@register("udtf_event_runs_sql", covers=("user-defined table function",), oracle=_RUNS_SQL)
def udtf_event_runs_sql(spark, sf_dir):
    """The table function called from SQL, one partition per user."""
    ev = Tables(spark, sf_dir).events.select("user_id", "ts", "event_type")
    name = register_runs(spark, "event_runs", ev, ["user_id"], "ts", "event_type")
    return spark.sql(f"""SELECT user_id, event_type, first AS run_start, last AS run_end, n AS n_rows
                         FROM {name}(TABLE(SELECT * FROM {{events}}) PARTITION BY user_id ORDER BY (ts, event_type))""", events=ev)
