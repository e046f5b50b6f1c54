"""Queries over aggregates and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewright.operators import aggregate as agg
from framewright.operators import windows
from framewright.plans.catalog import register
from framewright.sources.tables import Tables


@register("agg_counts", covers=("A1", "A2", "A4", "A9", "L2"), oracle="""
SELECT count(*) AS n_rows, count(nullif(l_discount, 0.0)) AS n_discounted,
       count(DISTINCT l_partkey) AS n_parts, sum(DISTINCT l_quantity) AS sum_distinct_quantity
FROM lineitem
""")
def agg_counts(spark, sf_dir):
    """Each distinct aggregate works on its own deduplicated keys, so no row is expanded."""
    li = Tables(spark, sf_dir).lineitem
    counts = li.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.count(F.nullif(F.col("l_discount"), F.lit(0.0))).alias("n_discounted"))
    parts = li.select("l_partkey").distinct().agg(F.count("l_partkey"))
    quantities = li.select("l_quantity").distinct().agg(F.sum("l_quantity"))
    return counts.select("n_rows", "n_discounted", parts.scalar().alias("n_parts"),
                         quantities.scalar().alias("sum_distinct_quantity"))


@register("agg_stats", covers=("A10", "A11", "A12", "A13", "A14", "A15", "A16"), oracle="""
SELECT round(avg(l_quantity), 6) AS avg_x, round(avg(l_quantity), 6) AS mean_x,
       round(sum(l_quantity) / count(l_quantity), 6) AS sum_over_count_x,
       round(var_pop(l_quantity), 6) AS var_pop_x, round(var_samp(l_quantity), 6) AS var_samp_x,
       round(stddev_pop(l_quantity), 6) AS stddev_pop_x, round(stddev_samp(l_quantity), 6) AS stddev_samp_x,
       round(skewness(l_quantity) * (count(l_quantity) - 2) / sqrt(count(l_quantity) * (count(l_quantity) - 1)), 6)
         AS skewness_x,
       round(kurtosis_pop(l_quantity), 6) AS kurtosis_x,
       round(corr(l_quantity, l_discount), 6) AS corr_xy,
       round(covar_samp(l_quantity, l_discount), 6) AS covar_samp_xy,
       round(covar_pop(l_quantity, l_discount), 6) AS covar_pop_xy
FROM lineitem
""")
def agg_stats(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    cols = agg.moments("l_quantity", "l_discount")
    out = li.agg(*cols)
    return out.select(*[F.round(F.col(c), 6).alias(c) for c in out.columns])


QUARTERS = (0.25, 0.5, 0.75)

# An estimate is checked against exact facts: the rank of a quantile estimate q is between the shares
# of rows below q and at most q; a distinct count is within a multiple of its standard error.
_APPROX_SQL = """
SELECT count(DISTINCT l_partkey) AS n_parts, true AS parts_close, count(l_quantity) AS n_quantities, true AS quartiles_close
FROM lineitem
"""


def _approx_report(li, parts, quartiles, relative_error, rank_error):
    """One row of exact counts and whether the estimates (scalar columns) are within their errors."""
    rows = li.select("l_quantity", quartiles.alias("q"))
    total = F.count("l_quantity")
    checks = [(F.count(F.when(F.col("l_quantity") < F.col("q")[i], 1)) / total <= p + rank_error)
              & (F.count(F.when(F.col("l_quantity") <= F.col("q")[i], 1)) / total >= p - rank_error) for i, p in enumerate(QUARTERS)]
    facts = rows.agg(total.alias("n_quantities"), (checks[0] & checks[1] & checks[2]).alias("quartiles_close"))
    exact = li.select("l_partkey").distinct().agg(F.count("l_partkey")).scalar()
    return facts.select(exact.alias("n_parts"), (F.abs(parts - exact) <= relative_error * exact).alias("parts_close"),
                        "n_quantities", "quartiles_close")


@register("agg_approx", covers=("A5", "A28"), oracle=_APPROX_SQL)
def agg_approx(spark, sf_dir):
    """The estimates against exact facts over all rows: three standard errors, and the rank error of
    the accuracy asked for."""
    li = Tables(spark, sf_dir).lineitem
    parts = li.agg(agg.approx_distinct("l_partkey", 0.1)).scalar()
    quartiles = li.agg(agg.approx_quantiles("l_quantity", list(QUARTERS))).scalar()
    return _approx_report(li, parts, quartiles, 0.3, 0.001)


@register("agg_collect", covers=("A17",), oracle="""
SELECT c_nationkey, array_to_string(list_sort(list_distinct(list(c_mktsegment))), ',') AS segments
FROM customer GROUP BY c_nationkey
""")
def agg_collect(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.groupBy("c_nationkey").agg(F.array_join(agg.sorted_set("c_mktsegment"), ",").alias("segments"))


@register("agg_collect_pairs", covers=("A17",), oracle="""
SELECT c_nationkey, string_agg(c_mktsegment || ':' || n, ',' ORDER BY c_mktsegment) AS segment_counts
FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2)
GROUP BY c_nationkey
""")
def agg_collect_pairs(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    lists = agg.sorted_list_of_pairs(c, ["c_nationkey"], "c_mktsegment")
    text = F.array_join(F.transform("c_mktsegment_counts",
                                    lambda x: F.concat(x["c_mktsegment"], F.lit(":"), x["n"].cast("string"))), ",")
    return lists.select("c_nationkey", text.alias("segment_counts"))


@register("agg_first_last_by", covers=("A6",), oracle="""
SELECT o_custkey, arg_min(o_totalprice, o_orderkey) AS price_first, arg_max(o_totalprice, o_orderkey) AS price_last,
       min(o_orderdate) AS first_date, max(o_orderdate) AS last_date
FROM orders GROUP BY o_custkey
""")
def agg_first_last_by(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return o.groupBy("o_custkey").agg(*agg.first_last_by("o_totalprice", "o_orderkey", "price"),
                                      F.min("o_orderdate").alias("first_date"),
                                      F.max("o_orderdate").alias("last_date"))


@register("agg_multi", covers=("A3", "A18", "A19"), oracle="""
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS sum_qty,
       round(avg(l_extendedprice), 4) AS avg_price, round(stddev_samp(l_quantity), 6) AS sd_qty,
       max(l_discount) AS max_disc
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def agg_multi(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return agg.group_agg(li, ["l_returnflag", "l_linestatus"],
                         F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("sum_qty"),
                         F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
                         F.round(F.stddev_samp("l_quantity"), 6).alias("sd_qty"),
                         F.expr("max(l_discount)").alias("max_disc"))


@register("agg_numeric_averages", covers=("A20",), oracle="""
SELECT l_returnflag, round(avg(l_quantity), 6) AS avg_l_quantity, round(avg(l_discount), 6) AS avg_l_discount,
       round(avg(l_tax), 6) AS avg_l_tax
FROM lineitem GROUP BY l_returnflag
""")
def agg_numeric_averages(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_returnflag", "l_quantity", "l_discount", "l_tax")
    out = agg.averages_of_numeric(li, ["l_returnflag"])
    return out.select("l_returnflag", *[F.round(c, 6).alias(c) for c in out.columns if c != "l_returnflag"])


_GROUPED_INPUT = "(SELECT CAST(l_shipdate AS DATE) AS ship_date, l_returnflag, l_quantity FROM lineitem)"


def _ship_flag(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.select(F.to_date("l_shipdate").alias("ship_date"), "l_returnflag", "l_quantity")


_AGGS_SQL = "sum(l_quantity) AS total_quantity, count(*) AS n, grouping(ship_date, l_returnflag) AS grouping_id"


MEASURES = {"total_quantity": ("sum", "l_quantity"), "n": ("count", None)}


@register("agg_rollup", covers=("A21", "A24"), oracle=f"""
SELECT ship_date, l_returnflag, {_AGGS_SQL} FROM {_GROUPED_INPUT}
GROUP BY ROLLUP (ship_date, l_returnflag)
""")
def agg_rollup(spark, sf_dir):
    return agg.levels_of_totals(_ship_flag(spark, sf_dir), ["ship_date", "l_returnflag"], "rollup", MEASURES)


@register("agg_cube", covers=("A22", "A24"), oracle=f"""
SELECT ship_date, l_returnflag, {_AGGS_SQL} FROM {_GROUPED_INPUT}
GROUP BY CUBE (ship_date, l_returnflag)
""")
def agg_cube(spark, sf_dir):
    return agg.levels_of_totals(_ship_flag(spark, sf_dir), ["ship_date", "l_returnflag"], "cube", MEASURES)


@register("agg_grouping_sets", covers=("A23", "A24"), oracle=f"""
SELECT ship_date, l_returnflag, {_AGGS_SQL} FROM {_GROUPED_INPUT}
GROUP BY GROUPING SETS ((ship_date), (l_returnflag))
""")
def agg_grouping_sets(spark, sf_dir):
    return agg.levels_of_totals(_ship_flag(spark, sf_dir), ["ship_date", "l_returnflag"],
                                [["ship_date"], ["l_returnflag"]], MEASURES)


# The pivot's columns come from the data, so its answer is returned with one row per key and column
# name: SQL cannot name columns that it does not know.
@register("agg_pivot", covers=("A25",), oracle="""
SELECT s.l_suppkey, f.flag, sum(l.l_quantity) AS total
FROM (SELECT DISTINCT l_suppkey FROM lineitem) s CROSS JOIN (SELECT DISTINCT l_returnflag AS flag FROM lineitem) f
LEFT JOIN lineitem l ON l.l_suppkey IS NOT DISTINCT FROM s.l_suppkey AND l.l_returnflag IS NOT DISTINCT FROM f.flag
GROUP BY s.l_suppkey, f.flag
""")
def agg_pivot(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    flags = agg.values_of(li, "l_returnflag")
    wide = agg.pivot_values(li, ["l_suppkey"], "l_returnflag", flags, F.sum, "l_quantity")
    return _long_form(wide, "l_suppkey", "flag", "total")


def _long_form(wide, key, name, value):
    from framewright.operators.project import quoted
    cells = [F.struct(F.lit(c).alias(name), F.col(quoted(c)).alias(value)) for c in wide.columns if c != key]
    return wide.select(key, F.explode(F.array(*cells)).alias("cell")).select(key, f"cell.{name}", f"cell.{value}")


@register("crosstab_pairs", covers=("A29",), oracle="""
SELECT p_type, p_size, count(*) AS n FROM part GROUP BY p_type, p_size
""")
def crosstab_pairs(spark, sf_dir):
    return agg.crosstab_pairs(Tables(spark, sf_dir).part, "p_type", "p_size")


@register("crosstab_wide", covers=("A29",), oracle="""
SELECT b.p_brand AS p_brand_p_type, t.p_type AS type, count(p.p_partkey) AS n
FROM (SELECT DISTINCT p_brand FROM part) b CROSS JOIN (SELECT DISTINCT p_type FROM part) t
LEFT JOIN part p ON p.p_brand = b.p_brand AND p.p_type = t.p_type
GROUP BY b.p_brand, t.p_type
""")
def crosstab_wide(spark, sf_dir):
    part = Tables(spark, sf_dir).part
    wide = agg.crosstab(part, "p_brand", "p_type", agg.values_of(part, "p_type"))
    return _long_form(wide, "p_brand_p_type", "type", "n")


@register("freq_items", covers=("A30",), oracle="""
SELECT 'p_type' AS item_column, p_type AS item, count(*) AS n FROM part
GROUP BY p_type HAVING count(*) > 0.1 * (SELECT count(*) FROM part)
UNION ALL
SELECT 'p_brand', p_brand, count(*) FROM part GROUP BY p_brand HAVING count(*) > 0.1 * (SELECT count(*) FROM part)
""")
def freq_items(spark, sf_dir):
    """The sketch's candidates with exact counts: it holds every frequent item, and counting removes
    what it reports beside them."""
    part = Tables(spark, sf_dir).part
    found = agg.frequent_items(part, ["p_type", "p_brand"], 0.1)
    total = part.agg(F.count(F.lit(1))).scalar()
    out = None
    for c in ("p_type", "p_brand"):
        items = found.select(F.explode(f"{c}_freqItems").alias(c)).distinct()
        exact = part.join(items, c).groupBy(F.lit(c).alias("item_column"), F.col(c).alias("item")).agg(F.count(F.lit(1)).alias("n"))
        exact = exact.where(F.col("n") > F.lit(0.1).cast("decimal(2,1)") * total)
        out = exact if out is None else out.unionByName(exact)
    return out


@register("frequent_values", covers=("A30",), oracle="""
SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand
HAVING count(*) >= 0.04 * (SELECT count(*) FROM part)
""")
def frequent_values(spark, sf_dir):
    return agg.frequent_values(Tables(spark, sf_dir).part, "p_brand", 0.04)


@register("describe_table", covers=("A27",), oracle="""
SELECT unnest(['count', 'mean', 'stddev', 'min', 'max']) AS summary,
       unnest([count(p_size)::DOUBLE, round(avg(p_size), 6), round(stddev_samp(p_size), 6), min(p_size)::DOUBLE, max(p_size)::DOUBLE]) AS p_size,
       unnest([count(p_retailprice)::DOUBLE, round(avg(p_retailprice), 6), round(stddev_samp(p_retailprice), 6),
               min(p_retailprice), max(p_retailprice)]) AS p_retailprice
FROM part
""")
def describe_table(spark, sf_dir):
    """The summary's cells, which are text, as numbers."""
    cells = agg.summary(Tables(spark, sf_dir).part, "p_size", "p_retailprice")
    return cells.select("summary", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in ("p_size", "p_retailprice")])


@register("spend_per_customer_day", covers=("A26", "D12"), oracle="""
SELECT o_custkey, date_trunc('day', o_orderdate) AS window_start,
       date_trunc('day', o_orderdate) + INTERVAL 1 DAY AS window_end,
       round(sum(o_totalprice), 2) AS total_spend, count(*) AS n_orders
FROM orders GROUP BY 1, 2, 3
""")
def spend_per_customer_day(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return agg.time_bucket(o, ["o_custkey"], "o_orderdate", "1 day",
                           F.round(F.sum("o_totalprice"), 2).alias("total_spend"),
                           F.count(F.lit(1)).alias("n_orders"))


_RANK_SQL = """
SELECT l_suppkey, ship_date, l_orderkey, l_linenumber, l_quantity,
       max(l_quantity) OVER (PARTITION BY l_suppkey, ship_date ORDER BY l_quantity DESC
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS max_quantity,
       dense_rank() OVER (PARTITION BY l_suppkey, ship_date ORDER BY l_quantity DESC) AS quantity_dense_rank,
       rank() OVER (PARTITION BY l_suppkey, ship_date ORDER BY l_quantity DESC) AS quantity_rank
FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS ship_date, l_orderkey, l_linenumber, l_quantity
      FROM lineitem WHERE l_suppkey IS NOT NULL)
"""
_RANK_NAMES = ("max_quantity", "quantity_dense_rank", "quantity_rank")


def _rank_input(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.where(F.col("l_suppkey").isNotNull())
    return li.select("l_suppkey", F.to_date("l_shipdate").alias("ship_date"), "l_orderkey", "l_linenumber",
                     "l_quantity")


def _long_ranks(df):
    """The single window's ranks are Spark's 32-bit ones; the other forms count in 64 bits."""
    return df.withColumns({n: F.col(n).cast("long") for n in _RANK_NAMES[1:]})


@register("ranked_purchases", covers=("W1", "W2", "W3", "W4", "W5", "F13"), oracle=_RANK_SQL)
def ranked_purchases(spark, sf_dir):
    """The ranked report, skew-safe: hot groups are ranked from pre-aggregated counts that are split by
    value, the others in one window."""
    return windows.ranked_report(_rank_input(spark, sf_dir), ["l_suppkey", "ship_date"], "l_quantity", _RANK_NAMES, method="hot")


@register("ranked_purchases_slices", covers=("W1", "W2", "W3", "W4", "W5"), oracle=_RANK_SQL)
def ranked_purchases_slices(spark, sf_dir):
    """The ranked report with every group ranked from pre-aggregated counts that are split by value."""
    return windows.ranked_report(_rank_input(spark, sf_dir), ["l_suppkey", "ship_date"], "l_quantity", _RANK_NAMES)


@register("ranked_purchases_counts", covers=("W1", "W2", "W3", "W4", "W5"), oracle=_RANK_SQL)
def ranked_purchases_counts(spark, sf_dir):
    """The ranked report with every group ranked from pre-aggregated counts."""
    return windows.ranked_report(_rank_input(spark, sf_dir), ["l_suppkey", "ship_date"], "l_quantity", _RANK_NAMES,
                                 method="counts")


@register("ranked_purchases_window", covers=("W1", "W2", "W3", "W4", "W5"), oracle=_RANK_SQL)
def ranked_purchases_window(spark, sf_dir):
    return _long_ranks(windows.ranked_report_window(_rank_input(spark, sf_dir), ["l_suppkey", "ship_date"],
                                                    "l_quantity", _RANK_NAMES))


@register("events_user_day", covers=("A26", "D12"), oracle="""
SELECT user_id, date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       count(*) AS n_events, round(sum(value), 2) AS total_value
FROM events GROUP BY 1, 2, 3
""")
def events_user_day(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return agg.time_bucket(ev, ["user_id"], "ts", "1 day", F.count(F.lit(1)).alias("n_events"),
                           F.round(F.sum("value"), 2).alias("total_value"))


@register("count_distinct_parts", covers=("A4",), oracle="""
SELECT count(DISTINCT l_partkey) AS n_parts FROM lineitem
""")
def count_distinct_parts(spark, sf_dir):
    return Tables(spark, sf_dir).lineitem.agg(F.count_distinct("l_partkey").alias("n_parts"))


@register("approx_distinct_parts", covers=("A5",), oracle="""
SELECT count(DISTINCT l_partkey) AS n_parts, true AS parts_close FROM lineitem
""")
def approx_distinct_parts(spark, sf_dir):
    """A HyperLogLog++ estimate with relative error 0.1, against the exact count."""
    li = Tables(spark, sf_dir).lineitem
    exact = li.select("l_partkey").distinct().agg(F.count("l_partkey").alias("n_parts"))
    estimate = li.agg(agg.approx_distinct("l_partkey", 0.1)).scalar()
    return exact.select("n_parts", (F.abs(estimate - F.col("n_parts")) <= 0.3 * F.col("n_parts")).alias("parts_close"))


@register("agg_approx_tree", covers=("A5", "A28"), oracle=_APPROX_SQL)
def agg_approx_tree(spark, sf_dir):
    """The two-level sketch forms (DataSketches KLL and HLL), checked like ``agg_approx``."""
    li = Tables(spark, sf_dir).lineitem
    quartiles = agg.approx_quantiles_tree(li, "l_quantity", list(QUARTERS)).scalar()
    parts = agg.approx_distinct_tree(li, "l_partkey", lg_k=7).scalar()
    return _approx_report(li, parts, quartiles, 0.35, 0.03)


@register("ranked_purchases_range", covers=("W1", "W2", "W3", "W4", "W5"), oracle=_RANK_SQL)
def ranked_purchases_range(spark, sf_dir):
    """The ranked report with hot groups split by value range (for ordering columns with very
    many distinct values per group)."""
    return windows.ranked_report(_rank_input(spark, sf_dir), ["l_suppkey", "ship_date"], "l_quantity", _RANK_NAMES,
                                 method="range")
