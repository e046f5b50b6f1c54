"""Queries over scans, projections, filters, joins, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewright.operators import joins, ordering
from framewright.plans.catalog import register
from framewright.sources.tables import Tables


@register("top5_suppliers_by_quantity", covers=("S5", "J1", "A8", "O2", "O6"), oracle="""
SELECT s.s_suppkey, s.s_name, sum(l.l_quantity) AS total_quantity
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
GROUP BY s.s_suppkey, s.s_name
ORDER BY total_quantity DESC, s.s_suppkey
LIMIT 5
""")
def top5_suppliers_by_quantity(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # Aggregate lineitem first (partial aggregation before the shuffle), then join the
    # one-row-per-supplier result to supplier, then a top-k.
    per_supplier = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("total_quantity"))
    joined = joins.join(per_supplier, t.supplier, [("l_suppkey", "s_suppkey")])
    return ordering.top_k(joined.select("s_suppkey", "s_name", "total_quantity"), 5,
                          F.desc("total_quantity"), F.asc("s_suppkey"))


@register("top5_suppliers_sql", covers=("S10", "S11", "O3", "A8"), oracle="""
SELECT l_suppkey, sum(l_quantity) AS total_quantity
FROM lineitem GROUP BY l_suppkey
ORDER BY sum(l_quantity) DESC, l_suppkey
LIMIT 5
""")
def top5_suppliers_sql(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return spark.sql("""
        SELECT l_suppkey, sum(l_quantity) AS total_quantity
        FROM {lineitem} GROUP BY l_suppkey
        ORDER BY sum(l_quantity) DESC, l_suppkey
        LIMIT 5""", lineitem=t.lineitem)


COUNT_BY_KEY_SQL = """
SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY o_orderpriority
"""


@register("count_by_key_df", covers=("A3",), oracle=COUNT_BY_KEY_SQL)
def count_by_key_df(spark, sf_dir):
    return Tables(spark, sf_dir).orders.groupBy("o_orderpriority").count()


@register("count_by_key_sql", covers=("A3", "S10", "S11"), oracle=COUNT_BY_KEY_SQL)
def count_by_key_sql(spark, sf_dir):
    # Names resolve without regard to case: the GROUP BY spells the column differently.
    return spark.sql("SELECT o_orderpriority, count(1) AS count FROM {orders} GROUP BY O_ORDERPRIORITY",
                     orders=Tables(spark, sf_dir).orders)


@register("global_max", covers=("A7",), oracle="""
SELECT max(l_quantity) AS max_quantity, min(l_quantity) AS min_quantity,
       max(l_shipdate) AS last_ship, min(l_shipdate) AS first_ship
FROM lineitem
""")
def global_max(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return li.agg(F.max("l_quantity").alias("max_quantity"), F.min("l_quantity").alias("min_quantity"),
                  F.max("l_shipdate").alias("last_ship"), F.min("l_shipdate").alias("first_ship"))


@register("even_keys", covers=("F5", "A1"), oracle="""
SELECT o_orderkey % 2 = 0 AS is_even, count(*) AS n FROM orders GROUP BY 1
""")
def even_keys(spark, sf_dir):
    from framewright.operators.filters import is_even
    orders = Tables(spark, sf_dir).orders
    return orders.groupBy(is_even("o_orderkey").alias("is_even")).agg(F.count(F.lit(1)).alias("n"))


@register("range_arithmetic", covers=("S6", "P5"), oracle="""
SELECT range AS number, range * 2 + 1 AS odd_number, range * range AS square, range - 10 AS shifted
FROM range((SELECT count(*) FROM orders))
""")
def range_arithmetic(spark, sf_dir):
    from framewright.sources.local import number_range
    n = Tables(spark, sf_dir).orders.count()          # one scalar to the driver
    num = number_range(spark, n)                      # generated in parallel partitions
    x = F.col("number")
    return num.select(x, (x * 2 + 1).alias("odd_number"), (x * x).alias("square"), (x - 10).alias("shifted"))


@register("projection_forms", covers=("P1", "P2", "P3", "P4", "P6", "P7", "P8", "P14", "P16"), oracle="""
SELECT c_mktsegment = 'BUILDING' AS is_building, c_mktsegment = 'MACHINERY' AS is_machinery,
       c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       c_name AS name_copy, c_custkey AS key_copy, c_nationkey AS nation, c_acctbal AS balance,
       c_mktsegment AS name_twice, c_acctbal > 5000 AS rich,
       1 AS one, 'x' AS label, 2.5::DOUBLE AS half, c_acctbal * 2 AS balance_x2
FROM customer
""")
def projection_forms(spark, sf_dir):
    from framewright.operators.project import col_forms, flag_columns
    c = Tables(spark, sf_dir).customer
    key, nation, balance = col_forms("c_custkey")[0], col_forms("c_nationkey")[1], col_forms("c_acctbal")[2]
    flags = [(F.col("c_mktsegment") == s).alias(f"is_{s.lower()}") for s in ("BUILDING", "MACHINERY")]
    df = c.select(*flags, *c.columns)                                      # P14 + P16
    df = df.select("*", F.col("c_name").alias("name_copy"), key.alias("key_copy"),
                   nation.alias("nation"), balance.alias("balance"),
                   F.expr("c_mktsegment AS segment").alias("name_twice"))  # alias of alias
    df = df.selectExpr("*", "c_acctbal > 5000 AS rich")                    # comparison as value
    return df.select("*", F.lit(1).alias("one"), F.lit("x").alias("label"), F.lit(2.5).alias("half")) \
             .withColumn("balance_x2", F.col("c_acctbal") * 2)


@register("rename_drop_cast_backquote", covers=("P9", "P10", "P11", "P13"), oracle="""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       c_name AS "customer name", c_mktsegment AS "market-segment", c_mktsegment AS "segment-copy"
FROM customer
""")
def rename_drop_cast_backquote(spark, sf_dir):
    from framewright.operators.project import cast_columns, drop_columns, quoted, rename
    c = Tables(spark, sf_dir).customer
    df = rename(c, {"c_name": "customer name", "c_mktsegment": "market-segment"})
    df = df.selectExpr("*", f"{quoted('market-segment')} AS {quoted('segment-copy')}")
    df = drop_columns(df, "c_acctbal")
    return cast_columns(df, {"c_custkey": "string", "c_nationkey": "long"})


@register("boolean_flags", covers=("F1", "F2", "F6", "F7", "F8", "F9", "F10", "F11", "T9", "T10"), oracle="""
SELECT * FROM (
  SELECT strpos(p_name, 'red') > 0 AS is_red, strpos(p_name, 'blue') > 0 AS is_blue,
         strpos(p_name, 'hot') > 0 AS is_hot, p_partkey, p_name, p_type, p_size,
         CAST(instr(p_name, 'widget') AS INTEGER) AS widget_pos
  FROM part)
WHERE (p_type IN ('SMALL', 'PROMO') OR instr(p_name, 'widget') >= 1)
  AND NOT p_size <= 10
  AND (is_red OR is_blue OR is_hot)
""")
def boolean_flags(spark, sf_dir):
    from framewright.operators.filters import any_of, contains_text, member_of, where
    from framewright.operators.project import flag_columns
    p = Tables(spark, sf_dir).part.select("p_partkey", "p_name", "p_type", "p_size")
    df = flag_columns(p, "p_name", ["red", "blue", "hot"])
    df = df.withColumn("widget_pos", F.instr("p_name", "widget"))
    return where(df,
                 any_of(member_of("p_type", ["SMALL", "PROMO"]), contains_text("p_name", "widget")),
                 "NOT p_size <= 10",
                 F.expr("is_red OR is_blue OR is_hot"))


@register("like_not_null", covers=("F12", "F13", "P1"), oracle="""
SELECT event_id, user_id, event_type FROM events
WHERE event_type LIKE '%i%' AND props IS NOT NULL
""")
def like_not_null(spark, sf_dir):
    from framewright.operators.filters import like_not_null as op
    ev = Tables(spark, sf_dir).events
    return op(ev, "event_type", "%i%", ["props"]).select("event_id", "user_id", "event_type")


# The joins read whole tables with natural gaps: most documents have no label, most customers no event.
def _documents_labels(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = t.documents.select("doc_id", "source", "lang")
    return d, t.labels.select(F.col("doc_id").alias("label_id"), "quality")


def _customers_events(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t.customer.select("c_custkey", "c_name", "c_acctbal")
    return c, t.events.select("event_id", "user_id", "event_type")


@register("join_inner", covers=("J1",), oracle="""
SELECT d.doc_id, d.source, d.lang, l.doc_id AS label_id, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id
""")
def join_inner(spark, sf_dir):
    return joins.join(*_documents_labels(spark, sf_dir), [("doc_id", "label_id")], "inner")


@register("join_left", covers=("J3",), oracle="""
SELECT d.doc_id, d.source, d.lang, l.doc_id AS label_id, l.quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def join_left(spark, sf_dir):
    return joins.outer_join(*_documents_labels(spark, sf_dir), [("doc_id", "label_id")], "left")


@register("join_right", covers=("J4",), oracle="""
SELECT e.event_id, e.user_id, e.event_type, c.c_custkey, c.c_name, c.c_acctbal
FROM events e RIGHT JOIN customer c ON e.user_id = c.c_custkey
""")
def join_right(spark, sf_dir):
    c, e = _customers_events(spark, sf_dir)
    return joins.outer_join(e, c, [("user_id", "c_custkey")], "right")


@register("join_full", covers=("J2",), oracle="""
SELECT c.c_custkey, c.c_name, c.c_acctbal, e.event_id, e.user_id, e.event_type
FROM customer c FULL JOIN events e ON c.c_custkey = e.user_id
""")
def join_full(spark, sf_dir):
    return joins.outer_join(*_customers_events(spark, sf_dir), [("c_custkey", "user_id")], "full")


@register("join_semi", covers=("J5",), oracle="""
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey IN (SELECT user_id FROM events)
""")
def join_semi(spark, sf_dir):
    return joins.semi_join(*_customers_events(spark, sf_dir), [("c_custkey", "user_id")])


@register("join_semi_duplicates", covers=("J6", "U1"), oracle="""
SELECT * FROM (
  SELECT c_custkey, c_name, c_acctbal FROM customer
  UNION ALL
  SELECT c_custkey, c_name, c_acctbal FROM customer) u
WHERE c_custkey IN (SELECT user_id FROM events)
""")
def join_semi_duplicates(spark, sf_dir):
    from framewright.operators.setops import union_all
    c, e = _customers_events(spark, sf_dir)
    return joins.semi_join(union_all(c, c, by_name=False), e, [("c_custkey", "user_id")])


@register("join_anti", covers=("J7",), oracle="""
SELECT doc_id, source, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def join_anti(spark, sf_dir):
    return joins.anti_join(*_documents_labels(spark, sf_dir), [("doc_id", "label_id")])


@register("join_cross", covers=("J9",), oracle="""
SELECT c_custkey, c_name, r_regionkey, r_name FROM customer CROSS JOIN region
""")
def join_cross(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return joins.cross_product(t.customer.select("c_custkey", "c_name"), t.region)


@register("join_cross_condition", covers=("J8",), oracle="""
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, n_nationkey, n_name, n_regionkey
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def join_cross_condition(spark, sf_dir):
    t = Tables(spark, sf_dir)
    s, n = t.supplier, t.nation
    # Type "cross" with a condition is planned as an inner join.
    return s.join(n, s["s_nationkey"] == n["n_nationkey"], "cross")


@register("join_array_member", covers=("J10", "C5", "C6", "A17"), oracle="""
SELECT DISTINCT l.l_orderkey, n.n_nationkey, n.n_name
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON n.n_nationkey = s.s_nationkey
""")
def join_array_member(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_suppkey")
    with_nation = li.join(t.supplier.select("s_suppkey", "s_nationkey"), li["l_suppkey"] == F.col("s_suppkey"))
    # Per order, the set of supplier nations: bounded by the number of nations, merged map-side.
    per_order = with_nation.groupBy("l_orderkey").agg(F.collect_set("s_nationkey").alias("nations"))
    out = joins.array_member_join(per_order, "nations", t.nation, "n_nationkey")
    return out.select("l_orderkey", "n_nationkey", "n_name")


@register("join_keep_both_keys", covers=("J11",), oracle="""
SELECT s.s_suppkey, s.s_nationkey AS left_key, n.n_nationkey AS right_key, n.n_name
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
""")
def join_keep_both_keys(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = joins.join_keep_both_keys(t.supplier, t.nation, "s_nationkey", "n_nationkey")
    return j.select(F.col("l.s_suppkey"), F.col("l.s_nationkey").alias("left_key"),
                    F.col("r.n_nationkey").alias("right_key"), F.col("r.n_name"))


@register("join_drop_key", covers=("J13", "P12"), oracle="""
SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_name, n.n_regionkey
FROM customer c JOIN (SELECT n_nationkey AS c_nationkey, n_name, n_regionkey FROM nation) n
  ON c.c_nationkey = n.c_nationkey
""")
def join_drop_key(spark, sf_dir):
    t = Tables(spark, sf_dir)
    n = t.nation.withColumnRenamed("n_nationkey", "c_nationkey")
    return joins.join_drop_right_key(t.customer, n, "c_nationkey")


@register("join_rename_key", covers=("J12", "J14"), oracle="""
SELECT s.s_nationkey, s.s_suppkey, s.s_name, s.s_acctbal, n.n_name, n.n_regionkey
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
""")
def join_rename_key(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return joins.join_renamed(t.supplier, t.nation, "s_nationkey", "n_nationkey")


@register("union_filter", covers=("U1", "F1"), oracle="""
SELECT * FROM (
  SELECT c_custkey AS party_key, c_name AS party_name, c_nationkey AS nation, c_acctbal AS balance FROM customer
  UNION ALL
  SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
) WHERE balance > 0
""")
def union_filter(spark, sf_dir):
    from framewright.operators.setops import union_all
    t = Tables(spark, sf_dir)
    c = t.customer.select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name"),
                          F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    # By position: the supplier columns take the customer side's names.
    return union_all(c, s, by_name=False).where("balance > 0")


@register("sorted_limits", covers=("O1", "O2", "O4", "O5", "O6"), oracle="""
SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber
LIMIT 10
""")
def sorted_limits(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    return ordering.top_k(li, 10, F.col("l_extendedprice").desc(), "l_orderkey", F.asc("l_linenumber"))


@register("repartition_by_key", covers=("O4", "O9", "O10"), oracle="""
SELECT l_suppkey, l_shipdate, l_quantity FROM lineitem
""")
def repartition_by_key(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.select("l_suppkey", "l_shipdate", "l_quantity")
    # Partition counts follow the session's shuffle width, never a constant: the same code then
    # sizes itself on a laptop and on a cluster.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    clustered = ordering.repartition(li, n, "l_suppkey")
    return ordering.coalesce(ordering.sort_within_partitions(clustered, "l_suppkey", "l_shipdate"), max(1, n // 2))


@register("distinct_pairs", covers=("A31",), oracle="""
SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders
""")
def distinct_pairs(spark, sf_dir):
    from framewright.operators.aggregate import distinct_rows
    return distinct_rows(Tables(spark, sf_dir).orders, "o_orderstatus", "o_orderpriority")


@register("sample_split", covers=("O7", "O8"), oracle="""
SELECT count(*) AS n_rows, count(*) AS n_split, 0::BIGINT AS n_in_both, true AS sample_of_table,
       true AS sample_size_close, true AS split_size_close
FROM lineitem
""")
def sample_split(spark, sf_dir):
    """What must hold of a seeded sample and split whatever the partitioning: the split's parts are
    disjoint and make the table, the sample is of the table's rows, and the sizes are within six
    standard deviations of the shares asked for."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber")
    a, b = ordering.random_split(li, [0.25, 0.75], seed=7)
    sampled = ordering.sample(li, 0.1, seed=7)
    tagged = (li.withColumn("part", F.lit("all")).unionByName(a.withColumn("part", F.lit("a")))
              .unionByName(b.withColumn("part", F.lit("b"))).unionByName(sampled.withColumn("part", F.lit("s"))))
    count = lambda p: F.count(F.when(F.col("part") == p, 1))
    rows = tagged.groupBy("l_orderkey", "l_linenumber").agg(*[count(p).alias(p) for p in ("all", "a", "b", "s")])
    sums = rows.agg(F.sum("all").alias("n_rows"), F.sum(F.col("a") + F.col("b")).alias("n_split"),
                    F.count(F.when((F.col("a") > 0) & (F.col("b") > 0) & (F.col("all") == 1), 1)).alias("n_in_both"),
                    F.min(F.col("s") <= F.col("all")).alias("sample_of_table"), F.sum("s").alias("n_s"), F.sum("a").alias("n_a"))
    close = lambda c, p: F.abs(F.col(c) - p * F.col("n_rows")) <= 6 * F.sqrt(p * (1 - p) * F.col("n_rows")) + 1
    return sums.select("n_rows", "n_split", "n_in_both", "sample_of_table", close("n_s", 0.1).alias("sample_size_close"),
                       close("n_a", 0.25).alias("split_size_close"))


@register("row_ids", covers=("P17",), oracle="""
SELECT count(*) AS n_rows, count(*) AS n_ids, true AS ids_grow_by_row FROM lineitem
""")
def row_ids(spark, sf_dir):
    """Generated row ids are distinct; within a partition they count up from its first one."""
    from framewright.operators.project import unique_row_id
    li = unique_row_id(Tables(spark, sf_dir).lineitem.select("l_orderkey"), "row_id")
    per = (li.select("row_id", F.shiftright("row_id", 33).alias("partition"))
           .groupBy("partition").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_id").alias("d"),
                                     (F.max("row_id") - F.min("row_id") + 1 == F.count(F.lit(1))).alias("gapless")))
    return per.agg(F.sum("n").alias("n_rows"), F.sum("d").alias("n_ids"), F.min("gapless").alias("ids_grow_by_row"))


@register("orders_until_today", covers=("D1",), oracle="""
SELECT o_orderkey, CAST(o_orderdate AS DATE) <= current_date AS ordered_by_today FROM orders
""")
def orders_until_today(spark, sf_dir):
    from framewright.functions import dates
    today = dates.today_and_now()[0]
    return Tables(spark, sf_dir).orders.select("o_orderkey", (F.to_date("o_orderdate") <= today).alias("ordered_by_today"))


@register("view_by_name", covers=("S10", "S11"), oracle="""
SELECT o_orderpriority, count(*) AS n, max(o_orderkey) AS last_order FROM orders GROUP BY o_orderpriority
""")
def view_by_name(spark, sf_dir):
    """SQL text over a registered view."""
    import uuid

    from framewright.sources import files
    name = f"orders_{uuid.uuid4().hex[:12]}"
    files.register_view(Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderpriority"), name)
    return spark.sql(f"SELECT o_orderpriority, count(*) AS n, max(o_orderkey) AS last_order FROM {name} GROUP BY o_orderpriority")


@register("join_lines_orders", covers=("J1",), oracle="""
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, o.o_custkey, o.o_orderdate
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def join_lines_orders(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return joins.join(li, o, [("l_orderkey", "o_orderkey")]).drop("o_orderkey")


@register("semi_orders_with_lines", covers=("J5",), oracle="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
""")
def semi_orders_with_lines(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return joins.semi_join(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), t.lineitem,
                           [("o_orderkey", "l_orderkey")])


@register("comparison_flags", covers=("F3", "F4", "D9", "P6"), oracle="""
SELECT o_orderkey, o_orderstatus = 'F' AS is_finished, o_orderstatus <> 'O' AS not_open,
       o_orderstatus != 'P' AS not_pending, o_totalprice < 100000 AS small, o_totalprice > 300000 AS large,
       o_totalprice >= 200000 AS at_least_200k, CAST(o_orderdate AS DATE) >= DATE '1998-01-01' AS recent
FROM orders
""")
def comparison_flags(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    price = F.col("o_totalprice")
    return o.select("o_orderkey", (F.col("o_orderstatus") == "F").alias("is_finished"),
                    F.expr("o_orderstatus <> 'O'").alias("not_open"), F.expr("o_orderstatus != 'P'").alias("not_pending"),
                    (price < 100000).alias("small"), (price > 300000).alias("large"),
                    (price >= 200000).alias("at_least_200k"),
                    (F.to_date("o_orderdate") >= F.to_date(F.lit("1998-01-01"))).alias("recent"))
