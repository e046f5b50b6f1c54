"""Queries over structs, arrays, maps, JSON, UDFs and the shared-variable replacements."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewright.functions import udfs
from framewright.operators import nested, shared
from framewright.plans.catalog import register
from framewright.sources.tables import Tables


@register("struct_fields", covers=("C1", "C2"), oracle="""
SELECT p_partkey, p_name AS name_from_path, p_brand AS brand_from_field, p_size AS size_from_tuple,
       p_name, p_brand
FROM part
""")
def struct_fields(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    s = p.select("p_partkey", nested.make_struct("p_name", "p_brand").alias("s"),
                 F.expr("(p_size, p_type)").alias("t"))
    return s.select("p_partkey", F.col("s.p_name").alias("name_from_path"),
                    nested.field("s", "p_brand").alias("brand_from_field"),
                    F.col("t.p_size").alias("size_from_tuple"), "s.*")


@register("array_functions", covers=("C3", "C4", "C5", "T11"), oracle="""
SELECT p_partkey, w[1] AS first_word, w[6] AS sixth_word, CAST(len(w) AS INTEGER) AS n_words,
       list_contains(w, 'red') AS has_red
FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)
""")
def array_functions(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    w = F.split(F.col("p_name"), " ")
    return p.select("p_partkey", nested.element(w, 0).alias("first_word"), nested.element(w, 5).alias("sixth_word"),
                    nested.array_size(w).alias("n_words"), nested.has_element(w, "red").alias("has_red"))


@register("explode_words", covers=("C6", "T11"), oracle="""
SELECT p_partkey, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS word
FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)
""")
def explode_words(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", F.split("p_name", " ").alias("w"))
    return nested.explode_array(p, "w", "word", position="pos")


@register("map_lookup", covers=("C7", "C8"), oracle="""
SELECT p_partkey, CASE WHEN p_brand = 'Brand#2' THEN p_size END AS brand2_size,
       CASE WHEN p_brand = 'Brand#3' THEN p_size END AS brand3_size
FROM part WHERE p_brand IS NOT NULL
""")
def map_lookup(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    m = nested.map_from_columns(p, "p_brand", "p_size", "m")
    return m.select("p_partkey", nested.map_lookup("m", "Brand#2").alias("brand2_size"),
                    F.expr("m['Brand#3']").alias("brand3_size"))


@register("map_explode", covers=("C7", "C9"), oracle="""
SELECT p_partkey, p_brand AS key, p_size AS value FROM part WHERE p_brand IS NOT NULL
""")
def map_explode(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    m = nested.map_from_columns(p, "p_brand", "p_size", "m").select("p_partkey", "m")
    return nested.explode_map(m, "m")


@register("json_functions", covers=("C10", "C11", "C12", "C13"), oracle="""
SELECT event_id, json_extract_string(props, '$.k') AS k_text, json_extract_string(props, '$.k') AS k,
       CAST(CASE WHEN event_type IS NULL AND user_id IS NULL THEN '{}'           -- null fields are omitted
                 WHEN user_id IS NULL THEN to_json({'event_type': event_type})
                 WHEN event_type IS NULL THEN to_json({'user_id': user_id})
                 ELSE to_json({'event_type': event_type, 'user_id': user_id}) END AS VARCHAR) AS as_json,
       CAST(event_id AS VARCHAR) AS second_id,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k_int
FROM events
""")
def json_functions(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    with_ids = ev.withColumn("ids_json", nested.to_json_text(F.array("user_id", "event_id").alias("ids")))
    out = nested.json_fields(with_ids, "props", ["k"], keep=["event_id", "props", "event_type", "user_id", "ids_json"])
    return out.select(
        "event_id", nested.json_path("props", "$.k").alias("k_text"), "k",
        nested.to_json_text("event_type", "user_id").alias("as_json"),
        nested.json_path("ids_json", "$.ids[1]").alias("second_id"),
        nested.parse_json("props", "k INT").getField("k").alias("k_int"))


@register("udf_cube", covers=("X1",), oracle="""
SELECT event_id, user_id, user_id * user_id * user_id AS user_cubed FROM events
""")
def udf_cube(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return ev.select("event_id", "user_id", udfs.cube_long("user_id").alias("user_cubed"))


@register("udf_cube_sql", covers=("X2",), oracle="""
SELECT event_id, user_id * user_id * user_id AS user_cubed FROM events
""")
def udf_cube_sql(spark, sf_dir):
    name = udfs.register_cube(spark)
    return spark.sql(f"SELECT event_id, {name}(user_id) AS user_cubed FROM {{events}}",
                     events=Tables(spark, sf_dir).events)


# Points per colour of a part's name; words that are no listed colour take the default.
COLOUR_POINTS = {"blue": 3, "green": 5, "red": 8}


@register("lookup_with_default", covers=("X3", "O1"), oracle="""
SELECT p_partkey, word, CAST(CASE word WHEN 'blue' THEN 3 WHEN 'green' THEN 5 WHEN 'red' THEN 8 ELSE 1 END AS BIGINT) AS points
FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)
ORDER BY points, word, p_partkey
""")
def lookup_with_default(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    words = p.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))
    looked = shared.lookup_with_default(spark, words, "word", COLOUR_POINTS, default=1, value_name="points")
    return looked.orderBy("points", "word", "p_partkey")


@register("two_sided_total", covers=("X4",), oracle="""
WITH t AS (
  SELECT s.s_nationkey AS origin, c.c_nationkey AS dest, l.l_quantity AS q
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey)
SELECT entity AS nation, sum(q) AS total
FROM (SELECT origin AS entity, q FROM t UNION ALL SELECT dest AS entity, q FROM t)
GROUP BY entity
""")
def two_sided_total(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_suppkey", "l_quantity")
    # Join order chosen so the fact-sized rows are shuffled twice (by supplier, then by order):
    # orders meet customers first, at a quarter of the fact table's size.
    origin = li.join(t.supplier.select("s_suppkey", F.col("s_nationkey").alias("origin")),
                     li["l_suppkey"] == F.col("s_suppkey"))
    o = t.orders.select("o_orderkey", "o_custkey")
    dest = o.join(t.customer.select("c_custkey", F.col("c_nationkey").alias("dest")),
                  o["o_custkey"] == F.col("c_custkey")).select("o_orderkey", "dest")
    flows = origin.join(dest, origin["l_orderkey"] == dest["o_orderkey"])
    return shared.two_sided_total(flows, "origin", "dest", "l_quantity", entity="nation")
