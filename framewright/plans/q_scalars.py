"""Queries over numeric, string, date and null functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewright.functions import dates, numeric, strings
from framewright.operators import nulls
from framewright.plans.catalog import register
from framewright.sources.tables import Tables


@register("numeric_functions", covers=("N1", "N2", "N3"), oracle="""
SELECT p_partkey, pow(p_size, 2) AS size_squared, power(p_size, 3) AS size_cubed,
       round(p_size / 2.0::DOUBLE) AS half_up, round_even(p_size / 2.0::DOUBLE, 0) AS half_even,
       round(p_retailprice * 1.5, 0) AS price_rounded
FROM part
""")
def numeric_functions(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    half = F.col("p_size") / F.lit(2.0)
    return p.select("p_partkey", numeric.power(F.col("p_size"), 2).alias("size_squared"),
                    F.expr("POWER(p_size, 3)").alias("size_cubed"),
                    numeric.round_half_up(half).alias("half_up"),
                    numeric.round_half_even(half).alias("half_even"),
                    numeric.round_half_up(F.col("p_retailprice") * 1.5, 0).alias("price_rounded"))


@register("string_functions", covers=("T1", "T2", "T3", "T4", "T5", "T6", "T7", "T8", "T11", "C3", "C4"), oracle="""
SELECT p_partkey,
       array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')
         AS name_title,
       upper(p_name) AS name_upper, lower(upper(p_name)) AS name_lower,
       ltrim('  ' || p_type || '  ') AS type_ltrim, rtrim('  ' || p_type || '  ') AS type_rtrim,
       trim('  ' || p_type || '  ') AS type_trim,
       lpad(p_name, 3, ' ') AS name_cut, lpad(p_brand, 12, '*') AS brand_lpad, rpad(p_brand, 12, '*') AS brand_rpad,
       regexp_replace(p_name, 'red|blue', 'COLOR', 'g') AS name_colorless,
       translate(p_type, 'AE', '43') AS type_translated,
       regexp_extract(p_name, '(red|blue)', 1) AS color,
       string_split(p_name, ' ')[1] AS first_word, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n_words
FROM part
""")
def string_functions(spark, sf_dir):
    from framewright.operators.nested import array_size, element
    p = Tables(spark, sf_dir).part
    name, typ, brand = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    padded = F.concat(F.lit("  "), typ, F.lit("  "))
    lt, rt, bt = strings.trims(padded)
    words = strings.split_pattern(name, " ")
    return p.select(
        "p_partkey", strings.capitalise_words(name).alias("name_title"),
        strings.upper(name).alias("name_upper"), strings.lower(strings.upper(name)).alias("name_lower"),
        lt.alias("type_ltrim"), rt.alias("type_rtrim"), bt.alias("type_trim"),
        strings.pad_left(name, 3).alias("name_cut"), strings.pad_left(brand, 12, "*").alias("brand_lpad"),
        strings.pad_right(brand, 12, "*").alias("brand_rpad"),
        strings.replace_words(name, ["red", "blue"], "COLOR").alias("name_colorless"),
        strings.translate_chars(typ, "AE", "43").alias("type_translated"),
        strings.extract_first(name, ["red", "blue"]).alias("color"),
        element(words, 0).alias("first_word"), array_size(words).alias("n_words"))


@register("date_functions", covers=("D2", "D3", "D4", "D5", "D6", "D7", "D8", "D9", "D10"), oracle="""
SELECT o_orderkey, d AS order_day,
       CAST(d + INTERVAL 7 DAY AS DATE) AS plus_week,
       CAST(d - INTERVAL 30 DAY AS DATE) AS minus_30,
       CAST(datediff('day', d, CAST(d - INTERVAL 7 DAY AS DATE)) AS INTEGER) AS back_week,
       round((year(d) - year(s)) * 12 + (month(d) - month(s))
             + CASE WHEN day(d) = day(s) OR (d = last_day(d) AND s = last_day(s)) THEN 0
                    ELSE (day(d) - day(s)) / 31.0 END, 8) AS months_since_1996,
       CAST(strftime(d, '%Y-%m-%d') AS DATE) AS parsed_default,
       CAST(strptime(strftime(d, '%Y-%d-%m'), '%Y-%d-%m') AS DATE) AS parsed_pattern,
       TRY_CAST(strftime(d, '%Y-%d-%m') AS DATE) AS try_swapped,
       strptime(strftime(d, '%Y-%m-%d') || ' 10:30:00', '%Y-%m-%d %H:%M:%S') AS parsed_ts,
       d >= DATE '1996-01-01' AS after_1996, dayname(d) AS weekday
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, DATE '1996-01-01' AS s FROM orders)
""")
def date_functions(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    d = F.to_date("o_orderdate")
    text = F.date_format(d, "yyyy-MM-dd")
    swapped = F.date_format(d, "yyyy-dd-MM")
    return o.select(
        "o_orderkey", d.alias("order_day"), dates.add_days(d, 7).alias("plus_week"),
        dates.sub_days(d, 30).alias("minus_30"),
        dates.day_difference(dates.sub_days(d, 7), d).alias("back_week"),
        dates.months_between(d, dates.as_date("1996-01-01")).alias("months_since_1996"),
        dates.parse_date(text).alias("parsed_default"),
        dates.parse_date(swapped, "yyyy-dd-MM").alias("parsed_pattern"),
        dates.try_parse_date(swapped).alias("try_swapped"),
        dates.parse_timestamp(F.concat(text, F.lit(" 10:30:00")), "yyyy-MM-dd HH:mm:ss").alias("parsed_ts"),
        (d >= dates.as_date("1996-01-01")).alias("after_1996"),
        dates.weekday_name(d).alias("weekday"))


@register("epoch_nanos", covers=("D11", "R10"), oracle="""
SELECT event_id, ts, epoch_us(ts) * 1000 AS ts_nanos, make_timestamp(epoch_us(ts)) AS ts_back
FROM events
""")
def epoch_nanos(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("event_id", "ts")
    with_nanos = ev.withColumn("ts_nanos", dates.epoch_nanos(F.col("ts")))
    return with_nanos.withColumn("ts_back", dates.from_epoch_nanos(F.col("ts_nanos")))


_NULLY_SQL = """(SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS seg, nullif(c_nationkey, 0) AS nation,
        CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS bal FROM customer)"""


def _nully(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("seg"),
                    F.nullif(F.col("c_nationkey"), F.lit(0)).alias("nation"),
                    F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("bal"))


@register("null_functions", covers=("L1", "L2"), oracle="""
SELECT c_custkey, coalesce(a, b, 'none') AS first_seg, ifnull(a, b) AS ifnull_ab, nullif(a, b) AS nullif_ab,
       coalesce(a, b) AS nvl_ab, CASE WHEN a IS NOT NULL THEN b ELSE a END AS nvl2_ab
FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS a, nullif(c_mktsegment, 'HOUSEHOLD') AS b FROM customer)
""")
def null_functions(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    ab = c.select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("a"),
                  F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("b"))
    return ab.select("c_custkey", nulls.first_non_null("a", "b", F.lit("none")).alias("first_seg"),
                     *nulls.null_function_columns("a", "b"))


@register("nulls_drop_any", covers=("L3",), oracle=f"""
SELECT * FROM {_NULLY_SQL} WHERE seg IS NOT NULL AND nation IS NOT NULL AND bal IS NOT NULL
""")
def nulls_drop_any(spark, sf_dir):
    return nulls.drop_nulls(_nully(spark, sf_dir), "any")


@register("nulls_drop_all", covers=("L4",), oracle=f"""
SELECT * FROM {_NULLY_SQL} WHERE seg IS NOT NULL OR nation IS NOT NULL
""")
def nulls_drop_all(spark, sf_dir):
    return nulls.drop_nulls(_nully(spark, sf_dir), "all", ["seg", "nation"])


@register("nulls_fill_replace", covers=("L5", "L6", "L7", "L8"), oracle=f"""
SELECT c_custkey, CASE WHEN coalesce(seg, 'none') = 'MACHINERY' THEN 'MACH' ELSE coalesce(seg, 'none') END AS seg,
       coalesce(nation, 0) AS nation, coalesce(bal, -1.0) AS bal
FROM {_NULLY_SQL}
""")
def nulls_fill_replace(spark, sf_dir):
    df = nulls.fill_nulls_by_column(_nully(spark, sf_dir), {"bal": -1.0})   # L7
    df = nulls.fill_nulls(df, 0)                                            # L5: numeric columns only
    df = nulls.fill_nulls(df, "none", ["seg"])                              # L6
    return nulls.replace_values(df, "MACHINERY", "MACH", ["seg"])           # L8
