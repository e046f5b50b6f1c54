"""Scalar, null, nested and UDF behaviour with hand-written expectations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from framewright.functions import dates, numeric, strings, udfs
from framewright.operators import nested, nulls, project


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_rounding(spark):
    r = one(spark, numeric.round_half_up(F.lit(2.5)).alias("a"), numeric.round_half_even(F.lit(2.5)).alias("b"),
            numeric.power(F.lit(3), 3).alias("c"))
    assert (r.a, r.b, r.c) == (3.0, 2.0, 27.0)


def test_strings(spark):
    c = F.lit("  tidal mark ")
    r = one(spark, strings.capitalise_words(F.lit("north sEA")).alias("t"), strings.pad_left(F.lit("HARBOUR"), 4).alias("p"),
            strings.pad_right(F.lit("ab"), 4, "*").alias("rp"), *[x.alias(f"t{i}") for i, x in enumerate(strings.trims(c))],
            strings.extract_first(F.lit("nothing here"), ["red"]).alias("e"),
            strings.replace_words(F.lit("red and blue"), ["red", "blue"], "C").alias("r"),
            strings.translate_chars(F.lit("ROPE"), "OE", "05").alias("tr"),
            strings.position(F.lit("abc"), "c").alias("pos"), strings.contains_flag(F.lit("abc"), "z").alias("f"))
    assert r.t == "North Sea" and r.p == "HARB" and r.rp == "ab**"
    assert (r.t0, r.t1, r.t2) == ("tidal mark ", "  tidal mark", "tidal mark")
    assert r.e == "" and r.r == "C and C" and r.tr == "R0P5" and r.pos == 3 and r.f is False


def test_dates(spark):
    d1, d2 = F.to_date(F.lit("1999-03-15")), F.to_date(F.lit("2000-02-29"))
    r = one(spark, dates.day_difference(dates.sub_days(d1, 30), d1).alias("dd"),
            dates.months_between(d1, d2).alias("mb"),
            dates.try_parse_date(F.lit("1999-31-04")).alias("bad"),
            dates.try_parse_date(F.lit("1999-31-08"), "yyyy-dd-MM").alias("try_pat"),
            dates.try_parse_date(F.lit("1999-31-06"), "yyyy-dd-MM").alias("try_bad"),
            dates.parse_date(F.lit("1999-31-08"), "yyyy-dd-MM").alias("pat"),
            dates.parse_date(F.lit("7.9.2003 6h30"), "d.M.yyyy H'h'mm").alias("short"),
            dates.weekday_name(d1).alias("wd"))
    assert r.dd == -30 and r.mb == pytest.approx(-11.4516129) and r.bad is None
    assert r.try_pat == dt.date(1999, 8, 31) and r.try_bad is None
    assert r.pat == dt.date(1999, 8, 31) and r.short == dt.date(2003, 9, 7) and r.wd == "Monday"


def test_epoch_nanos_round_trip(spark):
    ts = F.lit("2024-01-04 06:21:33.298960").cast("timestamp_ntz")
    r = one(spark, dates.epoch_nanos(ts).alias("n"), dates.from_epoch_nanos(dates.epoch_nanos(ts)).alias("back"),
            dates.from_epoch_nanos(F.lit(1704349293298960999)).alias("trunc"))
    assert r.n == 1704349293298960000 and r.back == dt.datetime(2024, 1, 4, 6, 21, 33, 298960)
    assert r.trunc == r.back


def test_null_functions_and_fill_by_type(spark):
    df = spark.createDataFrame([(None, None, 1.5), ("x", 3, None)], "s string, i int, d double")
    r = df.select(nulls.first_non_null("s", F.lit("z")).alias("c"), *nulls.null_function_columns("s", "s")).first()
    assert r.c == "z" and r.nullif_ab is None
    filled = nulls.fill_nulls(df, "none").collect()      # only the string column changes
    assert filled[0].s == "none" and filled[0].i is None
    assert nulls.drop_nulls(df, "any").count() == 0
    assert nulls.drop_nulls(df, "all", ["s", "i"]).count() == 1
    rep = nulls.replace_values(df, "x", "y", ["s"]).collect()
    assert rep[1].s == "y"


def test_nested(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    m = nested.map_from_columns(df, "k", "v")
    assert m.count() == 1
    r = m.select(nested.map_lookup("m", "a").alias("hit"), nested.map_lookup("m", "zz").alias("miss")).first()
    assert (r.hit, r.miss) == (1, None)
    arr = one(spark, F.array(F.lit(1), F.lit(2)).alias("a"))
    assert arr.a == [1, 2]
    r = one(spark, nested.element(F.array(F.lit(1)), 5).alias("e"),
            nested.to_json_text(F.lit(None).cast("string").alias("n"), F.lit(1).alias("x")).alias("j"),
            nested.json_path(F.lit('{"a": {"b": [10, 20]}}'), "$.a.b[1]").alias("p"))
    assert r.e is None and r.j == '{"x":1}' and r.p == "20"
    ex = nested.explode_array(spark.createDataFrame([(1, [1, 2]), (2, None)], "id int, a array<int>"), "a", "x")
    assert ex.count() == 2


def test_udf_equals_native_and_registers(spark):
    df = spark.range(5).toDF("num")
    got = df.select(udfs.cube_long("num").alias("c"), F.pow("num", 3).cast("long").alias("n")).collect()
    assert all(r.c == r.n for r in got)
    name = udfs.register_cube(spark, "fw_cube_test")
    assert spark.sql(f"SELECT {name}(3L) AS c").first().c == 27


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, "red hot")], "id long, name string")
    f = project.flag_columns(df, "name", ["red", "blue"])
    assert f.columns[:2] == ["is_red", "is_blue"] and f.first().is_red is True
    r = project.rename(df, {"name": "my name"}).selectExpr(project.quoted("my name")).first()
    assert r[0] == "red hot"
    ids = project.unique_row_id(spark.range(1000).repartition(4))
    assert ids.select("row_id").distinct().count() == 1000
    c = project.cast_columns(spark.createDataFrame([("C536379",), ("17",)], "inv string"), {"inv": "int"}, safe=True)
    assert [r.inv for r in c.collect()] == [None, 17]
