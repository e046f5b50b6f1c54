"""A small hand-written retail table with dirty text and nulls; expectations written by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from framewright.functions import dates, strings
from framewright.operators import aggregate as agg
from framewright.operators import filters, nulls, project, windows

ROWS = [
    # invoice, stock code, description, quantity, invoice date text, unit price, customer, country
    ("536365", "85123A", "WHITE HANGING HEART", 6, "12/1/2010 8:26", 2.55, 17850, "United Kingdom"),
    ("536365", "71053", "WHITE METAL LANTERN", 6, "12/1/2010 8:26", 3.39, 17850, "United Kingdom"),
    ("536366", "22633", "RED HAND WARMER", 6, "12/1/2010 8:28", 1.85, 17850, "United Kingdom"),
    ("536367", "84879", "ASSORTED COLOUR BIRD", 32, "12/1/2010 8:34", 1.69, 13047, "United Kingdom"),
    ("536367", "DOT", "DOTCOM POSTAGE", 1, "12/1/2010 8:34", 569.77, None, "United Kingdom"),
    ("C536379", "D", "Discount", -1, "12/1/2010 9:41", 27.50, 14527, "United Kingdom"),
    ("536380", "POST", "POSTAGE", 3, "12/1/2010 9:45", 18.00, 12583, "France"),
    ("536381", "22139", None, 0, "12/1/2010 9:45", 0.0, None, "France"),
    ("536382", "22140", "", 12, "1/4/2011 10:00", 2.10, 12583, "France"),
    ("536383", "22141", "blue red GREEN", 4, "1/4/2011 10:00", 4.25, 13047, "Germany"),
    ("536384", "22142", "white", 8, "1/4/2011 11:00", 0.85, 13047, "Germany"),
    ("536385", "22143", "RED", 8, "1/4/2011 11:00", 0.85, None, "Germany"),
]
SCHEMA = ("InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate string, "
          "UnitPrice double, CustomerID int, Country string")


@pytest.fixture(scope="module")
def retail(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_text_comparison_and_flags(retail):
    # Q6: invoices compared as text, never cast to numbers (C536379 is not a number).
    assert retail.where(F.col("InvoiceNo") != "536365").count() == 10
    assert project.cast_columns(retail, {"InvoiceNo": "int"}, safe=True).where("InvoiceNo IS NULL").count() == 1
    dot = retail.where(filters.member_of("StockCode", ["DOT"]) | filters.contains_text("Description", "POSTAGE"))
    assert sorted(r.StockCode for r in dot.collect()) == ["DOT", "POST"]
    flagged = project.flag_columns(retail.select("Description"), "Description", ["RED", "WHITE"])
    red_or_white = flagged.where(filters.any_of(F.col("is_RED"), F.col("is_WHITE")))
    assert red_or_white.count() == 4      # case-sensitive: "blue red GREEN" and "white" do not count


def test_string_cleanup(retail):
    out = retail.select(strings.replace_words(F.col("Description"), ["RED", "WHITE"], "COLOR").alias("d"),
                        strings.extract_first(F.col("Description"), ["RED", "WHITE"]).alias("c")).collect()
    assert out[0].d == "COLOR HANGING HEART" and out[0].c == "WHITE"
    assert out[7].d is None and out[8].c == ""


def test_dates_parse_with_one_digit_month(retail):
    d = retail.select(dates.parse_date(F.col("InvoiceDate"), "M/d/yyyy H:mm").alias("d")).collect()
    assert {r.d for r in d} == {dt.date(2010, 12, 1), dt.date(2011, 1, 4)}


def test_nulls(retail):
    assert nulls.drop_nulls(retail, "any").count() == 9            # three rows hold a null
    assert nulls.drop_nulls(retail, "all", ["Description", "CustomerID"]).count() == 11   # row 8: both null
    filled = nulls.fill_nulls(retail, 0).where("CustomerID = 0").count()
    assert filled == 3
    assert nulls.fill_nulls(retail, "none").where("Description = 'none'").count() == 1


def test_aggregates(retail):
    r = retail.agg(F.count("CustomerID").alias("n_cust"), F.count(F.lit(1)).alias("n"),
                   F.sum_distinct("Quantity").alias("sd"), F.count_distinct("StockCode").alias("codes")).first()
    assert (r.n_cust, r.n, r.sd, r.codes) == (9, 12, 6 + 32 + 1 - 1 + 3 + 0 + 12 + 4 + 8, 12)
    first_last = retail.groupBy("Country").agg(*agg.first_last_by("InvoiceNo", "InvoiceNo", "inv"))
    assert {x.Country: (x.inv_first, x.inv_last) for x in first_last.collect()}["France"] == ("536380", "536382")
    sets = retail.groupBy("Country").agg(F.array_join(agg.sorted_set("StockCode"), ",").alias("s"))
    assert {x.Country: x.s for x in sets.collect()}["Germany"] == "22141,22142,22143"


def test_ranked_purchases_on_retail(retail):
    d = retail.where(F.col("CustomerID").isNotNull()).select(
        "CustomerID", dates.parse_date(F.col("InvoiceDate"), "M/d/yyyy H:mm").alias("day"), "Quantity", "StockCode")
    direct = windows.ranked_report_window(d, ["CustomerID", "day"], "Quantity")
    fast = windows.ranked_report(d, ["CustomerID", "day"], "Quantity")
    rows = sorted(map(tuple, fast.collect()), key=repr)
    assert rows == sorted(map(tuple, direct.collect()), key=repr)
    mine = {(r.CustomerID, r.StockCode): (r.max_value, r.dense_rank, r.rank) for r in fast.collect()}
    assert mine[(17850, "85123A")] == (6, 1, 1) and mine[(17850, "22633")] == (6, 1, 1)
    assert mine[(13047, "22141")] == (8, 2, 2) and mine[(13047, "22142")] == (8, 1, 1)
