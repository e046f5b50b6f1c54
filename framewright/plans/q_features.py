"""Feature pipeline and clustering over the order lines (retail stand-in)."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewright.operators import features
from framewright.operators.filters import time_split
from framewright.plans.catalog import register
from framewright.sources.tables import Tables


def retail_lines(spark, sf_dir):
    """Retail roles: unit price, quantity and invoice date of each order line."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_quantity", "l_extendedprice")
    o = t.orders.select("o_orderkey", "o_orderdate")
    lines = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return lines.select((F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
                        F.col("l_quantity").alias("quantity"), F.col("o_orderdate").alias("invoice_date"))


@register("kmeans_cost", covers=("M1", "M2", "M3", "M4", "M5", "M6", "M7", "F14", "O11"), oracle="""
WITH lines AS (
  SELECT dayname(o.o_orderdate) AS day_of_week, o.o_orderdate >= DATE '2000-01-01' AS later
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
days AS (
  SELECT day_of_week, count(*) FILTER (WHERE NOT later) AS n_train, count(*) FILTER (WHERE later) AS n_test
  FROM lines GROUP BY day_of_week)
SELECT day_of_week, n_train, n_test,
       CAST(row_number() OVER (ORDER BY n_train DESC, day_of_week) - 1 AS BIGINT) AS day_index,
       20::BIGINT AS k, true AS train_cost_agrees, true AS test_cost_agrees
FROM days
""")
def kmeans_cost(spark, sf_dir):
    """What is known of the features and the clustering without its seeded centres: rows of both
    splits by weekday, the weekday's index, and whether the costs equal those of a brute-force search of
    the nearest of the same centres for every row."""
    prepped = features.prepare(retail_lines(spark, sf_dir), "invoice_date")
    held = features.cached_for_iterations(prepped)      # joined once, in plain columns: the fits and the costs read it many times
    try:
        train, test = time_split(held, "invoice_date", "2000-01-01")
        stages = features.fit_features(train, ["unit_price", "quantity"], "day_of_week")
        train_f = stages.transform(train).select("features")
        model = features.fit_kmeans(train_f, k=20, seed=1)
        agrees = []
        for rows in (train_f, stages.transform(test).select("features")):
            cost, brute = (f(spark, model, rows).first()["cost"] for f in (features.clustering_cost, features.nearest_cost))
            agrees.append(abs((cost or 0.0) - (brute or 0.0)) <= 1e-9 * max(cost or 0.0, 1.0))
    finally:
        held.unpersist()
    later = F.col("invoice_date") >= F.to_date(F.lit("2000-01-01"))
    days = prepped.groupBy("day_of_week").agg(F.count(F.when(~later, 1)).alias("n_train"), F.count(F.when(later, 1)).alias("n_test"))
    index = stages.stages[0].transform(days.select("day_of_week")).select("day_of_week", F.col("day_of_week_index").cast("long").alias("day_index"))
    return days.join(index, "day_of_week").select(
        "day_of_week", "n_train", "n_test", "day_index", F.lit(model.getK()).cast("long").alias("k"),
        F.lit(agrees[0]).alias("train_cost_agrees"), F.lit(agrees[1]).alias("test_cost_agrees"))
