"""Clustering cost is exact against a brute-force computation; cost falls with k."""

import numpy as np
from pyspark.ml.functions import vector_to_array

from framewright.operators import features
from framewright.operators.filters import time_split
from framewright.plans.q_features import retail_lines
from tests.conftest import SF001


def _prepared(spark):
    prepped = features.prepare(retail_lines(spark, SF001), "invoice_date")
    train, test = time_split(prepped, "invoice_date", "2000-01-01")
    stages = features.fit_features(train, ["unit_price", "quantity"], "day_of_week")
    return stages.transform(train).select("features"), stages.transform(test).select("features")


def test_cost_matches_brute_force(spark):
    train, test = _prepared(spark)
    model = features.fit_kmeans(train, k=5, seed=1)
    got = features.clustering_cost(spark, model, test).first().cost
    x = np.array([r.a for r in test.select(vector_to_array("features").alias("a")).collect()])
    c = np.array(model.clusterCenters())
    d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2).min(axis=1).sum()
    assert abs(got - d) <= 1e-6 * max(1.0, d)


def test_cost_falls_with_k(spark):
    train, _ = _prepared(spark)
    small = features.clustering_cost(spark, features.fit_kmeans(train, k=2, seed=1), train).first().cost
    large = features.clustering_cost(spark, features.fit_kmeans(train, k=20, seed=1), train).first().cost
    assert large < small


def test_costs_move_no_rows_and_interpret_no_lambdas(spark):
    train, test = _prepared(spark)
    model = features.fit_kmeans(train, k=3, seed=1)
    frames = [f(spark, model, test) for f in (features.clustering_cost, features.nearest_cost)]
    whole = model.summary.trainingCost
    for cost, f in zip(frames, (features.clustering_cost, features.nearest_cost), strict=True):
        plan = cost._jdf.queryExecution().optimizedPlan().toString()
        assert "lambdafunction" not in plan and plan.split("MapInArrow")[0].count("Join") == 0
        assert plan.count("Join") == 1                                  # lines and orders, none with the centres
        assert abs(f(spark, model, train).first().cost - whole) <= 1e-6 * whole
        assert f(spark, model, test.limit(0)).first().cost is None


def test_kmeans_cost_joins_its_lines_once_for_fit_and_costs(spark, monkeypatch):
    from framewright.plans import q_features
    seen = []
    fit = features.fit_features
    monkeypatch.setattr(features, "fit_features", lambda train, *a: seen.append(train) or fit(train, *a))
    real = features.cached_for_iterations
    monkeypatch.setattr(features, "cached_for_iterations", lambda df: seen.append(df) or real(df))
    q_features.kmeans_cost(spark, SF001)
    held, train = seen                                                  # held before the first fit, and the fit reads it
    assert held.columns == ["unit_price", "quantity", "invoice_date", "day_of_week"] and train.columns == held.columns
    assert not held.is_cached
