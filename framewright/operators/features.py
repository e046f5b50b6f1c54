"""Feature preparation and clustering (M1-M7), on Spark ML.

* Indexing and encoding fit on the training rows only; unseen categories at transform time
  get their own index (``handleInvalid="keep"``).
* The clustering cost of any frame is a distributed aggregate: each row's squared distance to
  its assigned centre, summed.  The centres (``k`` rows, a known bound) go along with the tasks; the
  distances are computed over Arrow batches, and no row is shuffled for them.
* A fit keeps its training rows as blocks (matrices), a fraction of the size of one vector object per row,
  so what is worth caching before it is the plain columns that the features are made from.
* The reference shrinks its input to five partitions before fitting; at scale that would remove
  the parallelism, so ``prepare`` leaves partitioning alone unless asked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def prepare(df: DataFrame, ts: str, day_name: str = "day_of_week", fill=0,
            partitions: int | None = None) -> DataFrame:
    """M1: fill numeric nulls, add the weekday name of ``ts``; optionally coalesce."""
    out = df.na.fill(fill).withColumn(day_name, F.date_format(F.col(ts), "EEEE"))
    return out.coalesce(partitions) if partitions else out


def feature_stages(numeric: Sequence[str], category: str, features: str = "features") -> Pipeline:
    """M2-M5: index the category by frequency, one-hot encode it, assemble with the numbers."""
    idx, enc = f"{category}_index", f"{category}_encoded"
    return Pipeline(stages=[
        StringIndexer(inputCol=category, outputCol=idx, handleInvalid="keep"),
        OneHotEncoder(inputCol=idx, outputCol=enc),
        VectorAssembler(inputCols=[*numeric, enc], outputCol=features),
    ])


def fit_features(train: DataFrame, numeric: Sequence[str], category: str) -> PipelineModel:
    """M5: fit the feature stages on the training rows."""
    return feature_stages(numeric, category).fit(train)


def cached_for_iterations(df: DataFrame) -> DataFrame:
    """Cache a frame that an iterative fit reads many times.  Its partitions stay as they are, so a
    seeded fit does not depend on the number of cores.  Unpersist the result when done, unless the
    input was cached before the call (then it is the input)."""
    return df.cache()


def fit_kmeans(features: DataFrame, k: int = 20, seed: int = 1, column: str = "features") -> KMeansModel:
    """M6.  The solver keeps the rows as blocks itself, so ``features`` needs no cache of its own."""
    return KMeans(k=k, seed=seed, featuresCol=column, solver="block").fit(features)


def _summed(rows: DataFrame, width: int, distances: Callable[[pa.RecordBatch, np.ndarray], np.ndarray]) -> DataFrame:
    """``cost``: the sum of ``distances`` over all batches, given the vectors ``__x`` as the columns of a matrix of ``width``
    rows; one number per task is added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0.0, False
        for batch in batches:
            if batch.num_rows:
                x = np.ascontiguousarray(batch.column("__x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width).T)
                total, seen = total + float(distances(batch, x).sum()), True
        if seen:
            yield pa.RecordBatch.from_pydict({"cost": [total]})

    return rows.where("__x IS NOT NULL").mapInArrow(run, "cost double").agg(F.sum("cost").alias("cost"))


def clustering_cost(spark: SparkSession, model: KMeansModel, features: DataFrame,
                    column: str = "features") -> DataFrame:
    """M7: one-row frame with the sum of squared distances of the rows to their nearest centre
    (the training cost when ``features`` is the training set)."""
    scored = model.transform(features).select(vector_to_array(F.col(column)).alias("__x"),
                                              F.col(model.getPredictionCol()).alias("__p"))
    centres = np.array(model.clusterCenters())

    def to_own(batch: pa.RecordBatch, x: np.ndarray) -> np.ndarray:
        return ((x - centres.T[:, batch.column("__p").to_numpy()]) ** 2).sum(axis=0)

    return _summed(scored, centres.shape[1], to_own)


def nearest_cost(spark: SparkSession, model: KMeansModel, features: DataFrame, column: str = "features") -> DataFrame:
    """The same cost by searching all ``k`` centres (a parameter, so few) for every row."""
    centres = np.array(model.clusterCenters())

    def to_nearest(batch: pa.RecordBatch, x: np.ndarray) -> np.ndarray:
        return np.min([((x - c[:, None]) ** 2).sum(axis=0) for c in centres], axis=0)

    return _summed(features.select(vector_to_array(F.col(column)).alias("__x")), centres.shape[1], to_nearest)
