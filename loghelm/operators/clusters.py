"""K-means centres over weighted distinct vectors."""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loghelm.schemas import CENTROIDS
from loghelm.session import parameter_table

CLUSTERS = 10
SEED = 42


def fit_kmeans(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> DataFrame:
    """Centre table (`clusters` x dimension values). A template counts as many
    times as it has lines."""
    points = vectors.select(array_to_vector("embedding").alias("features"), F.col("n").cast("double").alias("w"))
    model = KMeans(k=clusters, seed=seed, weightCol="w", maxIter=300, tol=1e-4).fit(points)
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    return parameter_table(vectors.sparkSession, CENTROIDS, rows)


def centers_of(centroids: DataFrame) -> np.ndarray:
    """Centres as an array; a parameter table of fixed size."""
    return np.array([r["center"] for r in centroids.orderBy("cluster").collect()])
