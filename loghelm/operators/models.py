"""The fitted detectors: parameter tables, storage, scores per vector."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loghelm import schemas
from loghelm.functions.hashing import hash_matrix
from loghelm.functions.scoring import MODELS, NORM_GUARD, SCORE_DIGITS, matrix, nearest_distance, residual_error
from loghelm.operators.clusters import CLUSTERS, centers_of, fit_kmeans
from loghelm.operators.forest import Forest, fit_forest
from loghelm.operators.selection import weighted_percentiles, weighted_quantiles
from loghelm.operators.subspace import COMPONENTS, fit_pca, mean_and_axes
from loghelm.session import materialize, parameter_table
from loghelm.sources import parameters
from loghelm.sources.records import split_by_dimension

TABLES = ("params", "settings", "forest", "centroids", "pca")
SCORES = ", ".join(f"{m} double" for m in MODELS)


@dataclass
class ModelTables:
    """Parameter tables of fixed size (their sizes follow from the settings)."""

    params: DataFrame
    settings: DataFrame
    forest: DataFrame
    centroids: DataFrame
    pca: DataFrame

    def save(self, path: str) -> None:
        """Store the tables as a new version; the one before stays readable until this one is whole."""
        parameters.publish(self.params.sparkSession, path, {name: getattr(self, name) for name in TABLES})

    @staticmethod
    def load(spark: SparkSession, path: str) -> ModelTables:
        _, tables = parameters.read_tables(spark, path, TABLES)
        if "params" not in tables:
            raise FileNotFoundError(f"no model tables in {path}; fit and save them first")
        return ModelTables(**tables)


def setting(settings: DataFrame, key: str, default: float) -> float:
    row = settings.where(F.col("key") == key).first()
    return default if row is None else row["value"]


def _scorer(models: ModelTables) -> Callable[[np.ndarray], pa.Array]:
    """The three raw scores of the rows of a matrix, as structs. Every
    score is computed row by row and rounded, so it is the same in any batch."""
    centers = centers_of(models.centroids)
    mean, axes = mean_and_axes(models.pca)
    forest = Forest(models.forest.toPandas())
    offset = setting(models.settings, "forest_offset", 0.0)
    kind = pa.struct([(m, pa.float64()) for m in MODELS])

    def scores(x: np.ndarray) -> pa.Array:
        columns = [forest.isolation(x) - offset, nearest_distance(x, centers), residual_error(x, mean, axes)]
        return pa.StructArray.from_arrays([pa.array(np.round(c, SCORE_DIGITS)) for c in columns], fields=list(kind))

    return scores


def dimension(models: ModelTables) -> int:
    """Size of the vectors that the models were fitted on."""
    return len(mean_and_axes(models.pca)[0])


def score_vectors(vectors: DataFrame, models: ModelTables) -> DataFrame:
    """Add one column per model with its raw score, in one Arrow pass. Vectors of another size
    than the models' stop the job; `split_by_dimension` sets them aside."""
    score, dim = _scorer(models), dimension(models)

    @F.arrow_udf(SCORES)
    def scores(batch: pa.Array) -> pa.Array:
        return score(matrix(batch, dim))

    # Reading the vector twice keeps it a column of its own below the Python
    # step, which cannot take the hashing expression as its argument.
    scored = vectors.withColumn("__s", F.when(F.size("embedding") > 0, scores(F.col("embedding"))))
    return scored.select(*vectors.columns, *[F.col(f"__s.{m}").alias(m) for m in MODELS])


def score_texts(lines: DataFrame, models: ModelTables, dim: int, text: str = "template") -> DataFrame:
    """Add the raw scores of each row's hashed `text`, as `score_vectors` gives them for its
    `hash_embedding`. A text is embedded and scored once per Arrow batch, however many
    rows of it have it. A missing text stops the job."""
    score, size = _scorer(models), dimension(models)
    if size != dim:
        raise ValueError(f"vectors of {dim} numbers for models of {size}")

    @F.arrow_udf(SCORES)
    def scores(batch: pa.Array) -> pa.Array:
        if batch.null_count:
            raise ValueError("rows without a text have no vector")
        once = pc.dictionary_encode(batch)
        return score(hash_matrix(once.dictionary.to_pylist(), dim)).take(once.indices)

    scored = lines.withColumn("__s", scores(F.lower(text)))
    return scored.select(*lines.columns, *[F.col(f"__s.{m}").alias(m) for m in MODELS])


def score_stats(scored: DataFrame) -> DataFrame:
    """Smallest and largest score per model (one row each), in one pass."""
    ends = scored.agg(
        *[F.min(m).alias(f"{m}_min") for m in MODELS], *[F.max(m).alias(f"{m}_max") for m in MODELS]
    )
    rows = [F.struct(F.lit(m).alias("model"), F.col(f"{m}_min").alias("s_min"), F.col(f"{m}_max").alias("s_max")) for m in MODELS]
    return ends.select(F.inline(F.array(*rows)))


def calibrate(scored: DataFrame, weight: str = "n", percentile: float = 95.0) -> DataFrame:
    """Threshold, range and normalised threshold per model. `scored` is the
    materialized score table; the threshold comes from the very scores that
    it is compared with."""
    found = weighted_quantiles(scored, {m: (0, percentile, 100) for m in MODELS}, weight)
    rows = []
    for m in MODELS:
        low, threshold, high = found[m]
        norm = min(1.0, max(0.0, (threshold - low) / (high - low + NORM_GUARD)))
        rows.append((m, threshold, norm, low, high))
    return parameter_table(scored.sparkSession, schemas.MODEL_PARAMS, rows)


def fit(
    vectors: DataFrame,
    contamination: float = 0.05,
    n_clusters: int = CLUSTERS,
    ae_latent_dim: int = COMPONENTS,
    percentile: float = 95.0,
    dim: int | None = None,
) -> ModelTables:
    """Fit the three detectors on weighted distinct vectors (`embedding`, `n`,
    `template` where there is one) and calibrate them on the same vectors.

    With `dim`, vectors of any other size are left out (`split_by_dimension`
    returns them); without it, all sizes must be equal."""
    spark = vectors.sparkSession
    name = "template" if "template" in vectors.columns else "embedding"
    if dim is not None:
        vectors, _ = split_by_dimension(vectors, dim)
    vectors = materialize(vectors.select("embedding", "n", F.xxhash64(name).alias("key")))
    size = F.coalesce(F.size("embedding"), F.lit(-1))
    total, low, high = vectors.agg(F.sum("n"), F.min(size), F.max(size)).first()
    if not total:
        raise ValueError("no vectors to fit")
    if low != high or low < 1:
        raise ValueError(f"vectors of {low} to {high} numbers; name the size in dim")
    nodes = materialize(fit_forest(vectors, total))
    centroids = fit_kmeans(vectors, n_clusters)
    pca = fit_pca(vectors, ae_latent_dim)
    bare = ModelTables(None, parameter_table(spark, schemas.MODEL_SETTINGS, []), nodes, centroids, pca)
    scored = materialize(score_vectors(vectors, bare).select("n", *MODELS))
    # Scores above the offset are the `contamination` share of the lines.
    forest_only = weighted_percentiles(scored, MODELS[:1], "n", 100 * (1 - contamination))
    offset = forest_only["isolation_forest"]
    scored = scored.withColumn("isolation_forest", F.round(F.col("isolation_forest") - F.lit(offset), SCORE_DIGITS))
    settings = [
        ("contamination", float(contamination)),
        ("n_clusters", float(n_clusters)),
        ("ae_latent_dim", float(ae_latent_dim)),
        ("forest_offset", float(offset)),
    ]
    return ModelTables(
        params=calibrate(scored, percentile=percentile),
        settings=parameter_table(spark, schemas.MODEL_SETTINGS, settings),
        forest=nodes,
        centroids=centroids,
        pca=pca,
    )


def given_models(spark: SparkSession, centers, mean, axes, nodes, offset: float, params) -> ModelTables:
    """Model tables from parameters that are already known."""
    centroid_rows = [(i, [float(v) for v in c]) for i, c in enumerate(np.asarray(centers))]
    axis_rows = [(-1, [float(v) for v in mean])] + [(i, [float(v) for v in a]) for i, a in enumerate(axes)]
    return ModelTables(
        params=params,
        settings=parameter_table(spark, schemas.MODEL_SETTINGS, [("forest_offset", float(offset))]),
        forest=parameter_table(spark, schemas.FOREST_NODES, nodes),
        centroids=parameter_table(spark, schemas.CENTROIDS, centroid_rows),
        pca=parameter_table(spark, schemas.PCA_AXES, axis_rows),
    )
