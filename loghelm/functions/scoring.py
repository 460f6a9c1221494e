"""Column functions of the detection step: normalisation, votes, model scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

MODELS = ("isolation_forest", "kmeans", "autoencoder")
# Raw scores keep this many decimals, so that equal scores stay equal (and on
# the same side of a threshold) on every machine and in every batch.
SCORE_DIGITS = 10
# Fixed value: keeps the scaling finite when a range is empty.
NORM_GUARD = 1e-8


def min_max(score: Column, s_min: float, s_max: float) -> Column:
    """Scale into 0..1 by a known range."""
    scaled = (score - F.lit(s_min)) / F.lit(s_max - s_min + NORM_GUARD)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled))


def scaled_threshold(threshold: float, s_min: float, s_max: float) -> float:
    """Scale a threshold into 0..1, one half when the range is empty."""
    span = s_max - s_min
    return 0.5 if abs(span) < NORM_GUARD else min(1.0, max(0.0, (threshold - s_min) / span))


def matrix(vectors: pa.Array, dim: int | None = None) -> np.ndarray:
    """Arrow list column as an n x d matrix. A missing vector, or one of
    another size than `dim` (by default: than the first), raises."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if len(vectors):
        sizes = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
        dim = sizes[0] if dim is None else dim
        if dim < 1 or (sizes != dim).any():
            raise ValueError("vectors of other sizes; set them aside with split_by_dimension")
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat, dtype=np.float64).reshape(len(vectors), -1 if len(vectors) else 0)


def nearest_distance(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Distance to the nearest centre. One row at a time decides its own sum
    order, so a vector scores the same in every batch."""
    best = np.full(len(x), np.inf)
    for center in centers:
        np.minimum(best, ((x - center) ** 2).sum(axis=1), out=best)
    return np.sqrt(best)


def residual_error(x: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Mean squared error after projection on the axes (k x d, orthonormal)."""
    rest = x - mean
    for axis in axes:
        rest = rest - (rest * axis).sum(axis=1)[:, None] * axis
    return (rest**2).mean(axis=1)


def centroid_distance(embedding: Column, centers: np.ndarray) -> Column:
    centers = np.asarray(centers, dtype=np.float64)

    @F.arrow_udf("double")
    def distance(vectors: pa.Array) -> pa.Array:
        return pa.array(np.round(nearest_distance(matrix(vectors, centers.shape[1]), centers), SCORE_DIGITS))

    return distance(embedding)


def reconstruction_error(embedding: Column, mean: np.ndarray, axes: np.ndarray) -> Column:
    mean, axes = np.asarray(mean, dtype=np.float64), np.asarray(axes, dtype=np.float64)

    @F.arrow_udf("double")
    def error(vectors: pa.Array) -> pa.Array:
        return pa.array(np.round(residual_error(matrix(vectors, len(mean)), mean, axes), SCORE_DIGITS))

    return error(embedding)
