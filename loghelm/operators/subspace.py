"""Principal axes over weighted distinct vectors."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loghelm.schemas import PCA_AXES
from loghelm.session import parameter_table

COMPONENTS = 32


def fit_pca(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Mean (axis -1) and leading axes of the weighted covariance.

    One distributed pass builds the Gram matrix of the rows (x, 1) scaled by
    the root of their weight; it holds the weighted second moments, the sums
    and the total weight. Only that (d+1) x (d+1) matrix reaches the driver.
    """
    root = F.sqrt(F.col("n").cast("double"))
    scaled = F.transform(F.concat("embedding", F.array(F.lit(1.0))), lambda v: v * root)
    rows = MLUtils.convertVectorColumnsFromML(vectors.select(array_to_vector(scaled).alias("row")), "row")
    gram = RowMatrix(rows).computeGramianMatrix().toArray()
    total = gram[-1, -1]
    mean = gram[:-1, -1] / total
    if components > len(mean) or components > total:
        raise ValueError("more components than dimensions or rows")
    covariance = gram[:-1, :-1] / total - np.outer(mean, mean)
    _, axes = np.linalg.eigh(covariance)
    leading = axes[:, ::-1][:, :components].T
    # An axis and its opposite are equal; fix the sign for repeatable tables.
    leading = leading * np.sign(leading[np.arange(len(leading)), np.abs(leading).argmax(axis=1)])[:, None]
    table = [(-1, [float(v) for v in mean])]
    table += [(i, [float(v) for v in a]) for i, a in enumerate(leading)]
    return parameter_table(vectors.sparkSession, PCA_AXES, table)


def mean_and_axes(pca: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    rows = {r["axis"]: np.array(r["vector"]) for r in pca.collect()}  # components + 1 rows
    return rows[-1], np.array([rows[i] for i in sorted(rows) if i >= 0])
