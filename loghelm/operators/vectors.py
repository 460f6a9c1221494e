"""Weighted tables of distinct vectors: the unit of fitting and scoring.

Scores depend on the template only, so every model works on one row per
template (or vector) and its number of lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loghelm.functions.hashing import DEFAULT_DIM, hash_embedding
from loghelm.operators.labels import template_counts
from loghelm.operators.lookup import lookup
from loghelm.session import materialize


def template_vectors(lines: DataFrame, dim: int = DEFAULT_DIM) -> DataFrame:
    """Distinct templates with line count `n` and hashed vector."""
    return template_counts(lines).withColumn("embedding", hash_embedding("template", dim))


def with_vectors(lines: DataFrame, dim: int = DEFAULT_DIM, spread: tuple[str, ...] = ("file", "line_no"), **options) -> DataFrame:
    """Add the hashed vector of each line's template. Templates are embedded once each, lines
    look theirs up; hot templates are known from their counts."""
    found = materialize(template_vectors(lines, dim))
    return lookup(lines, found.drop("n"), "template", spread, counts=found.select("template", "n"), **options)


def distinct_vectors(records: DataFrame) -> DataFrame:
    """Distinct vectors with row count `n`, for records with given vectors."""
    return records.groupBy("embedding").agg(F.count("*").alias("n"))
