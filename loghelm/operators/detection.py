"""From raw scores to detections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghelm.functions.scoring import MODELS, min_max, scaled_threshold
from loghelm.operators.context import with_context
from loghelm.operators.lookup import lookup
from loghelm.operators.models import ModelTables, dimension, score_stats, score_vectors
from loghelm.operators.vectors import template_vectors
from loghelm.session import materialize
from loghelm.sources.records import split_by_dimension

PARAM_FIELDS = ("threshold", "norm_threshold", "s_min", "s_max")


def load_params(params: DataFrame, scored: DataFrame | None = None) -> dict[str, dict[str, float]]:
    """The three parameter rows as numbers. Ranges that the table lacks come
    from the scored batch, missing normalised thresholds from the ranges."""
    found = {r["model"]: {f: r[f] for f in PARAM_FIELDS} for r in params.collect()}  # one row per model
    if any(found[m][f] is None for m in MODELS for f in ("s_min", "s_max")):
        batch = {r["model"]: r for r in score_stats(scored).collect()}
        for m in MODELS:
            for f in ("s_min", "s_max"):
                found[m][f] = batch[m][f] if found[m][f] is None else found[m][f]
    for m in MODELS:
        p = found[m]
        if p["norm_threshold"] is None:
            p["norm_threshold"] = scaled_threshold(p["threshold"], p["s_min"], p["s_max"])
    return found


def decide(scored: DataFrame, params: dict[str, dict[str, float]], model: str = "ensemble") -> DataFrame:
    """Add `anomaly_score`, `is_anomaly`, `threshold_used` and `votes`.

    The ensemble needs two of three raw scores at or above their thresholds;
    it reports the largest normalised score and the mean normalised threshold,
    so a row may be an anomaly below the reported threshold. Any unknown model
    name means the ensemble.
    """

    def flag(m: str) -> Column:
        return F.col(m) >= F.lit(params[m]["threshold"])

    def norm(m: str) -> Column:
        return min_max(F.col(m), params[m]["s_min"], params[m]["s_max"])

    votes = sum((flag(m).cast("int") for m in MODELS[1:]), flag(MODELS[0]).cast("int"))
    if model in MODELS:
        score, threshold, anomaly = norm(model), params[model]["norm_threshold"], flag(model)
    else:
        score = F.greatest(*[norm(m) for m in MODELS])
        threshold = sum(params[m]["norm_threshold"] for m in MODELS) / 3.0
        anomaly = votes >= 2
    return scored.withColumns(
        {
            "anomaly_score": F.round(score, 4),
            "is_anomaly": anomaly,
            "threshold_used": F.round(F.lit(threshold), 4),
            "votes": votes,
        }
    )


def above_cutoff(detections: DataFrame, cutoff: float) -> DataFrame:
    """Optional gate by the feedback-adapted consensus cutoff."""
    return detections.withColumn("is_anomaly", F.col("is_anomaly") & (F.col("anomaly_score") >= cutoff))


def decide_templates(
    lines: DataFrame, models: ModelTables, model: str = "ensemble", dim: int = 384
) -> tuple[DataFrame, DataFrame]:
    """Decisions per distinct template, and the lines `n` of each template.
    Templates are embedded, scored and decided once each."""
    scored = materialize(score_vectors(template_vectors(lines, dim), models).drop("embedding"))
    decided = decide(scored, load_params(models.params, scored), model)
    return decided.drop("n"), scored.select("template", "n")


def score_lines(
    lines: DataFrame,
    models: ModelTables,
    model: str = "ensemble",
    dim: int = 384,
    spread: tuple[str, ...] = ("file", "line_no"),
    **lookup_options,
) -> DataFrame:
    """Decide every line by looking its template up. Hot templates are known
    from the counts and are split up in a shuffled lookup."""
    decided, counts = decide_templates(lines, models, model, dim)
    return lookup(lines, decided, "template", spread, counts=counts, **lookup_options)


def score_records(records: DataFrame, models: ModelTables, model: str = "ensemble") -> DataFrame:
    """Decide records that bring their own vector, row by row. Records whose
    vector does not fit the models are left to `rejected_records`."""
    fitting, _ = split_by_dimension(records, dimension(models))
    scored = score_vectors(fitting, models)
    return decide(scored, load_params(models.params, scored), model)


def rejected_records(records: DataFrame, models: ModelTables) -> DataFrame:
    """Records that `score_records` leaves out: no vector, or one of another size."""
    return split_by_dimension(records, dimension(models))[1]


def detect(
    lines: DataFrame,
    models: ModelTables,
    model: str = "ensemble",
    limit: int | None = None,
    dim: int = 384,
    window: int = 2,
) -> DataFrame:
    """Detection contract for every line, its context included."""
    if limit is not None:
        # the first `limit` lines over all files lie below that place in their own
        lines = lines.where(F.col("pos") < limit).orderBy("file", "pos").limit(limit)
    decided = score_lines(lines, models, model, dim)
    return with_context(decided, before=window, after=window).select(
        "log_id", "anomaly_score", "is_anomaly", "threshold_used", "context_window", "file", "pos"
    )
