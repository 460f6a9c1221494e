"""Detector quality against labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghelm.functions.scoring import MODELS
from loghelm.operators.ordering import ROWS_PER_RANGE, running_totals
from loghelm.session import materialize

# Row names of the report.
ROW_NAMES = {
    "isolation_forest": "Isolation Forest (Baseline)",
    "autoencoder": "Autoencoder (PCA)",
    "kmeans": "K-Means Clustering",
    "ensemble": "Ensemble (Majority Vote)",
}


def confusion(counted: DataFrame) -> DataFrame:
    """tn, fp, fn, tp per model from rows (model, label, predicted, n)."""

    def cell(label: int, predicted: int) -> Column:
        hit = (F.col("label") == label) & (F.col("predicted") == predicted)
        return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0))

    return counted.groupBy("model").agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def _share(part: Column, whole: Column) -> Column:
    """Percentage, 0 for an empty whole."""
    return F.coalesce(F.try_divide(part.cast("double") * 100, whole.cast("double")), F.lit(0.0))


def with_quality(cells: DataFrame) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return cells.withColumns(
        {
            "precision": _share(tp, tp + fp),
            "recall": _share(tp, tp + fn),
            "f1": _share(tp * 2, tp * 2 + fp + fn),
            "accuracy": _share(tp + tn, tp + tn + fp + fn),
        }
    )


def roc_auc(counted: DataFrame, key: str = "model", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Rank-sum AUC in percent per key from rows (key, score, label, n).

    Rows are first counted per distinct score; a positive beats the negatives
    below it and half of those level with it. 0 when a class is missing.
    """
    one = lambda label: F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0))
    scores = materialize(counted.groupBy(key, "score").agg(one(1).alias("pos"), one(0).alias("neg")))
    ranked = running_totals(scores, "score", {"neg_to_here": F.col("neg")}, (key,), rows_per_range)
    wins = F.col("pos").cast("double") * (F.col("neg_to_here") - F.col("neg") / 2.0)
    summed = ranked.groupBy(key).agg(F.sum(wins).alias("w"), F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    pairs = F.col("p").cast("double") * F.col("q")
    return summed.select(key, F.coalesce(F.try_divide(F.col("w") * 100, pairs), F.lit(0.0)).alias("auc"))


def evaluate(scored: DataFrame, thresholds: dict[str, float], weight: str | None = None) -> DataFrame:
    """Quality of the three detectors and their vote: four rows.

    `scored` has the raw scores and `label`; rows of unknown label (-1) are
    left out. Everything is computed from counts per distinct score triple, so
    after one aggregation the size is that of the templates, not the log.
    The ensemble has no score of its own; its AUC is the forest's.
    """
    n = F.count("*") if weight is None else F.sum(weight)
    counted = materialize(scored.where(F.col("label") >= 0).groupBy(*MODELS, "label").agg(n.alias("n")))
    flags = {m: (F.col(m) >= thresholds[m]).cast("int") for m in MODELS}
    flags["ensemble"] = (sum(flags[m] for m in MODELS[1:]) + flags[MODELS[0]] >= 2).cast("int")
    score_of = {m: F.col(m) for m in MODELS} | {"ensemble": F.col("isolation_forest")}
    rows = [
        F.struct(F.lit(m).alias("model"), score_of[m].alias("score"), flags[m].alias("predicted"))
        for m in ROW_NAMES
    ]
    long = counted.select("label", "n", F.inline(F.array(*rows)))
    quality = with_quality(confusion(long))
    return quality.join(roc_auc(long), "model").withColumn(
        "name", F.create_map(*[F.lit(x) for kv in ROW_NAMES.items() for x in kv])[F.col("model")]
    )


def class_balance(labels: DataFrame) -> DataFrame:
    normal, anomaly = F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)
    return labels.agg(
        F.count("*").alias("total"),
        normal.alias("normal"),
        anomaly.alias("anomaly"),
        _share(normal, F.count("*")).alias("normal_percent"),
        _share(anomaly, F.count("*")).alias("anomaly_percent"),
    )
