"""The incident queue and its figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_score(detections: DataFrame) -> list[Column]:
    """Highest score first; equal scores keep the order of files and of their lines."""
    return [F.desc("anomaly_score"), *[F.col(c) for c in ("file", "pos") if c in detections.columns]]


def search(detections: DataFrame, text: str | None) -> DataFrame:
    """Rows whose log id contains the text, whatever the case; empty finds all."""
    if not text:
        return detections
    return detections.where(F.contains(F.lower("log_id"), F.lower(F.lit(text))))


def two_digits(score: Column) -> Column:
    """Score in 0..8 as text with two digits, rounded by its exact binary value
    (0.145 lies below the tie and shows as 0.14, 0.125 is a tie and goes to the even 0.12)."""
    unit = F.lit(1 << 60)
    scaled = (score * F.lit(float(1 << 60))).cast("long").cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")
    whole = F.floor(scaled / unit.cast("decimal(20,0)")).cast("long")
    rest = (scaled - whole.cast("decimal(20,0)") * unit.cast("decimal(20,0)")).cast("decimal(38,0)")
    half = F.lit(1 << 59).cast("decimal(20,0)")
    cents = whole + ((rest > half) | ((rest == half) & (whole % 2 == 1))).cast("long")
    return F.format_string("%d.%02d", F.floor(cents / 100).cast("long"), cents % 100)


def incident_queue(detections: DataFrame, text: str | None = None, consensus: str = "2/3 Models") -> DataFrame:
    """All anomalies in queue order as display rows."""
    queue = search(detections.where("is_anomaly"), text).orderBy(*by_score(detections))
    return queue.select(
        F.col("log_id").alias("incident_id"),
        two_digits(F.col("anomaly_score")).alias("score"),
        F.lit(consensus).alias("consensus"),
    )


def top_incidents(detections: DataFrame, n: int = 3) -> DataFrame:
    """The first `n` of the queue, numbered from 1."""
    top = detections.where("is_anomaly").orderBy(*by_score(detections)).limit(n)
    place = [c for c in ("file", "pos") if c in detections.columns]
    ranked = top.agg(F.sort_array(F.collect_list(F.struct((-F.col("anomaly_score")).alias("s"), *place, "log_id"))).alias("t"))
    return ranked.select(F.posexplode("t").alias("i", "t")).select(
        (F.col("i") + 1).alias("rank"),
        F.col("t.log_id").alias("log_id"),
        (-F.col("t.s")).alias("anomaly_score"),
    )


def key_figures(detections: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Lines seen, lines flagged, their share, and the triage counts (one row);
    `verdicts` is the one-row table of verdict counts."""
    flagged = F.count_if(F.col("is_anomaly"))
    figures = detections.agg(
        F.count("*").alias("ingested"),
        flagged.alias("flagged"),
        (flagged / F.greatest(F.lit(1), F.count("*")) * 100).alias("deviation_percent"),
        F.lit(1).alias("one"),
    )
    return figures.join(verdicts.withColumn("one", F.lit(1)), "one").drop("one")


def anomaly_rate(detections: DataFrame) -> DataFrame:
    return detections.agg(F.avg(F.col("is_anomaly").cast("int")).alias("anomaly_rate"))
