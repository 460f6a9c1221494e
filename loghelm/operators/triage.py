"""Verdicts of administrators and the threshold they adapt."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loghelm import schemas
from loghelm.operators.ordering import dense_positions, running_totals
from loghelm.session import materialize, parameter_table
from loghelm.sources import parameters
from loghelm.sources.records import read_feedback

# Bounds, default step and default cutoff.
LOWEST, HIGHEST = 0.1, 0.95
LEARNING_RATE = 0.02
DEFAULT_CUTOFF = 0.50


def verdict_counts(feedback: DataFrame) -> DataFrame:
    verdict = F.col("administrator_verdict")
    return feedback.agg(
        F.count("*").alias("total"),
        F.count_if(verdict == "confirmed").alias("confirmed"),
        F.count_if(verdict == "dismissed").alias("dismissed"),
    )


def adapted(base: Column, total: Column, confirmed: Column, dismissed: Column, rate: float) -> Column:
    """Dismissals raise the threshold, confirmations lower it, within bounds;
    without verdicts it stays as it is."""
    moved = base + (dismissed - confirmed) * F.lit(rate)
    bounded = F.round(F.greatest(F.lit(LOWEST), F.least(F.lit(HIGHEST), moved)), 4)
    return F.when(total == 0, base).otherwise(bounded)


def adapt_threshold(feedback: DataFrame, base: float, rate: float = LEARNING_RATE) -> DataFrame:
    counts = [F.col(c) for c in ("total", "confirmed", "dismissed")]
    return verdict_counts(feedback).select("*", adapted(F.lit(base), *counts, rate).alias("threshold"))


def replay_threshold(
    feedback: DataFrame,
    order: str,
    base: float = DEFAULT_CUTOFF,
    rate: float = LEARNING_RATE,
    rows_per_chunk: int = 100_000,
    net: int = 0,
) -> DataFrame:
    """The cutoff after verdicts that came one at a time, each applying the
    whole history up to it to the cutoff of the one before (one row).

    A step adds the net count so far times the rate and clamps. Such steps
    compose into one step of the same form, x -> clamp(x + shift, low, high),
    so chunks of the history are folded side by side and only one composed
    step per chunk is folded at the end. Steps are counted in ten-thousandths,
    the precision to which a cutoff is kept. `net` is the net count of the verdicts
    that `base` holds already; the row brings the one after these.

    `order` is unique; `feedback` is file-backed or materialized.
    """
    verdict = F.col("administrator_verdict")
    one = F.when(verdict == "dismissed", 1).when(verdict == "confirmed", -1).otherwise(0)
    ranked = dense_positions(materialize(feedback.select(order, one.alias("net"))), order, out="rank")
    ranked = materialize(ranked)
    count, change = ranked.agg(F.count("*"), F.coalesce(F.sum("net"), F.lit(0))).first()
    ranked = running_totals(ranked, "rank", {"pressure": F.col("net")})
    shift = F.round((F.col("pressure") + net) * F.lit(rate * 10_000)).cast("long")
    low, high = round(LOWEST * 10_000), round(HIGHEST * 10_000)

    def clamp(value: Column) -> Column:
        return F.greatest(F.lit(low), F.least(F.lit(high), value)).cast("long")

    def then(first: Column, second: Column) -> Column:
        """The step equal to `first` followed by `second`."""
        bound = lambda v: F.greatest(
            second["low"], F.least(second["high"], first[v] + second["shift"])
        )
        return F.struct(
            (first["shift"] + second["shift"]).alias("shift"), bound("low").alias("low"), bound("high").alias("high")
        )

    def fold(steps: DataFrame, group: Column) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("rank", "step")))
        folded = F.aggregate(
            F.slice(F.col("steps"), 2, F.size("steps")), F.col("steps")[0]["step"], lambda a, s: then(a, s["step"])
        )
        grouped = steps.groupBy(group.alias("rank")).agg(ordered.alias("steps"))
        return grouped.select("rank", folded.alias("step"))

    one_step = F.struct(
        shift.alias("shift"), F.lit(low).cast("long").alias("low"), F.lit(high).cast("long").alias("high")
    )
    steps = ranked.select("rank", one_step.alias("step"))
    for _ in range(max(1, math.ceil(math.log(max(count, 2), rows_per_chunk)))):
        steps = fold(steps, F.floor(F.col("rank") / rows_per_chunk))
    start = F.lit(base * 10_000)
    end = F.greatest(F.col("step.low"), F.least(F.col("step.high"), start + F.col("step.shift")))
    final = steps.agg(F.first(F.round(end / 10_000, 4)).alias("threshold"))
    return final.select(
        F.lit(count).cast("long").alias("total"),
        F.coalesce("threshold", F.lit(base)).alias("threshold"),
        F.lit(net + change).cast("long").alias("net"),
    )


def stored_settings(spark: SparkSession, model_path: str) -> tuple[int, dict[str, float] | None]:
    """The newest model settings (a handful) and their version; None where there are none."""
    version, tables = parameters.read_tables(spark, model_path, ("settings",))
    if "settings" not in tables:
        return version, None
    return version, {row["key"]: row["value"] for row in tables["settings"].select("key", "value").collect()}


def publish_settings(spark: SparkSession, model_path: str, settings: dict[str, float], follows: int) -> None:
    table = parameter_table(spark, schemas.MODEL_SETTINGS, list(settings.items()))
    parameters.publish(spark, model_path, {"settings": table.coalesce(1)}, follows)


def persist_adapted_cutoff(
    spark: SparkSession, model_path: str, feedback_path: str, rate: float = LEARNING_RATE
) -> float | None:
    """Apply all verdicts to the stored consensus cutoff and store the result
    as a new version. None when there are no model settings."""
    version, settings = stored_settings(spark, model_path)
    if settings is None:
        return None
    base = settings.get("consensus_cutoff", DEFAULT_CUTOFF)
    cutoff = adapt_threshold(read_feedback(spark, feedback_path), base, rate).first()["threshold"]
    publish_settings(spark, model_path, {**settings, "consensus_cutoff": cutoff}, version)
    return cutoff


def apply_verdicts(
    verdicts: DataFrame, batch_id: int, model_path: str, order: str, rate: float = LEARNING_RATE
) -> None:
    """Carry the stored cutoff on by one batch of new verdicts (`order`,
    `administrator_verdict`), without reading older ones: what they add up to is
    kept with the cutoff. The number of the batch is stored in the same version, so a batch
    that is run again after a failure changes nothing."""
    spark = verdicts.sparkSession
    version, settings = stored_settings(spark, model_path)
    settings = settings or {}
    if settings.get("verdict_batch", -1.0) >= batch_id:
        return
    base = settings.get("consensus_cutoff", DEFAULT_CUTOFF)
    net = settings.get("verdict_net", 0.0)
    moved = replay_threshold(verdicts, order, base, rate, net=int(net)).first()
    after = {
        "consensus_cutoff": moved["threshold"],
        "verdict_net": float(moved["net"]),
        "verdict_total": settings.get("verdict_total", 0.0) + moved["total"],
        "verdict_batch": float(batch_id),
    }
    publish_settings(spark, model_path, {**settings, **after}, version)
