"""Host metrics at the time of an incident."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loghelm.operators.lookup import lookup
from loghelm.operators.ordering import ROWS_PER_RANGE, with_range
from loghelm.session import materialize


def metrics_as_of(
    incidents: DataFrame,
    metrics: DataFrame,
    key: str = "host",
    ts: str = "ts",
    values: tuple[str, ...] = ("cpu_percent", "memory_percent"),
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add the latest sample of the same host not younger than the incident.

    Both tables are laid on one time line per host and cut into ranges, an instant with
    many rows into several.
    A range starts with the last sample before it (one row per host and
    range), so ranges of a busy host are filled side by side.
    """
    sample = F.struct(*values).alias("__sample")
    own = [c for c in incidents.columns if c not in (key, ts)]
    left = incidents.select(key, ts, F.lit(1).alias("__kind"), F.struct(*own).alias("__own"), F.lit(None).cast(_struct(metrics, values)).alias("__sample"))
    right = metrics.select(key, ts, F.lit(0).alias("__kind"), F.lit(None).cast(_struct(incidents, own)).alias("__own"), sample)
    # incidents of one instant may stand in any order, so a hash parts them
    both = left.unionByName(right).withColumn("__tie", F.xxhash64("__own"))
    line = with_range(both, (ts, "__kind", "__sample", "__tie"), rows_per_range=rows_per_range).drop("__tie")

    has_sample = F.col("__kind") == 0
    # of several samples at one instant the greatest counts, so that runs repeat
    order = F.struct(ts, "__kind", "__sample")
    per_range = line.groupBy(key, "__range").agg(
        F.max(F.when(has_sample, F.struct(ts, "__sample")))["__sample"].alias("__sample"),
    )
    earlier = Window.partitionBy(key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_range.select(
        key, "__range", F.last("__sample", ignorenulls=True).over(earlier).alias("__sample")
    ).where(F.col("__sample").isNotNull())
    carried = carried.select(
        key,
        F.lit(None).cast(line.schema[ts].dataType).alias(ts),
        F.lit(0).alias("__kind"),
        F.lit(None).cast(line.schema["__own"].dataType).alias("__own"),
        "__sample",
        "__range",
    )
    filled = Window.partitionBy(key, "__range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        line.unionByName(carried)
        .withColumn("__sample", F.last("__sample", ignorenulls=True).over(filled))
        .where(F.col("__kind") == 1)
        .select(key, ts, "__own.*", *[F.col(f"__sample.{v}").alias(v) for v in values])
    )


def _struct(df: DataFrame, names) -> str:
    return "struct<" + ",".join(f"`{n}`:{df.schema[n].dataType.simpleString()}" for n in names) + ">"


def latest_metrics(metrics: DataFrame, key: str = "host", ts: str = "ts") -> DataFrame:
    """Newest sample per host, the greatest of several at one instant."""
    values = [c for c in metrics.columns if c not in (key, ts)]
    newest = metrics.groupBy(key).agg(F.max(F.struct(ts, *values)).alias("__sample"))
    return newest.select(key, *[F.col(f"__sample.{v}").alias(v) for v in values])


def with_latest_metrics(alerts: DataFrame, metrics: DataFrame, key: str = "host") -> DataFrame:
    """Attach the newest sample of the host; works for a stream of alerts too."""
    if alerts.isStreaming:
        return alerts.join(latest_metrics(metrics, key), key, "left")
    return lookup(alerts, materialize(latest_metrics(metrics, key)), key, tuple(alerts.columns))
