"""Global order without a single-task sort: cut the order into ranges, work
inside each range, and carry totals from range to range.

All functions read their input more than once; pass a file-backed or
materialized table.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loghelm.session import materialize

ROWS_PER_RANGE = 1_000_000
SAMPLE_PER_RANGE = 200
RANGES_PER_SORT = 64  # ranges whose sample one task sorts
PIECES = 1 << 24  # numbers for the pieces of one first value


def with_range(
    df: DataFrame,
    order: str | tuple[str, ...],
    out: str = "__range",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Number the range of the order a row falls into, ranges holding about
    `rows_per_range` rows each; later rows have equal or greater numbers, which need not be dense.

    The cuts are rows of a sorted sample, 200 rows a range. A row finds its range by the first
    order column. Where several cuts share its first value (many rows with one time stamp, no value, or
    a first column that is text), the rows of that value are parted by the whole order, so that only rows that are
    equal in all of it must share a range. Where exactly the cuts fall changes no result.
    """
    order = (order,) if isinstance(order, str) else order
    total = df.count()
    ranges = math.ceil(total / rows_per_range)
    if ranges <= 1:
        return df.withColumn(out, F.lit(0).cast("long"))
    position = _position(df, order[0])
    fraction = min(1.0, ranges * SAMPLE_PER_RANGE / total)
    step = max(1, round(total * fraction / ranges))
    sample = df.select(position.alias("__position"), F.struct(*order).alias("__cut")).sample(fraction, seed=11)
    sorted_sample = sample.repartitionByRange(math.ceil(ranges / RANGES_PER_SORT), "__cut").sortWithinPartitions("__cut")
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # the row's place in its partition
    cuts = sorted_sample.withColumn("__place", place).where(F.col("__place") % step == step - 1)
    firsts = [row[0] for row in cuts.select("__position").collect()]  # one number per range
    finite = {v for v in firsts if v is not None and math.isfinite(v)}
    splits = [-math.inf, *sorted(finite or {0.0}), math.inf]
    cutter = Bucketizer(splits=splits, inputCol="__position", outputCol="__bucket", handleInvalid="keep")
    at = F.col("__position")
    bucket = (
        F.when(at.isNull(), -1)
        .when(F.isnan(at), len(splits) + 1)
        .when(at == math.inf, len(splits))
        .otherwise(F.col("__bucket"))
        .cast("long")
    )
    numbered = cutter.transform(df.withColumn("__position", position)).withColumn("__bucket", bucket)
    if len({str(v) for v in firsts}) == len(firsts):
        return numbered.withColumn(out, F.col("__bucket")).drop("__position", "__bucket")
    tied = cuts.groupBy(F.col("__position").alias("__value")).agg(
        F.sort_array(F.collect_set("__cut")).alias("__cuts"), F.count("*").alias("__n")
    )
    tied = materialize(tied.where("__n > 1").drop("__n"))
    joined = numbered.join(F.broadcast(tied), at.eqNullSafe(F.col("__value")), "left")  # at most one cut per range
    piece = F.when(F.col("__cuts").isNotNull(), _cuts_up_to("__cuts", F.struct(*order))).otherwise(PIECES - 1)
    return joined.withColumn(out, F.col("__bucket") * PIECES + piece).select(*df.columns, out)


def _cuts_up_to(cuts: str, row: Column) -> Column:
    """How many of the sorted `cuts` are not greater than `row`, by binary search."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(cuts) + 1)).cast("int"))

    def halve(found: Column, _: Column) -> Column:
        middle = F.shiftright(found["low"] + found["high"], 1)
        below = F.coalesce(F.get(F.col(cuts), middle) <= row, F.lit(False))
        return F.struct(
            F.when(below, middle + 1).otherwise(found["low"]).alias("low"),
            F.when(below, found["high"]).otherwise(middle).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"))
    return F.aggregate(steps, start, halve, lambda found: found["low"])


def _position(df: DataFrame, order: str) -> Column:
    """The order value as DOUBLE; rounding is harmless as it keeps the order and
    equal positions are parted by the values. NULL where it is neither number nor time."""
    kind = df.schema[order].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col(order).cast("timestamp").cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(order).cast("double") + F.lit(0.0)  # -0.0 is 0.0
    return F.lit(None).cast("double")


def running_totals(
    df: DataFrame,
    order: str | tuple[str, ...],
    totals: dict[str, Column],
    keys: tuple[str, ...] = (),
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add running totals (up to and including the row) in `order`.

    `order` is one column or several, unique within `keys`; the ranges are cut
    on all of them. What earlier ranges of a key add up to enters a range as one
    extra first row, so the totals need a single shuffle by (key, range) and
    the widest task holds one range of one key.
    """
    order = (order,) if isinstance(order, str) else order
    names = [f"__{n}" for n in totals]
    ranged = with_range(df.withColumns(dict(zip(names, totals.values()))), order, rows_per_range=rows_per_range)
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        ranged.groupBy(*keys, "__range")
        .agg(*[F.sum(n).alias(n) for n in names])
        .select(*keys, "__range", *[F.sum(n).over(earlier).alias(n) for n in names], F.lit(False).alias("__row"))
    )
    inside = (
        Window.partitionBy(*keys, "__range").orderBy("__row", *order).rowsBetween(Window.unboundedPreceding, 0)
    )
    out = ranged.withColumn("__row", F.lit(True)).unionByName(carry, allowMissingColumns=True)
    out = out.withColumns({n: F.sum(f"__{n}").over(inside) for n in totals})
    return out.where("__row").select(*df.columns, *totals)


def dense_positions(
    df: DataFrame,
    order: str | tuple[str, ...],
    keys: tuple[str, ...] = (),
    out: str = "pos",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Number the rows 0, 1, 2, ... by `order` within `keys`."""
    numbered = running_totals(df, order, {out: F.lit(1).cast("long")}, keys, rows_per_range)
    return numbered.withColumn(out, F.col(out) - 1)
