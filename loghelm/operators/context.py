"""Context windows: the lines around a line, in log order."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loghelm.operators.lookup import broadcast_if_small

ROWS_PER_CHUNK = 10_000
ROWS_PER_TASK = 250_000  # a row leaves with all texts of its window


def with_context(
    lines: DataFrame,
    keys: tuple[str, ...] = ("file",),
    text: str = "raw_text",
    before: int = 2,
    after: int = 2,
    pos: str = "pos",
    out: str = "context_window",
    rows_per_chunk: int = ROWS_PER_CHUNK,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add the array of texts from `before` rows earlier to `after` rows later.

    `pos` numbers the rows 0, 1, 2, ... within `keys`. A log of any length is
    cut into chunks; the rows at a chunk's edges are repeated in the neighbour,
    so the window runs per chunk and no task holds a whole log. The chunks
    are dealt to as many tasks as the rows need (they are counted for it), and
    to no fewer than the session's shuffles have.
    """
    if rows_per_chunk <= before + after:
        raise ValueError("chunks must be longer than the window")
    own = F.floor(F.col(pos) / rows_per_chunk)
    first = F.floor(F.greatest(F.col(pos) - after, F.lit(0)) / rows_per_chunk)
    last = F.floor((F.col(pos) + before) / rows_per_chunk)
    copies = lines.withColumn("__chunk", F.explode(F.array_distinct(F.array(own, first, last))))
    tasks = math.ceil(lines.count() / rows_per_task)
    if tasks > int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        copies = copies.repartition(tasks, *keys, "__chunk")
    frame = Window.partitionBy(*keys, "__chunk").orderBy(pos).rowsBetween(-before, after)
    return (
        copies.withColumn(out, F.collect_list(text).over(frame))
        .where(F.col("__chunk") == own)
        .drop("__chunk")
    )


def with_trailing_context(lines: DataFrame, keys: tuple[str, ...] = ("file",), size: int = 5, **options) -> DataFrame:
    """The last `size` lines up to and including the row."""
    return with_context(lines, keys, before=size - 1, after=0, **options)


def context_of(
    flagged: DataFrame,
    lines: DataFrame,
    keys: tuple[str, ...] = ("file",),
    text: str = "raw_text",
    before: int = 2,
    after: int = 2,
    pos: str = "pos",
    out: str = "context_window",
) -> DataFrame:
    """Context of some rows only: cost grows with the flagged rows, not with
    five times the log. `flagged` is materialized; a small set of wanted
    positions is broadcast and the lines are filtered where they are read.
    """
    wanted = flagged.select(
        *keys,
        F.col(pos).alias("__root"),
        F.explode(F.sequence(F.greatest(F.col(pos) - before, F.lit(0)), F.col(pos) + after)).alias(pos),
    )
    around = (
        lines.select(*keys, pos, F.col(text).alias("__text"))
        .join(broadcast_if_small(wanted), [*keys, pos])
        .groupBy(*keys, "__root")
        .agg(F.sort_array(F.collect_list(F.struct(pos, "__text"))).alias("__around"))
        .select(*keys, F.col("__root").alias(pos), F.col("__around.__text").alias(out))
    )
    return flagged.join(around, [*keys, pos])


def with_root_index(df: DataFrame, before: int = 2, pos: str = "pos", legacy: bool = False) -> DataFrame:
    """Place of the flagged line inside its context. The legacy value is the
    middle of the array, which is off at the edges of a log."""
    middle = F.floor(F.size("context_window") / 2).cast("int")
    return df.withColumn("root_index", middle if legacy else F.least(F.col(pos), F.lit(before)).cast("int"))


def recent_tail(lines: DataFrame, size: int = 8, pos: str = "pos") -> DataFrame:
    """The last lines in order."""
    return lines.orderBy(F.desc(pos)).limit(size).orderBy(pos)
