"""Line order for file scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loghelm.functions.text import drop_undecodable, is_blank
from loghelm.operators.lookup import broadcast_if_small
from loghelm.session import materialize


def read_lines(spark, path: str | list[str]) -> DataFrame:
    """One row per text line; a missing path raises."""
    return spark.read.text(path).withColumn("value", drop_undecodable(F.col("value")))


def number_rows(scan: DataFrame, keep: Column, one_log: bool = False) -> DataFrame:
    """Give the rows of a file scan their place in their file.

    Adds `file`, `line_no` (0-based, every row counts) and `pos` (0-based,
    counting kept rows only) and returns the rows to `keep`. With `one_log` the
    files are parts of one log: numbers run on from file to file in name order.

    Every split counts its rows in a first pass; sums over the splits (one row
    per split) give each split its first number, and the second pass adds the
    place inside the split. Nothing is sorted or shuffled but the split table.
    The two passes must cut the files alike: the split's start, length and task
    are part of the join, and a split unknown to the first pass raises. The split table is broadcast
    up to the usual size; `line_index` numbers longer logs without a join.
    """
    split = ["file", "split_start", "split_length", "task"]
    tagged = scan.select(
        *scan.columns,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.col("_metadata.file_block_length").alias("split_length"),
    ).withColumn("raw_id", F.monotonically_increasing_id())
    tagged = tagged.withColumn("task", F.shiftright("raw_id", 33))

    counted = tagged.groupBy(*split).agg(
        F.count("*").alias("n_lines"),
        F.count_if(keep).alias("n_kept"),
        F.min("raw_id").alias("first_raw"),
    )
    log = F.lit(1) if one_log else F.col("file")
    in_file = Window.partitionBy(log).orderBy("file", "split_start").rowsBetween(Window.unboundedPreceding, -1)
    in_task = Window.partitionBy("task").orderBy("first_raw").rowsBetween(Window.unboundedPreceding, -1)
    task_base = F.shiftleft("task", 33)
    offsets = (
        counted.withColumns(
            {
                "line_base": F.coalesce(F.sum("n_lines").over(in_file), F.lit(0)),
                "pos_base": F.coalesce(F.sum("n_kept").over(in_file), F.lit(0)),
                "first_kept": task_base + F.coalesce(F.sum("n_kept").over(in_task), F.lit(0)),
            }
        )
        .select(*split, "first_raw", "first_kept", "line_base", "pos_base")
    )
    offsets = broadcast_if_small(materialize(offsets))

    kept = tagged.where(keep).withColumn("kept_id", F.monotonically_increasing_id())
    known = F.when(F.col("line_base").isNull(), F.raise_error(F.lit("file splits changed between passes")))
    return (
        kept.join(offsets, split, "left")
        .withColumn("line_no", F.coalesce(known, F.col("line_base") + F.col("raw_id") - F.col("first_raw")))
        .withColumn("pos", F.col("pos_base") + F.col("kept_id") - F.col("first_kept"))
        .withColumn("file", F.regexp_extract("file", "^(.*)/[^/]*$", 1) if one_log else F.col("file"))
        .select(*scan.columns, "file", "line_no", "pos")
    )


def read_numbered_lines(
    spark, path: str | list[str], max_records: int | None = None, one_log: bool = False
) -> DataFrame:
    """Non-blank lines with their place in the file. `max_records` counts raw
    lines, blank ones too; None and 0 mean all."""
    lines = number_rows(read_lines(spark, path), ~is_blank(F.col("value")), one_log)
    return lines.where(F.col("line_no") < max_records) if max_records else lines
