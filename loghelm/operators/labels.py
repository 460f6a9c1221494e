"""Block labels: label map, labelled lines, summaries, first-lines sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loghelm.functions.text import block_id, encode_label
from loghelm.operators.lookup import lookup
from loghelm.schemas import UNKNOWN_LABEL


def label_map(label_rows: DataFrame) -> DataFrame:
    """One row per block; of several the last one counts."""
    return label_rows.groupBy("block_id").agg(F.max_by("label", "line_no").alias("label"))


def label_lines(
    lines: DataFrame, labels: DataFrame, spread: tuple[str, ...] = ("file", "line_no"), **options
) -> DataFrame:
    """Add `label_text` (Unknown without a label) and the encoded `label`."""
    table = labels.select("block_id", F.col("label").alias("label_text"))
    joined = lookup(lines, table, "block_id", spread, **options)
    joined = joined.withColumn("label_text", F.coalesce("label_text", F.lit(UNKNOWN_LABEL)))
    return joined.withColumn("label", encode_label(F.col("label_text")))


def preprocessing_summary(labelled: DataFrame, vectors: DataFrame) -> DataFrame:
    """Total, size of the `vectors` (0 without any), and lines by label class
    (one row). Lines without a block are unknown."""
    some = vectors.select(F.size("embedding").alias("dim")).first()  # all have one size: the rest is not embedded
    dim = 0 if some is None else some["dim"]
    return labelled.agg(
        F.count("*").alias("total_records"),
        F.lit(dim).alias("embedding_dim"),
        F.count_if(F.col("label") == 0).alias("normal_records"),
        F.count_if(F.col("label") == 1).alias("anomaly_records"),
        F.count_if(F.col("label") == -1).alias("unknown_records"),
    )


def sample_first_lines(lines: DataFrame, labels: DataFrame, num_lines: int = 25_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """First raw lines of each file, the labels of the blocks in them, and a
    one-row summary. `lines` carries `value` and `line_no`, blank lines too.

    Lines without a block count in no label class.
    """
    sample = lines.where(F.col("line_no") < num_lines)
    found = sample.select(block_id(F.col("value")).alias("block_id"))
    counted = found.groupBy("block_id").agg(F.count("*").alias("n"))  # one row per block from here on
    labelled = counted.join(labels.select("block_id", "label"), "block_id", "left").withColumn(
        "label", F.coalesce("label", F.lit(UNKNOWN_LABEL))
    )
    has_block, label = F.col("block_id").isNotNull(), F.col("label")
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    summary = labelled.agg(
        count(F.lit(True)).alias("sampled_lines"),
        count(has_block & (label == "Normal")).alias("normal_lines"),
        count(has_block & (label == "Anomaly")).alias("anomaly_lines"),
        count(has_block & ~label.isin("Normal", "Anomaly")).alias("unknown_lines"),
        F.count("block_id").alias("unique_blocks"),
    )
    return sample, labelled.where(has_block).select("block_id", "label"), summary


def template_counts(lines: DataFrame, *by: str) -> DataFrame:
    """Lines per distinct template (partial counts before the shuffle)."""
    return lines.groupBy("template", *by).agg(F.count("*").alias("n"))


def unique_templates(lines: DataFrame, approximate: bool = False) -> DataFrame:
    if approximate:
        return lines.agg(F.approx_count_distinct("template").alias("unique_templates"))
    return lines.agg(F.count_distinct("template").alias("unique_templates"))
