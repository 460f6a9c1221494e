"""Readers and writers of the record tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loghelm import schemas
from loghelm.functions.text import ISO_MICROS, is_blank, strip
from loghelm.sources.files import number_rows, read_lines

# File names of the record tables in a data folder.
CSV_NAME = "preprocessed_logs.csv"
JSONL_NAME = "preprocessed_logs.jsonl"


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def parse_embedding(cell: Column) -> Column:
    """JSON text to a vector; empty for NULL or malformed text."""
    return F.coalesce(F.from_json(cell, "array<double>"), F.array().cast("array<double>"))


def read_records(spark: SparkSession, path: str, fmt: str = "auto", limit: int | None = None) -> DataFrame:
    """Preprocessed records from CSV, JSON lines or Parquet.

    `auto` looks into a folder: the CSV file is preferred over the JSON lines.
    `limit` keeps the first records in file order (0 keeps none).
    """
    if fmt == "auto":
        found = [n for n in (CSV_NAME, JSONL_NAME) if path_exists(spark, f"{path}/{n}")]
        if not found:
            raise FileNotFoundError(f"no {CSV_NAME} or {JSONL_NAME} in {path}")
        path, fmt = f"{path}/{found[0]}", found[0].rsplit(".", 1)[1]
    if fmt == "parquet":
        records = spark.read.parquet(path)
        return records if limit is None else records.where(F.col("pos") < limit)
    if fmt == "csv":
        schema = "log_id STRING, timestamp STRING, raw_text STRING, source STRING, embedding STRING, metrics STRING"
        scan = spark.read.schema(schema).csv(
            path, header=True, enforceSchema=False, multiLine=True, escape='"'
        )
        rows = number_rows(scan, F.lit(True)) if limit is not None else scan
        records = rows.withColumns(
            {
                "embedding": parse_embedding(F.col("embedding")),
                "metrics": F.from_json("metrics", "map<string,double>"),
            }
        )
    else:
        scan = read_lines(spark, path)
        present = ~is_blank(F.col("value"))
        rows = number_rows(scan, present) if limit is not None else scan.where(present)
        # a vector may be a JSON array or a text that holds one; both are read as text
        shape = T.StructType(
            [T.StructField(f.name, T.StringType() if f.name == "embedding" else f.dataType) for f in schemas.PREPROCESSED]
        )
        parsed = F.from_json("value", shape, {"mode": "FAILFAST"})
        order = ["pos"] if limit is not None else []
        records = rows.select(parsed.alias("r"), *order).select("r.*", *order)
        vector = F.coalesce(parse_embedding(F.col("embedding")), F.array().cast("array<double>"))
        records = records.withColumn("embedding", vector)
    if limit is not None:
        records = records.where(F.col("pos") < limit)
    return records.select(*schemas.PREPROCESSED.names, *(["pos"] if limit is not None else []))


def with_metric_columns(records: DataFrame) -> DataFrame:
    return records.withColumns(
        {m: F.try_element_at("metrics", F.lit(m)) for m in ("cpu_percent", "memory_percent")}
    )


def split_by_dimension(records: DataFrame, dim: int) -> tuple[DataFrame, DataFrame]:
    """Records whose vector has `dim` finite entries, and the rejected rest."""
    finite = F.forall("embedding", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    fits = F.coalesce((F.size("embedding") == dim) & finite, F.lit(False))
    return records.where(fits), records.where(~fits)


def to_records(logs: DataFrame, metrics: Column | None = None) -> DataFrame:
    """Project a log table with vectors to the record contract."""
    metrics = F.lit(None) if metrics is None else metrics
    return logs.withColumn("metrics", metrics.cast("map<string,double>")).select(*schemas.PREPROCESSED.names)


def write_records_json(records: DataFrame, path: str) -> None:
    records.select(*schemas.PREPROCESSED.names).write.mode("overwrite").json(path)


def write_matrix(logs: DataFrame, path: str) -> None:
    """The evaluation table: vector, label, log id, block id."""
    logs.select(
        F.col("embedding").cast("array<float>").alias("embedding"),
        F.col("label").cast("int").alias("label"),
        "log_id",
        F.coalesce("block_id", F.lit("")).alias("block_id"),
    ).write.mode("overwrite").parquet(path)


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select("value").write.mode("overwrite").text(path)


def read_block_labels(spark: SparkSession, path: str) -> DataFrame:
    """Label rows in file order (`line_no`); a missing file gives an empty table."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "block_id STRING, label STRING, line_no BIGINT")
    scan = spark.read.schema(schemas.BLOCK_LABELS).csv(path, header=True)
    rows = number_rows(scan, F.lit(True))
    return rows.select(F.col("BlockId").alias("block_id"), F.col("Label").alias("label"), "line_no")


def write_block_labels(labels: DataFrame, path: str) -> bool:
    """CSV with header `BlockId,Label`; nothing is written for an empty table."""
    rows = labels.select(F.col("block_id").alias("BlockId"), F.col("label").alias("Label"))
    if rows.isEmpty():
        return False
    rows.write.mode("overwrite").csv(path, header=True)
    return True


def write_incidents(incidents: DataFrame, path: str) -> None:
    incidents.select(*schemas.INCIDENT.names).write.mode("overwrite").json(path)


def read_incidents(spark: SparkSession, path: str, form: str = "lines") -> DataFrame:
    """Incident reports: one JSON object per line (`lines`, what `write_incidents`
    writes) or one JSON array per file (`array`)."""
    if form not in ("lines", "array"):
        raise ValueError("form must be lines or array")
    reports = spark.read.schema(schemas.INCIDENT).json(path, multiLine=form == "array")
    return valid_incidents(reports)


def valid_incidents(reports: DataFrame) -> DataFrame:
    return reports.where(
        F.col("log_id").isNotNull()
        & F.col("explanation").isNotNull()
        & F.col("recommended_actions").isNotNull()
        & F.col("severity").isin(*schemas.SEVERITIES)
    )


def _json_type(value: Column, field: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant"))


def parse_feedback(lines: DataFrame, now: Column | None = None) -> DataFrame:
    """Verdict rows from JSON lines. Malformed lines and lines that break the
    contract are left out; a missing timestamp is filled with `now`."""
    now = F.date_format(F.current_timestamp() if now is None else now, ISO_MICROS)
    doc = F.col("doc")
    stamp = _json_type(doc, "timestamp")
    text = lambda f: F.try_variant_get(doc, f"$.{f}", "string")
    typed = lines.select(F.try_parse_json(strip(F.col("value"))).alias("doc"), *_order(lines)).where(
        F.schema_of_variant(doc).startswith("OBJECT")
    )
    return typed.where(
        (_json_type(doc, "log_id") == "STRING")
        & (_json_type(doc, "administrator_verdict") == "STRING")
        & text("administrator_verdict").isin(*schemas.VERDICTS)
        & (stamp.isNull() | (stamp == "STRING"))
    ).select(
        text("log_id").alias("log_id"),
        text("administrator_verdict").alias("administrator_verdict"),
        F.coalesce(text("timestamp"), now).alias("timestamp"),
        *_order(lines),
    )


def _order(lines: DataFrame) -> list[str]:
    return [c for c in ("file", "line_no", "pos") if c in lines.columns]


def read_feedback(spark: SparkSession, path: str) -> DataFrame:
    """All verdicts of a feedback log; a missing log is empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.FEEDBACK)
    lines = read_lines(spark, path)
    return parse_feedback(lines.where(~is_blank(F.col("value"))))


def append_feedback(verdicts: DataFrame, path: str) -> None:
    """Append (log_id, administrator_verdict) rows, stamped with the time of
    writing. An unknown verdict fails the write."""
    verdict = F.col("administrator_verdict")
    message = F.concat(F.lit("unknown verdict: "), F.coalesce(verdict, F.lit("NULL")))
    checked = F.when(verdict.isin(*schemas.VERDICTS), verdict).otherwise(F.raise_error(message))
    verdicts.select(
        "log_id",
        checked.alias("administrator_verdict"),
        F.date_format(F.current_timestamp(), ISO_MICROS).alias("timestamp"),
    ).write.mode("append").json(path)


