"""The jobs end to end: preprocess, train, detect, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loghelm.functions.hashing import DEFAULT_DIM, hash_embedding
from loghelm.functions.text import log_id, parse_lines
from loghelm.operators.context import context_of
from loghelm.operators.detection import detect, load_params, score_lines
from loghelm.operators.evaluation import evaluate
from loghelm.operators.incidents import SYSTEM_TEXT, analysis_prompt, diagnose_batch
from loghelm.operators.labels import label_lines, label_map, preprocessing_summary, sample_first_lines
from loghelm.operators.lookup import lookup
from loghelm.operators.models import ModelTables, fit
from loghelm.operators.vectors import template_vectors
from loghelm.session import materialize
from loghelm.sources import line_index
from loghelm.sources.files import number_rows, read_lines, read_numbered_lines
from loghelm.sources.records import (
    read_block_labels,
    to_records,
    write_block_labels,
    write_lines,
    write_matrix,
    write_records_json,
)


def parsed_log(
    spark: SparkSession,
    path: str | list[str],
    max_records: int | None = None,
    ingest_ts: Column | None = None,
    accept_offsets: bool = False,
    index_path: str | None = None,
) -> DataFrame:
    """Numbered and parsed lines of one log or several. With several files the
    ids carry the file name, as line numbers start anew in each. Lines are read by
    the line index of `index_path` (see `index_log`) where one is given, and
    the first `max_records` without reading on where `line_index` reaches the files."""
    if index_path:
        lines = line_index.indexed_lines(line_index.load_index(spark, index_path), max_records)
    elif max_records and line_index.reaches(spark, path):
        lines = line_index.read_first_lines(spark, path, max_records)
    else:
        lines = read_numbered_lines(spark, path, max_records)
    parsed = parse_lines(lines, ingest_ts=ingest_ts, accept_offsets=accept_offsets).drop("value")
    single = line_index.list_files(spark, path).limit(2).count() <= 1
    name = F.regexp_extract("file", r"([^/]+)$", 1)
    ids = log_id(F.col("line_no"))
    return parsed.withColumn("log_id", ids if single else F.concat_ws(":", name, ids))


def index_log(spark: SparkSession, path: str | list[str], index_path: str) -> None:
    """Store or refresh the line index of a log; unchanged files are not read again."""
    try:
        index = line_index.refreshed_index(spark, line_index.load_index(spark, index_path), path)
    except FileNotFoundError:
        index = line_index.build_index(spark, path)
    line_index.save_index(index, index_path)


def preprocess(
    spark: SparkSession,
    raw_path: str | list[str],
    label_path: str | None,
    out_path: str,
    max_records: int | None = None,
    ingest_ts: Column | None = None,
    accept_offsets: bool = False,
    dim: int = DEFAULT_DIM,
    index_path: str | None = None,
) -> dict[str, int]:
    """Parse and label a log once into `out_path/lines` (narrow: the vector of
    a line is a function of its template), with the distinct templates, their
    counts and vectors in `out_path/templates`. Returns the summary."""
    parsed = parsed_log(spark, raw_path, max_records, ingest_ts, accept_offsets, index_path)
    if label_path:
        labels = label_map(read_block_labels(spark, label_path))
    else:
        labels = spark.createDataFrame([], "block_id STRING, label STRING")
    label_lines(parsed, materialize(labels)).write.mode("overwrite").parquet(f"{out_path}/lines")
    lines = spark.read.parquet(f"{out_path}/lines")
    template_vectors(lines, dim).write.mode("overwrite").parquet(f"{out_path}/templates")
    return preprocessing_summary(lines, spark.read.parquet(f"{out_path}/templates")).first().asDict()


def export_records(spark: SparkSession, out_path: str, json_path: str, matrix_path: str) -> None:
    """The wide record tables (a vector per line), for consumers that need them."""
    lines = spark.read.parquet(f"{out_path}/lines")
    templates = spark.read.parquet(f"{out_path}/templates")
    counts = templates.select("template", "n")
    wide = lookup(lines, templates.drop("n"), "template", ("file", "line_no"), counts=counts)
    write_records_json(to_records(wide), json_path)
    write_matrix(wide, matrix_path)


def record_of(lines: DataFrame, text: str, dim: int = DEFAULT_DIM, metrics: Column | None = None) -> DataFrame:
    """Record contract for rows with an id, time, source and a text to embed."""
    return to_records(lines.withColumn("embedding", hash_embedding(text, dim)), metrics)


def train(spark: SparkSession, out_path: str, model_path: str, **settings) -> ModelTables:
    """Fit the detectors on the templates of a preprocessed log and store them."""
    fit(spark.read.parquet(f"{out_path}/templates"), **settings).save(model_path)
    return ModelTables.load(spark, model_path)


def detect_log(
    spark: SparkSession, out_path: str, model_path: str, model: str = "ensemble", limit: int | None = None,
    dim: int = DEFAULT_DIM,
) -> DataFrame:
    lines = spark.read.parquet(f"{out_path}/lines")
    return detect(lines, ModelTables.load(spark, model_path), model, limit, dim)


def sample_job_files(
    spark: SparkSession, raw_path: str | list[str], label_path: str, out_path: str, num_lines: int = 25_000
) -> dict[str, int]:
    """Write the first raw lines of each log and the labels of their blocks into
    `out_path/log` and `out_path/labels`. Returns the summary."""
    lines = number_rows(read_lines(spark, raw_path), F.lit(True))
    labels = materialize(label_map(read_block_labels(spark, label_path)))
    sample, blocks, summary = sample_first_lines(lines, labels, num_lines)
    order = ("file", "line_no")
    write_lines(materialize(sample).repartitionByRange(*order).sortWithinPartitions(*order), f"{out_path}/log")
    write_block_labels(blocks, f"{out_path}/labels")
    return summary.first().asDict()


def evaluation_report(spark: SparkSession, out_path: str, model_path: str, dim: int = DEFAULT_DIM) -> DataFrame:
    """Quality of the three detectors and of the vote on a preprocessed and
    labelled log, one row each."""
    models = ModelTables.load(spark, model_path)
    scored = score_lines(spark.read.parquet(f"{out_path}/lines"), models, dim=dim)
    thresholds = {m: p["threshold"] for m, p in load_params(models.params).items()}
    return evaluate(scored, thresholds)


def prompt_table(detections: DataFrame, metrics: Column | None = None) -> DataFrame:
    """What a model is asked about each anomaly: instructions and question.
    `metrics` is a map of host figures by name."""
    prompt = analysis_prompt(F.col("log_id"), F.col("context_window"), F.col("anomaly_score"), metrics)
    return detections.where("is_anomaly").select("log_id", F.lit(SYSTEM_TEXT).alias("system"), prompt.alias("prompt"))


def incident_reports(
    spark: SparkSession, out_path: str, model_path: str, answers: DataFrame | None = None,
    limit: int | None = None, dim: int = DEFAULT_DIM,
) -> DataFrame:
    """Reports of all anomalies. Only they get a context, so the cost of the
    windows follows the anomalies and not the log."""
    lines = spark.read.parquet(f"{out_path}/lines")
    scored = score_lines(lines, ModelTables.load(spark, model_path), dim=dim)
    flagged = scored.where("is_anomaly").select("log_id", "file", "pos", "anomaly_score", "is_anomaly", "threshold_used")
    flagged = materialize(flagged)
    return diagnose_batch(context_of(flagged, lines), answers, limit)
