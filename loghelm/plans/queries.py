"""The operators bound to the given tables, one function per query."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import replace
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loghelm.functions.scoring import centroid_distance, reconstruction_error
from loghelm.functions.text import ALERT_WORDS, HIGHLIGHT_WORDS, has_any_word, parse_lines, sanitize
from loghelm.operators import clusters, context, detection, evaluation, forest, host_metrics, incidents
from loghelm.operators import labels as labelling
from loghelm.operators import models as detectors
from loghelm.operators import ordering, queue, selection, subspace, triage, vectors
from loghelm.plans import jobs
from loghelm.plans import log_view as view
from loghelm.session import fresh_path, materialize, parameter_table
from loghelm.sources import growing, line_index, parameters, records
from loghelm.sources.files import read_numbered_lines
from loghelm.streaming import as_of, cadence, live

QUERIES = {}
DIM = view.VIEW_DIM


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def joined(col: str, by: str = "\n"):
    return F.array_join(col, by)


# --- parsing ---------------------------------------------------------------


@query
def template_report(spark: SparkSession, sf: str) -> DataFrame:
    """Templates by line count with level and source (flagship)."""
    return labelling.template_counts(view.parsed_lines(spark, sf), "level", "source", "format").orderBy(
        F.desc("n"), "template", "level", "source"
    )


@query
def parsed_fields(spark: SparkSession, sf: str) -> DataFrame:
    return view.parsed_lines(spark, sf).select(
        "log_id", "timestamp", "level", "source", "raw_text", "message", "template", "block_id", "format"
    )


@query
def document_line_templates(spark: SparkSession, sf: str) -> DataFrame:
    """Raw-branch parsing of all document lines; blank lines dropped but counted."""
    return parse_lines(view.document_lines(spark, sf), ingest_ts=F.lit("2024-01-01").cast("timestamp")).select(
        "file", "line_no", "pos", "format", "level", "source", "block_id", F.md5("template").alias("template_md5")
    )


@query
def sanitized_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = view.table(spark, sf, "documents").select("doc_id", sanitize(F.col("text")).alias("t"))
    return docs.select("doc_id", F.length("t").cast("long").alias("chars"), F.md5("t").alias("text_md5"))


@query
def unique_template_count(spark: SparkSession, sf: str) -> DataFrame:
    return labelling.unique_templates(view.parsed_lines(spark, sf))


@query
def numbered_text_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Write the event log as text files and read it back as one numbered log."""
    path = fresh_path(spark, "text-log")
    lines = view.log_lines(view.table(spark, sf, "events"))
    ordered = lines.repartitionByRange("line_no").sortWithinPartitions("line_no")
    records.write_lines(ordered, path)
    return read_numbered_lines(spark, path, one_log=True).select("line_no", "pos", "value")


def _log_with_blank_lines(spark: SparkSession, sf: str) -> str:
    """The event log as text files, a blank line behind every third line."""
    path = fresh_path(spark, "blank-log")
    lines = view.log_lines(view.table(spark, sf, "events"))
    copies = F.when(F.col("line_no") % 3 == 1, F.array("value", F.lit("  "))).otherwise(F.array("value"))
    rows = lines.select("line_no", F.posexplode(copies).alias("part", "value"))
    order = ("line_no", "part")
    records.write_lines(rows.repartitionByRange(*order).sortWithinPartitions(*order), path)
    return path


@query
def indexed_text_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Text files with blank lines, numbered by their stored line index."""
    path, place = _log_with_blank_lines(spark, sf), fresh_path(spark, "line-index")
    line_index.save_index(line_index.build_index(spark, path, range_bytes=1 << 20, one_log=True), place)
    lines = line_index.indexed_lines(line_index.load_index(spark, place))
    return lines.select("line_no", "pos", "value")


@query
def first_indexed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Records among the first 1,000 raw lines, blank ones counting, without reading on."""
    path = _log_with_blank_lines(spark, sf)
    lines = line_index.read_first_lines(spark, path, 1000, range_bytes=1 << 16, one_log=True)
    return lines.select("line_no", "pos", "value")


@query
def first_raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    """First 25 raw lines of every document, blank lines counting."""
    lines = view.document_lines(spark, sf).where(F.col("line_no") < 25)
    return lines.select("file", "line_no", "pos", F.md5("value").alias("value_md5"))


@query
def first_records(spark: SparkSession, sf: str) -> DataFrame:
    """First 25 records (non-blank lines) of every document."""
    lines = view.document_lines(spark, sf).where(F.col("pos") < 25)
    return lines.select("file", "line_no", "pos", F.md5("value").alias("value_md5"))


# --- labels ----------------------------------------------------------------


@query
def block_label_map(spark: SparkSession, sf: str) -> DataFrame:
    return labelling.label_map(view.label_rows(spark, sf))


@query
def labelled_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = labelling.label_lines(view.parsed_lines(spark, sf), view.block_labels(spark, sf))
    return lines.select("log_id", "block_id", "label_text", "label")


@query
def labelled_lines_salted(spark: SparkSession, sf: str) -> DataFrame:
    """The same join the way it runs when the labels are too many to broadcast."""
    lines = labelling.label_lines(view.parsed_lines(spark, sf), view.block_labels(spark, sf), broadcast_bytes=0)
    return lines.select("log_id", "block_id", "label_text", "label")


@query
def preprocessing_summary(spark: SparkSession, sf: str) -> DataFrame:
    lines = labelling.label_lines(view.parsed_lines(spark, sf), view.block_labels(spark, sf))
    return labelling.preprocessing_summary(lines, vectors.template_vectors(lines, DIM))


@query
def label_class_balance(spark: SparkSession, sf: str) -> DataFrame:
    lines = labelling.label_lines(view.parsed_lines(spark, sf), view.block_labels(spark, sf))
    return evaluation.class_balance(lines)


def _sample(spark: SparkSession, sf: str):
    lines = view.log_lines(view.table(spark, sf, "events"))
    return labelling.sample_first_lines(lines, view.block_labels(spark, sf), num_lines=2500)


@query
def sampled_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _sample(spark, sf)[0].select("line_no", "value")


@query
def sampled_block_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Through the label file: written as CSV and read back."""
    path = fresh_path(spark, "sample-labels")
    records.write_block_labels(_sample(spark, sf)[1], path)
    return records.read_block_labels(spark, path).select("block_id", "label")


@query
def sample_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _sample(spark, sf)[2]


# --- vectors ---------------------------------------------------------------


@query
def hashed_template_vectors(spark: SparkSession, sf: str) -> DataFrame:
    vecs = vectors.template_vectors(view.parsed_lines(spark, sf), DIM)
    cells = vecs.select("template", "n", F.posexplode_outer("embedding").alias("bin", "value"))
    return cells.where(F.col("value") != 0).withColumn("value", F.round("value", 6))


@query
def record_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Records with vector, written as JSON lines and read back in file order."""
    path = fresh_path(spark, "records")
    lines = view.parsed_lines(spark, sf)
    wide = vectors.with_vectors(lines, DIM)
    metrics = F.create_map(F.lit("cpu_percent"), (F.col("line_no") % 100).cast("double"))
    records.write_records_json(records.to_records(wide, metrics), path)
    back = records.with_metric_columns(records.read_records(spark, path, "jsonl"))
    total = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + F.abs(v))
    return back.select(
        "log_id", "timestamp", "raw_text", "source", "cpu_percent", F.size("embedding").alias("dim"),
        F.round(total, 4).alias("abs_sum"),
    )


@query
def parsed_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors through their JSON text form, with the dimension check."""
    table = view.embedding_records(spark, sf).withColumn("cell", F.to_json("embedding"))
    cell = F.when(F.col("label") == 3, F.lit("not json")).when(F.col("label") == 4, F.lit(None)).otherwise(F.col("cell"))
    parsed = table.withColumn("embedding", records.parse_embedding(cell))
    good, bad = records.split_by_dimension(parsed, DIM)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + F.abs(v))
    tagged = good.withColumn("fits", F.lit(True)).unionByName(bad.withColumn("fits", F.lit(False)))
    return tagged.select("log_id", "fits", F.size("embedding").alias("dim"), F.round(total, 4).alias("abs_sum"))


@query
def rejected_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Distances of the vectors that fit the models; short, empty and long ones come back as rejects."""
    label, vector = F.col("label"), F.col("embedding").cast("array<double>")
    bent = (
        F.when(label == 3, F.slice(vector, 1, DIM - 1))
        .when(label == 4, F.array().cast("array<double>"))
        .when(label == 5, F.concat(vector, vector))
        .otherwise(vector)
    )
    table, models = view.embedding_records(spark, sf).withColumn("embedding", bent), view.embedding_models(spark, sf)
    scored = detection.score_records(table, models).select("log_id", F.lit(True).alias("fits"), F.round("kmeans", 6).alias("distance"))
    rest = detection.rejected_records(table, models)
    return scored.unionByName(rest.select("log_id", F.lit(False).alias("fits"), F.lit(None).cast("double").alias("distance")))


@query
def queue_score_text(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the event log with three digits, ties included, as the queue shows them."""
    scores = spark.read.parquet(f"{sf}/events.parquet").select("event_id", (F.col("event_id") % 1001 / 1000).alias("value"))
    return scores.select("event_id", queue.two_digits(F.col("value")).alias("score"))


@query
def csv_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records with the vector as JSON text in a CSV cell, read back."""
    path = fresh_path(spark, "csv-records")
    table = view.embedding_records(spark, sf)
    table.select(
        "log_id", F.lit("t").alias("timestamp"), F.concat(F.lit('say "'), "log_id", F.lit('", twice')).alias("raw_text"),
        F.lit("s").alias("source"), F.to_json("embedding").alias("embedding"), F.lit(None).cast("string").alias("metrics"),
    ).write.csv(path, header=True, escape='"')
    total = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + F.abs(v))
    back = records.read_records(spark, path, "csv")
    return back.select("log_id", "raw_text", F.size("embedding").alias("dim"), F.round(total, 4).alias("abs_sum"))


@query
def jsonl_text_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Records as JSON lines whose vector is a text that holds a JSON array."""
    path = fresh_path(spark, "jsonl-records")
    row = F.struct("log_id", F.lit("t").alias("timestamp"), F.to_json("embedding").alias("embedding"))
    view.embedding_records(spark, sf).select(F.to_json(row)).write.text(path)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + F.abs(v))
    back = records.read_records(spark, path, "jsonl")
    return back.select("log_id", F.size("embedding").alias("dim"), F.round(total, 4).alias("abs_sum"))


@query
def loaded_records(spark: SparkSession, sf: str) -> DataFrame:
    """A data folder with a CSV and a JSON-lines table: the CSV table is the one read."""
    path = fresh_path(spark, "data")
    rows = view.embedding_records(spark, sf).select(
        "log_id", F.lit("t").alias("timestamp"), F.lit("from csv").alias("raw_text"), F.lit("s").alias("source"),
        F.to_json("embedding").alias("embedding"), F.lit(None).cast("string").alias("metrics"),
    )
    rows.write.csv(f"{path}/{records.CSV_NAME}", header=True, escape='"')
    rows.withColumn("raw_text", F.lit("from json")).write.json(f"{path}/{records.JSONL_NAME}")
    return records.read_records(spark, path).select("log_id", "raw_text", F.size("embedding").alias("dim"))


@query
def evaluation_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors and labels written as the evaluation table, read back."""
    path = fresh_path(spark, "matrix")
    lines = labelling.label_lines(view.parsed_lines(spark, sf), view.block_labels(spark, sf))
    records.write_matrix(vectors.with_vectors(lines, DIM), path)
    return spark.read.parquet(path).select("log_id", "block_id", "label", F.size("embedding").alias("dim"))


# --- scores with given parameters ------------------------------------------


@query
def nearest_centroid_distance(spark: SparkSession, sf: str) -> DataFrame:
    models = view.embedding_models(spark, sf)
    distance = centroid_distance(F.col("embedding"), clusters.centers_of(models.centroids))
    return view.embedding_records(spark, sf).select("log_id", F.round(distance, 6).alias("distance"))


@query
def reconstruction_errors(spark: SparkSession, sf: str) -> DataFrame:
    models = view.embedding_models(spark, sf)
    error = reconstruction_error(F.col("embedding"), *subspace.mean_and_axes(models.pca))
    return view.embedding_records(spark, sf).select("log_id", F.round(error, 7).alias("error"))


@query
def forest_scores(spark: SparkSession, sf: str) -> DataFrame:
    models = view.embedding_models(spark, sf)
    score = forest.isolation(F.col("embedding"), forest.Forest(models.forest.toPandas()))
    return view.embedding_records(spark, sf).select("log_id", F.round(score, 6).alias("score"))


@query
def score_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    params = view.embedding_models(spark, sf).params
    return params.select("model", *[F.round(c, 6).alias(c) for c in detection.PARAM_FIELDS])


@query
def line_score_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    """Thresholds of the event log, each template weighted by its lines."""
    params = view.line_models(view.parsed_lines(spark, sf)).params
    return params.select("model", *[F.round(c, 6).alias(c) for c in detection.PARAM_FIELDS])


@query
def value_percentile(spark: SparkSession, sf: str) -> DataFrame:
    """95th percentile of all event values, found by histograms of their bits."""
    values = view.table(spark, sf, "events").withColumn("n", F.lit(1))
    p = selection.weighted_percentiles(values, ("value",), "n", 95.0, finish_rows=100)["value"]
    return values.agg(F.count("*").alias("n"), F.round(F.max(F.lit(p)), 6).alias("p95"))


def _embedding_detections(spark: SparkSession, sf: str, model: str) -> DataFrame:
    return detection.score_records(view.embedding_records(spark, sf), view.embedding_models(spark, sf), model)


def _decision(spark: SparkSession, sf: str, model: str) -> DataFrame:
    return _embedding_detections(spark, sf, model).select(
        "log_id", "votes", "is_anomaly", "anomaly_score",
        "threshold_used",
    )


@query
def ensemble_decisions(spark: SparkSession, sf: str) -> DataFrame:
    return _decision(spark, sf, "ensemble")


@query
def forest_decisions(spark: SparkSession, sf: str) -> DataFrame:
    return _decision(spark, sf, "isolation_forest")


@query
def kmeans_decisions(spark: SparkSession, sf: str) -> DataFrame:
    return _decision(spark, sf, "kmeans")


@query
def autoencoder_decisions(spark: SparkSession, sf: str) -> DataFrame:
    return _decision(spark, sf, "autoencoder")


@query
def fallback_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges and normalised thresholds that the parameter table lacks come from the scored batch."""
    models = view.embedding_models(spark, sf)
    bare = models.params.withColumns({c: F.lit(None).cast("double") for c in ("norm_threshold", "s_min", "s_max")})
    table = view.embedding_records(spark, sf)
    scored = materialize(detectors.score_vectors(table, models))
    decided = detection.decide(scored, detection.load_params(bare, scored))
    return decided.select("log_id", "votes", "is_anomaly", "anomaly_score", "threshold_used")


@query
def stored_models(spark: SparkSession, sf: str) -> DataFrame:
    """Parameters of models that were saved and loaded."""
    path = fresh_path(spark, "models")
    view.embedding_models(spark, sf).save(path)
    params = detectors.ModelTables.load(spark, path).params
    return params.select("model", *[F.round(c, 6).alias(c) for c in detection.PARAM_FIELDS])


# --- the event log, detected ------------------------------------------------


def _detected(spark: SparkSession, sf: str) -> DataFrame:
    lines = view.stored_lines(spark, sf)
    return detection.detect(lines, view.line_models(lines), dim=DIM)


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    lines = view.stored_lines(spark, sf)
    return detection.score_lines(lines, view.line_models(lines), dim=DIM)


@query
def detected_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Detection contract for every line of the event log."""
    return _detected(spark, sf).select(
        "log_id", "anomaly_score", "is_anomaly",
        "threshold_used", joined("context_window").alias("context"),
    )


@query
def detected_lines_salted(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions looked up the way they are with too many templates to broadcast."""
    lines = view.stored_lines(spark, sf)
    scored = detection.score_lines(lines, view.line_models(lines), dim=DIM, broadcast_bytes=0, rows_per_salt=50)
    return scored.select("log_id", "votes", "is_anomaly", "anomaly_score")


@query
def context_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Two lines before and after; chunks kept short so that many edges occur."""
    lines = context.with_context(view.parsed_lines(spark, sf), rows_per_chunk=1_000)
    marked = context.with_root_index(lines).withColumn("root", F.col("context_window")[F.col("root_index")])
    return marked.select(
        "log_id", joined("context_window").alias("context"), "root_index", (F.col("root") == F.col("raw_text")).alias("root_is_line")
    )


@query
def legacy_root_index(spark: SparkSession, sf: str) -> DataFrame:
    lines = context.with_context(view.document_lines(spark, sf), text="value")
    marked = context.with_root_index(lines, legacy=True)
    return marked.select("file", "pos", F.size("context_window").alias("n"), "root_index")


@query
def anomaly_contexts(spark: SparkSession, sf: str) -> DataFrame:
    """Context of the flagged lines only."""
    lines = view.stored_lines(spark, sf)
    scored = detection.score_lines(lines, view.line_models(lines), dim=DIM)
    flagged = materialize(scored.where("is_anomaly").select("log_id", "file", "pos"))
    found = context.context_of(flagged, lines)
    return found.select("log_id", joined("context_window").alias("context"))


@query
def trailing_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Last five turns up to each turn of a conversation."""
    turns = ordering.dense_positions(view.table(spark, sf, "conversations"), "turn", ("conv_id",))
    lines = context.with_trailing_context(turns, ("conv_id",), text="text")
    return lines.select("conv_id", "turn", F.md5(joined("context_window")).alias("context_md5"))


@query
def recent_lines(spark: SparkSession, sf: str) -> DataFrame:
    tail = context.recent_tail(view.parsed_lines(spark, sf))
    return tail.select("line_no", "raw_text", has_any_word(F.col("raw_text"), HIGHLIGHT_WORDS).alias("is_highlighted"))


@query
def keyword_alerts(spark: SparkSession, sf: str) -> DataFrame:
    lines = view.parsed_lines(spark, sf)
    return lines.select(
        "log_id", has_any_word(F.col("raw_text"), ALERT_WORDS).alias("is_alert"),
        has_any_word(F.col("raw_text"), HIGHLIGHT_WORDS).alias("is_highlighted"),
    ).where("is_alert or is_highlighted")


@query
def incident_queue(spark: SparkSession, sf: str) -> DataFrame:
    return queue.incident_queue(_scored(spark, sf))


@query
def queue_search(spark: SparkSession, sf: str) -> DataFrame:
    return queue.search(_scored(spark, sf).where("is_anomaly"), "LOG_00001").select("log_id")


@query
def top_incidents(spark: SparkSession, sf: str) -> DataFrame:
    return queue.top_incidents(_embedding_detections(spark, sf, "ensemble"))


@query
def key_figures(spark: SparkSession, sf: str) -> DataFrame:
    figures = queue.key_figures(_scored(spark, sf), triage.verdict_counts(view.verdicts(spark, sf)))
    return figures.withColumn("deviation_percent", F.round("deviation_percent", 4))


@query
def anomaly_rate(spark: SparkSession, sf: str) -> DataFrame:
    return queue.anomaly_rate(_scored(spark, sf)).select(F.round("anomaly_rate", 6).alias("anomaly_rate"))


@query
def detector_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Precision to AUC of the three detectors and the vote against block labels."""
    log = view.stored_lines(spark, sf)
    models = view.line_models(log)
    scored = detection.score_lines(log, models, dim=DIM)
    lines = labelling.label_lines(scored, view.block_labels(spark, sf))
    thresholds = {m: p["threshold"] for m, p in detection.load_params(models.params).items()}
    quality = evaluation.evaluate(lines, thresholds)
    return quality.select(
        "name", "tn", "fp", "fn", "tp", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "accuracy", "auc")]
    )


@query
def document_length_auc(spark: SparkSession, sf: str) -> DataFrame:
    """AUC of document length and of toxicity for the quality label."""
    docs = view.table(spark, sf, "documents").join(view.table(spark, sf, "labels"), "doc_id")
    rows = F.array(
        F.struct(F.lit("length").alias("model"), F.col("n_chars").cast("double").alias("score")),
        F.struct(F.lit("toxic").alias("model"), F.col("toxic").cast("double").alias("score")),
    )
    long = docs.select(F.col("quality").alias("label"), F.lit(1).alias("n"), F.inline(rows))
    return evaluation.roc_auc(long, rows_per_range=50).withColumn("auc", F.round("auc", 6))


# --- incidents ---------------------------------------------------------------


@query
def rule_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Rule-based report of every line from its context."""
    lines = context.with_context(view.parsed_lines(spark, sf)).withColumn("anomaly_score", F.col("line_no") / 7.0)
    reports = incidents.diagnose(lines)
    return reports.select(
        "log_id", "severity", "explanation", F.size("recommended_actions").alias("n_actions"),
        joined("retrieved_context").alias("known_pattern"),
    )


@query
def anomaly_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Reports of the first 40 anomalies in log order."""
    reports = incidents.diagnose_batch(_detected(spark, sf), limit=40)
    return reports.select("log_id", "severity", joined("retrieved_context").alias("known_pattern"))


@query
def two_log_batch_limit(spark: SparkSession, sf: str) -> DataFrame:
    """The event log dealt to two logs: the first 40 anomalies by log and place in it."""
    lines = view.stored_lines(spark, sf)
    dealt = lines.withColumn("file", F.format_string("log-%d", F.col("line_no") % 2)).withColumn(
        "pos", F.floor(F.col("line_no") / 2)
    )
    found = detection.detect(dealt, view.line_models(lines), dim=DIM)
    return incidents.diagnose_batch(found, limit=40).select("log_id")


@query
def prompt_table(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts of the anomalies; the instructions by whether they ask for the report's fields."""
    prompts = jobs.prompt_table(_detected(spark, sf))
    asks = F.lit(True)
    for field in ("explanation", "severity", "recommended_actions"):
        asks = asks & F.col("system").contains(field)
    return prompts.select("log_id", "prompt", asks.alias("asks_for_fields"))


@query
def answered_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Reports from supplied answers; lines without a usable one use the rules."""
    lines = context.with_context(view.parsed_lines(spark, sf)).withColumn("anomaly_score", F.lit(0.5))
    reports = incidents.diagnose(lines, materialize(view.answers(spark, sf)))
    return reports.select(
        "log_id", "severity", F.md5("explanation").alias("explanation_md5"), joined("recommended_actions").alias("actions"),
        joined("retrieved_context").alias("known_pattern"),
    )


@query
def stored_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Anomalies with their stored report: written, read back, one per id."""
    path = fresh_path(spark, "incidents")
    found = _detected(spark, sf).where("is_anomaly")
    reports = incidents.diagnose(found)
    records.write_incidents(reports.unionByName(reports), path)
    stored = materialize(records.read_incidents(spark, path))
    return incidents.with_reports(found, stored).select("log_id", "severity")


@query
def analysis_prompts(spark: SparkSession, sf: str) -> DataFrame:
    lines = context.with_context(view.parsed_lines(spark, sf))
    cpu = F.create_map(F.lit("cpu_percent"), (F.col("line_no") % 100 + 0.5))
    metrics = F.when(F.col("format") != "raw", cpu)
    prompt = incidents.analysis_prompt(F.col("log_id"), F.col("context_window"), F.col("line_no") / 7.0, metrics)
    return lines.select("log_id", prompt.alias("prompt"))


# --- feedback ----------------------------------------------------------------


@query
def accepted_feedback(spark: SparkSession, sf: str) -> DataFrame:
    lines = view.feedback_lines(view.table(spark, sf, "events"))
    return records.parse_feedback(lines, now=F.lit("2024-02-01").cast("timestamp")).drop("line_no")


@query
def verdict_counts(spark: SparkSession, sf: str) -> DataFrame:
    return triage.verdict_counts(view.verdicts(spark, sf))


@query
def feedback_log_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Verdicts appended to a log twice, then read and counted."""
    path = fresh_path(spark, "feedback")
    verdicts = view.verdicts(spark, sf)
    records.append_feedback(verdicts.where("administrator_verdict = 'confirmed'"), path)
    records.append_feedback(verdicts, path)
    return triage.verdict_counts(records.read_feedback(spark, path))


@query
def adapted_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return triage.adapt_threshold(view.verdicts(spark, sf), 0.5, rate=0.001)


@query
def replayed_threshold(spark: SparkSession, sf: str) -> DataFrame:
    found = triage.replay_threshold(view.verdicts(spark, sf), "event_id", rate=0.0001, rows_per_chunk=300)
    return found.select("total", "threshold")


@query
def persisted_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    """The stored cutoff after the feedback log was applied twice."""
    model, log = fresh_path(spark, "model"), fresh_path(spark, "feedback")
    start = parameter_table(spark, records.schemas.MODEL_SETTINGS, [("contamination", 0.05)])
    parameters.publish(spark, model, {"settings": start})
    records.append_feedback(view.verdicts(spark, sf), log)
    for _ in range(2):
        triage.persist_adapted_cutoff(spark, model, log, rate=0.001)
    return parameters.read_tables(spark, model, ("settings",))[1]["settings"]


@query
def metrics_at_incident(spark: SparkSession, sf: str) -> DataFrame:
    found = host_metrics.metrics_as_of(
        view.host_incidents(spark, sf), view.host_metrics(spark, sf), rows_per_range=2_000
    )
    return found.select("log_id", "host", "cpu_percent", "memory_percent")


@query
def streamed_metrics_at_incident(spark: SparkSession, sf: str) -> DataFrame:
    """The as-of join of two streams in three runs: a tenth of the samples and a seventh of the
    incidents of the middle's last days arrive a run late; a last sample moves the time on."""
    incidents, samples = view.host_incidents(spark, sf), view.host_metrics(spark, sf)
    low, high = samples.agg(F.min("ts"), F.max("ts")).first()
    middle = low + (high - low) / 2
    day = F.expr("INTERVAL 1 DAY")

    def late(ts, name, share, days):
        return (ts >= F.lit(middle) - days * day) & (F.pmod(F.xxhash64(ts, name), F.lit(share)) == 0)

    parts, paths = [], [fresh_path(spark, f"as-of-{n}") for n in ("incidents", "samples", "out", "mark")]
    for table, name, share, days in ((incidents, "log_id", 7, 3), (samples, "cpu_percent", 10, 1)):
        first = (F.col("ts") < F.lit(middle)) & ~late(F.col("ts"), name, share, days)
        end = table.limit(0)
        if table is samples:
            end = samples.select(F.lit(-1).cast(samples.schema["host"].dataType).alias("host"), F.lit(high + (high - low)).cast(samples.schema["ts"].dataType).alias("ts"), F.lit(0.0).alias("cpu_percent"), F.lit(0.0).alias("memory_percent")).limit(1)
        parts.append((table, (table.where(first), table.where(~first), end)))
    for run in range(3):
        for (_, pieces), path in zip(parts, paths):
            pieces[run].write.mode("append").parquet(path)
        streams = [spark.readStream.schema(table.schema).parquet(path) for (table, _), path in zip(parts, paths)]
        as_of.run_metrics_as_of(*streams, *paths[2:], delay="2 days", keep="4 days", idle="1000 days").awaitTermination()
    return spark.read.parquet(paths[2]).select("log_id", "host", "cpu_percent", "memory_percent")


@query
def latest_host_metrics(spark: SparkSession, sf: str) -> DataFrame:
    found = host_metrics.with_latest_metrics(view.host_incidents(spark, sf), view.host_metrics(spark, sf))
    return found.select("log_id", "host", "cpu_percent", "memory_percent")


# --- fitted models -----------------------------------------------------------


@query
def fitted_forest(spark: SparkSession, sf: str) -> DataFrame:
    records_ = view.embedding_records(spark, sf)
    vecs = materialize(vectors.distinct_vectors(records_).withColumn("key", F.xxhash64("embedding")))
    return forest.fit_forest(vecs, vecs.agg(F.sum("n")).first()[0])


@query
def fitted_centers(spark: SparkSession, sf: str) -> DataFrame:
    centroids = clusters.fit_kmeans(materialize(vectors.distinct_vectors(view.embedding_records(spark, sf))))
    return centroids.select("cluster", F.posexplode("center").alias("i", "value"))


@query
def fitted_axes(spark: SparkSession, sf: str) -> DataFrame:
    axes = subspace.fit_pca(vectors.distinct_vectors(view.embedding_records(spark, sf)), 32)
    return axes.select("axis", F.posexplode("vector").alias("i", "value"))


@query
def fitted_detections(spark: SparkSession, sf: str) -> DataFrame:
    """Fit on the event log's templates, store, load, detect every line."""
    lines = view.stored_lines(spark, sf)
    path = fresh_path(spark, "models")
    detectors.fit(vectors.template_vectors(lines, DIM), ae_latent_dim=16).save(path)
    models = detectors.ModelTables.load(spark, path)
    found = detection.detect(lines, models, dim=DIM)
    return found.select("log_id", "anomaly_score", "is_anomaly", "threshold_used", joined("context_window").alias("context"))


@query
def forest_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """What any isolation forest keeps: rows at the root, in the leaves, at every split, and the depth."""
    nodes = materialize(fitted_forest(spark, sf))
    child = lambda side: nodes.select("tree", F.col("node").alias(side), F.col("n").alias(f"{side}_n"))
    full = nodes.join(child("left"), ["tree", "left"], "left").join(child("right"), ["tree", "right"], "left")
    inner = F.col("feature") >= 0
    kept = F.coalesce(F.col("left_n") + F.col("right_n") == F.col("n"), F.lit(False))
    return full.groupBy("tree").agg(
        F.max(F.when(F.col("node") == 0, F.col("n"))).cast("long").alias("root_rows"),
        F.sum(F.when(~inner, F.col("n"))).cast("long").alias("leaf_rows"),
        F.count_if(inner & ~kept).alias("broken_splits"),
        (F.max("depth") <= 8).alias("depth_kept"),
    )


@query
def center_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """Every fitted centre is the mean of the vectors nearest to it."""
    vecs = materialize(vectors.distinct_vectors(view.embedding_records(spark, sf)))
    centers = clusters.centers_of(clusters.fit_kmeans(vecs))

    @F.pandas_udf("int")
    def nearest(batch):
        x = np.stack(batch.to_numpy())
        squares = np.stack([((x - c) ** 2).sum(axis=1) for c in centers])
        return batch.__class__(squares.argmin(axis=0))

    cells = vecs.select(nearest("embedding").alias("cluster"), "n", F.posexplode("embedding").alias("i", "v"))
    means = cells.groupBy("cluster", "i").agg(F.sum("n").alias("n"), (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean"))
    fitted = [(c, i, float(v)) for c, row in enumerate(centers) for i, v in enumerate(row)]
    off = means.join(spark.createDataFrame(fitted, "cluster int, i int, center double"), ["cluster", "i"])
    return off.agg(
        F.count_distinct("cluster").alias("n_centers"),
        F.sum(F.when(F.col("i") == 0, F.col("n"))).alias("n_members"),
        (F.max(F.abs(F.col("mean") - F.col("center"))) < 1e-3).alias("centers_are_means"),
    )


@query
def axis_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """Mean, variance kept by the axes plus the rest, and how far the axes are from orthonormal."""
    vecs = materialize(vectors.distinct_vectors(view.embedding_records(spark, sf)))
    mean, axes = subspace.mean_and_axes(subspace.fit_pca(vecs, 32))

    @F.pandas_udf("double")
    def kept(batch):
        return batch.__class__((((np.stack(batch.to_numpy()) - mean) @ axes.T) ** 2).sum(axis=1))

    spread = kept("embedding") + reconstruction_error(F.col("embedding"), mean, axes) * len(mean)
    weighted = vecs.select("n", spread.alias("v")).agg((F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("v"))
    variance = weighted.select(F.lit("variance").alias("what"), F.lit(0).alias("i"), F.round("v", 5).alias("value"))
    skew = float(np.abs(axes @ axes.T - np.eye(len(axes))).max())
    rows = [("mean", i, float(v)) for i, v in enumerate(mean)] + [("skew", 0, skew)]
    given = spark.createDataFrame(rows, "what string, i int, value double")
    return variance.unionByName(given.withColumn("value", F.abs(F.round("value", 5))))


@query
def detection_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """Fitted thresholds against the scores of all lines: each is their 95th percentile,
    zero for the forest, and flags at least one line in twenty."""
    vecs = materialize(vectors.template_vectors(view.stored_lines(spark, sf), DIM))
    models = detectors.fit(vecs, ae_latent_dim=16)
    scored = materialize(detectors.score_vectors(vecs, models).select("n", *detection.MODELS))
    cells = scored.select("n", F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("score")) for m in detection.MODELS])))
    joined = cells.join(models.params.select("model", "threshold"), "model")
    above = F.sum(F.when(F.col("score") >= F.col("threshold"), F.col("n")))
    off = F.abs(F.percentile("score", 0.95, F.col("n")) - F.max("threshold"))
    return joined.groupBy("model").agg(
        F.sum("n").alias("n_lines"),
        (above >= 0.05 * F.sum("n") - 1).alias("flags_a_twentieth"),
        (off < 1e-9).alias("threshold_is_percentile"),
        ((F.first("model") != "isolation_forest") | (F.abs(F.max("threshold")) < 1e-9)).alias("forest_at_zero"),
    )


# --- streams -----------------------------------------------------------------


def _events_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = view.table(spark, sf, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*")


def _live(spark: SparkSession, sf: str, first_only: bool) -> DataFrame:
    out, mark = (fresh_path(spark, f"live-{part}") for part in ("alerts", "checkpoint"))
    models = view.line_models(view.parsed_lines(spark, sf))
    lines = view.log_lines(_events_stream(spark, sf))
    job = live.run_live_alerts(
        lines, models, out, mark, order=("line_no",), first_only=first_only, dim=DIM,
        scoring_tasks=spark.sparkContext.defaultParallelism,
    )
    job.awaitTermination()
    return spark.read.parquet(out).select(
        "log_id", "stream", "anomaly_score", "threshold_used",
        joined("context_window").alias("context"),
    )


@query
def live_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Streamed lines: vote or alert word, last five lines of the stream."""
    return _live(spark, sf, first_only=False)


@query
def live_first_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return _live(spark, sf, first_only=True)


@query
def scored_events(spark: SparkSession, sf: str) -> DataFrame:
    """Every line scored on its own, the way a stream without state does it."""
    models = view.line_models(view.parsed_lines(spark, sf))
    scored = live.score_events(view.log_lines(view.spread(view.table(spark, sf, "events"))), models, DIM)
    return scored.select("line_no", "votes", F.round("live_score", 6).alias("live_score"), "is_alert", "is_highlighted")


def _live_files(spark: SparkSession, sf: str, **options) -> DataFrame:
    """Alerts of a folder with one text file per host, found in several triggers."""
    logs, out, mark = (fresh_path(spark, f"live-{part}") for part in ("logs", "alerts", "checkpoint"))
    lines = view.log_lines(view.table(spark, sf, "events"))
    by_host = lines.repartition("stream").sortWithinPartitions("stream", "line_no")
    by_host.select("stream", "value").write.partitionBy("stream").text(logs)
    models = view.line_models(view.parsed_lines(spark, sf))
    files = live.tail_directory(spark, f"{logs}/stream=*", max_files=8, stream_pattern="stream=([^/]+)/")
    live.run_live_alerts(files, models, out, mark, dim=DIM, **options).awaitTermination()
    return spark.read.parquet(out)


@query
def live_text_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of text files that appear in a folder."""
    return _live_files(spark, sf).select(
        "log_id", "stream", "anomaly_score", "threshold_used", joined("context_window").alias("context")
    )


def _append_by_stream(lines: DataFrame, folder: str) -> None:
    """Append the lines to one text file per stream, the last one without its end, which
    the next call puts there. A task that runs again cuts its files back first."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, open_stream = None, None
        for batch in batches:
            rows = zip(batch.column("stream").to_pylist(), batch.column("value").to_pylist())
            for stream, own in groupby(rows, key=itemgetter(0)):
                if file is None or stream != open_stream:
                    if file:
                        file.close()
                    path, mark, open_stream = f"{folder}/{stream}.log", f"{folder}/.{stream}.end", stream
                    before = int(open(mark).read()) if os.path.exists(mark) else 0
                    file = open(path, "r+b" if before else "wb")
                    file.truncate(before)
                    file.seek(before)
                    start = b"\n" if before else b""
                file.write(start + "\n".join([value for _, value in own]).encode())
                start = b"\n"
        if file:
            file.close()
        yield from ()

    placed = lines.repartition("stream").sortWithinPartitions("stream", "line_no")
    placed.select("stream", "value").mapInArrow(write, "done BOOLEAN").collect()  # no rows come back


@query
def growing_file_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of files that are appended to between two runs of the live job, the last
    line of each cut in between."""
    logs, out, mark = (fresh_path(spark, f"live-{part}") for part in ("logs", "alerts", "checkpoint"))
    folder = re.sub("^file:/+", "/", logs)
    os.makedirs(folder, exist_ok=True)
    models = view.line_models(view.parsed_lines(spark, sf))
    lines = view.log_lines(view.table(spark, sf, "events"))
    middle = F.col("line_no") < (lines.agg(F.max("line_no")).first()[0] or 0) // 2
    for part in (lines.where(middle), lines.where(~middle)):
        _append_by_stream(part, folder)
        for name in os.listdir(folder):
            if name.endswith(".log"):
                with open(f"{folder}/.{name[:-4]}.end", "w") as file:
                    file.write(str(os.path.getsize(f"{folder}/{name}")))
        tail = growing.tail_growing(spark, f"file://{folder}")
        live.run_live_alerts(tail, models, out, mark, order=growing.GROWING_ORDER, dim=DIM).awaitTermination()
    for name in os.listdir(folder):
        if name.endswith(".log"):
            with open(f"{folder}/{name}", "ab") as file:
                file.write(b"\n")
    tail = growing.tail_growing(spark, f"file://{folder}")
    live.run_live_alerts(tail, models, out, mark, order=growing.GROWING_ORDER, dim=DIM).awaitTermination()
    return spark.read.parquet(out).select(
        "log_id", "stream", "anomaly_score", "threshold_used", joined("context_window").alias("context")
    )


@query
def live_alert_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts with their report and the newest metrics of their host."""
    samples = view.host_metrics(spark, sf).withColumn("stream", F.concat(F.lit("host-"), F.col("host") % 20)).drop("host")
    found = _live_files(spark, sf, reports=True, metrics=samples)
    return found.select("log_id", "severity", "explanation", "cpu_percent", "memory_percent")


@query
def live_verdict_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Triage counts kept up to date by a stream of feedback lines."""
    out, mark = fresh_path(spark, "verdict-counts"), fresh_path(spark, "checkpoint")
    counts = live.running_verdicts(view.feedback_lines(_events_stream(spark, sf)))
    write = lambda batch, _: batch.write.mode("overwrite").parquet(out)
    job = counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", mark)
    job.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


@query
def live_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """The cutoff that a stream of verdicts carries on, four appended parts one after the
    other, each in a run of its own that reads the new part only."""
    inbox, model, mark = (fresh_path(spark, f"verdict-{part}") for part in ("inbox", "model", "checkpoint"))
    verdicts = view.verdicts(spark, sf).select("event_id", "administrator_verdict")
    newest = verdicts.agg(F.max("event_id")).first()[0] or 0
    part = F.least(F.floor(F.col("event_id") * 4 / (newest + 1)), F.lit(3))
    for i in range(4):
        verdicts.where(part == i).write.mode("append").json(inbox)
        stream = spark.readStream.schema(verdicts.schema).json(inbox)
        live.run_threshold(stream, model, mark, "event_id", rate=0.0001).awaitTermination()
    _, settings = triage.stored_settings(spark, model)
    row = [(int(settings["verdict_total"]), settings["consensus_cutoff"])]
    return spark.createDataFrame(row, "total long, threshold double")


def polled_times(spark: SparkSession, sf: str) -> DataFrame:
    """The times of a live job that polls a folder on a clock, eight files a poll."""
    logs, out, mark, times = (fresh_path(spark, f"poll-{part}") for part in ("logs", "alerts", "checkpoint", "times"))
    lines = view.log_lines(view.table(spark, sf, "events"))
    lines.repartition("stream").select("stream", "value").write.partitionBy("stream").text(logs)
    models = view.line_models(view.parsed_lines(spark, sf))
    files = live.tail_directory(spark, f"{logs}/stream=*", max_files=8, stream_pattern="stream=([^/]+)/")
    job = live.run_live_alerts(files, models, out, mark, dim=DIM, trigger={"processingTime": "300 milliseconds"})
    cadence.follow(job, times, until_idle=True)
    return spark.read.parquet(times)


@query
def live_trigger_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Polls that found lines, the lines they scored, and whether each poll's time was recorded."""
    return polled_times(spark, sf).where("rows > 0").agg(
        F.countDistinct("batch_id").alias("polls"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("lines"),
        F.coalesce(F.min(F.col("trigger_ms") > 0), F.lit(True)).alias("timed"),
    )


__all__ = ["QUERIES"]
