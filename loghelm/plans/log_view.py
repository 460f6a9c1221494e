"""Log tables derived from the event, document and conversation tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loghelm.functions.text import log_id, parse_lines
from loghelm.operators.models import ModelTables, calibrate, given_models, score_vectors
from loghelm.operators.labels import label_map, template_counts
from loghelm.functions.hashing import hash_embedding
from loghelm.session import fresh_path, materialize

VIEW_DIM = 64
#: Events of a task that makes and parses their lines.
ROWS_PER_TASK = 250_000
VIEW_AXES = 16
VIEW_OFFSET = 0.5
# Two small given trees: node, feature, split, left, right, rows, depth.
VIEW_TREES = (
    ((0, 5, 0.0, 1, 2, 256, 0), (1, -1, 0.0, -1, -1, 200, 1), (2, 12, -0.1, 3, 4, 56, 1),
     (3, -1, 0.0, -1, -1, 40, 2), (4, -1, 0.0, -1, -1, 16, 2)),
    ((0, 20, 0.05, 1, 2, 256, 0), (1, 33, 0.0, 3, 4, 250, 1), (2, -1, 0.0, -1, -1, 6, 1),
     (3, -1, 0.0, -1, -1, 170, 2), (4, -1, 0.0, -1, -1, 80, 2)),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows of an input that comes in fewer partitions than there are cores, or than its
    rows need at `rows_per_task`, dealt out to as many; other inputs stay where they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, math.ceil(df.count() / rows_per_task))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


# Text of the log line by event type, in the three line shapes.
HDFS_HEAD = "date_format(ts, 'yyMMdd HHmmss'), ' ', user_id + 1, ' INFO '"
STANDARD_HEAD = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), ' [', if(event_type = 'error', 'ERROR', 'INFO'), '] [svc-', user_id % 7, ']: '"
LINE_TEXT = f"""
CASE event_type
WHEN 'view' THEN concat({HDFS_HEAD},
    'dfs.FSNamesystem: BLOCK* NameSystem.allocateBlock: /user/part-', k, ' blk_', user_id * 7919)
WHEN 'click' THEN concat({HDFS_HEAD},
    'dfs.DataNode$DataXceiver: Receiving block blk_', user_id * 7919, ' src: /10.250.', user_id % 256, '.',
    event_id % 256, ':', event_id % 9000 + 50010, ' dest: /10.251.', user_id % 200, '.', k, ':50010')
WHEN 'error' THEN concat({STANDARD_HEAD}, CASE cents % 5
    WHEN 0 THEN concat('java.lang.OutOfMemoryError: Java heap space allocating ', cents, ' bytes')
    WHEN 1 THEN concat('HikariPool-1 - no connection, request timed out after ', cents, ' ms')
    WHEN 2 THEN concat('java.lang.NullPointerException in handler status=500 item ', k)
    WHEN 3 THEN concat('Deadlock found when trying to get lock, attempt ', k)
    ELSE concat('Upstream connection timeout after ', cents, ' ms') END)
WHEN 'purchase' THEN concat({STANDARD_HEAD}, 'Payment processed order ', event_id, ' status=200 duration=', k, 'ms')
ELSE concat('session 0x', lower(hex(event_id)), ' user ', user_id, ' signed up from 10.0.', user_id % 256, '.', k,
    ' in ', k, 'ms')
END
"""


def log_lines(events: DataFrame) -> DataFrame:
    """One log line per event; `line_no` is the event id."""
    numbered = events.selectExpr(
        "event_id", "ts", "user_id", "event_type",
        "cast(round(value * 100) AS BIGINT) AS cents", "regexp_extract(props, '([0-9]+)', 1) AS k",
    )
    return numbered.selectExpr(
        "'events' AS file", "event_id AS line_no", "ts", "concat('host-', user_id % 20) AS stream",
        f"{LINE_TEXT} AS value",
    )


def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log, parsed. It has no blank line and its ids run 0, 1, 2, ...,
    so the position equals the line number."""
    lines = log_lines(spread(table(spark, sf_dir, "events")))
    parsed = parse_lines(lines, ingest_ts=F.col("ts"))
    return parsed.withColumn("pos", F.col("line_no")).withColumn("log_id", log_id(F.col("line_no")))


def stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed log as a table, for work that passes over it more than once:
    each pass reads the columns it needs and parses nothing."""
    path = fresh_path(spark, "lines")
    lines = parsed_lines(spark, sf_dir)
    lines.select("log_id", "file", "line_no", "pos", "stream", "format", "raw_text", "template", "block_id").write.parquet(path)
    return spark.read.parquet(path)


def label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows: a large purchase labels its user's block, later rows overrule
    earlier ones, and users without one stay unknown."""
    events = table(spark, sf_dir, "events")
    audited = events.where((F.col("event_type") == "purchase") & (F.col("value") >= 40))
    label = F.when(F.col("value") >= 120, "Anomaly").when(F.col("value") >= 50, "Normal").otherwise("Unverified")
    return audited.select(
        F.concat(F.lit("blk_"), (F.col("user_id") * 7919).cast("string")).alias("block_id"),
        label.alias("label"),
        F.col("event_id").alias("line_no"),
    )


def block_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(label_map(label_rows(spark, sf_dir)))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The non-blank lines of every document's whole text: `file` is the
    document, `line_no` counts all its lines, `pos` the non-blank ones."""
    lines = F.transform(F.split("text", "\n"), lambda v, i: F.struct(i.cast("long").alias("line_no"), v.alias("value")))
    kept = F.filter(lines, lambda r: r["value"].rlike(r"(?U)[^\s\x1c-\x1f]"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(kept).alias("pos", "l"))
    return docs.select(F.col("doc_id").alias("file"), F.col("pos").cast("long").alias("pos"), "l.*")


def _tree_rows() -> list[tuple]:
    return [(t, *node) for t, tree in enumerate(VIEW_TREES) for node in tree]


def view_models(vectors: DataFrame, by: str) -> ModelTables:
    """Given detectors for weighted vectors: the mean vector of every group as
    a centre, the leading coordinate axes, two fixed trees; calibrated on the
    vectors."""
    spark = vectors.sparkSession
    vectors = materialize(vectors)
    cells = vectors.select(by, "n", F.posexplode_outer("embedding").alias("i", "v"))
    sums = cells.groupBy(by, "i").agg(F.sum(F.col("v") * F.col("n")).alias("s"), F.sum("n").alias("n"))
    rows = sums.orderBy(by, "i").collect()  # groups x dimensions values
    centers, total, weight = {}, [0.0] * VIEW_DIM, [0] * VIEW_DIM
    for r in rows:
        centers.setdefault(r[by], []).append(r["s"] / r["n"])
        total[r["i"]] += r["s"]
        weight[r["i"]] += r["n"]
    mean = [t / w for t, w in zip(total, weight)]
    axes = [[1.0 if i == a else 0.0 for i in range(VIEW_DIM)] for a in range(VIEW_AXES)]
    given = given_models(spark, list(centers.values()), mean, axes, _tree_rows(), VIEW_OFFSET, None)
    given.params = calibrate(materialize(score_vectors(vectors, given).drop("embedding")))
    return given


def line_models(lines: DataFrame) -> ModelTables:
    counts = template_counts(lines, "format")
    vectors = counts.withColumn("embedding", hash_embedding("template", VIEW_DIM))
    return view_models(vectors.select("format", "embedding", "n"), "format")


def embedding_models(spark: SparkSession, sf_dir: str) -> ModelTables:
    return view_models(embedding_records(spark, sf_dir).withColumn("n", F.lit(1)).select("label", "embedding", "n"), "label")


def embedding_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings table as records: id, vector, label."""
    return table(spark, sf_dir, "embeddings").select(
        log_id(F.col("vec_id")).alias("log_id"),
        F.col("vec_id").alias("pos"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        "label",
    )


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases confirm, errors dismiss."""
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "error"))
    return events.select(
        log_id(F.col("event_id")).alias("log_id"),
        F.when(F.col("event_type") == "purchase", "confirmed").otherwise("dismissed").alias("administrator_verdict"),
        "event_id",
    )


def feedback_lines(events: DataFrame) -> DataFrame:
    """Feedback log lines, good and bad ones: a numeric id, an unknown verdict
    and broken JSON must be left out; a missing time is filled."""
    return events.selectExpr(
        """CASE event_type
        WHEN 'purchase' THEN concat('{"log_id":"log_', event_id, '","administrator_verdict":"confirmed","timestamp":"',
            date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), '"}')
        WHEN 'error' THEN concat('  {"log_id":"log_', event_id, '","administrator_verdict":"dismissed","note":1}')
        WHEN 'click' THEN concat('{"log_id":', event_id, ',"administrator_verdict":"confirmed"}')
        WHEN 'view' THEN concat('{"log_id":"log_', event_id, '","administrator_verdict":"maybe"}')
        ELSE concat('{"log_id":"log_', event_id) END AS value""",
        "event_id AS line_no",
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers quoting whole documents: plain JSON, fenced JSON, JSON in
    prose, a JSON array, and plain text, by language."""
    rated = table(spark, sf_dir, "documents").selectExpr(
        "*", "CASE WHEN n_chars > 5000 THEN 'CRITICAL!' WHEN n_chars > 2000 THEN 'High' "
        "WHEN n_chars > 500 THEN 'unsure' ELSE 'low' END AS severity",
    )
    full = "to_json(named_struct('explanation', text, 'severity', severity, 'recommended_actions', array(lang, source)))"
    bare = "to_json(named_struct('severity', severity, 'recommended_actions', source))"
    return rated.selectExpr(
        "format_string('log_%07d', doc_id) AS log_id",
        f"""CASE WHEN lang = 'en' THEN {full}
        WHEN lang = 'fr' THEN concat('Here it is:\\n```json\\n', {full}, '\\n```\\n')
        WHEN lang = 'de' THEN concat('My answer is ', {bare}, ' as asked')
        WHEN n_chars > 1000 THEN concat('[', {full}, ']')
        ELSE translate(text, '{{}}', '()') END AS content""",
    )


def host_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views as metric samples of the user's host."""
    events = table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("double")
    return events.select(
        F.col("user_id").alias("host"), "ts", F.least(F.col("value"), F.lit(100.0)).alias("cpu_percent"), k.alias("memory_percent")
    )


def host_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors as incidents of the user's host."""
    events = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    return events.select(F.col("user_id").alias("host"), "ts", log_id(F.col("event_id")).alias("log_id"))
