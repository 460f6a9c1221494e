"""Live detection: new log files in, alerts with trailing context out."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loghelm.functions.scoring import MODELS
from loghelm.functions.text import HIGHLIGHT_WORDS, drop_undecodable, has_any_word, is_blank, parse_lines
from loghelm.operators.detection import decide, load_params
from loghelm.operators.host_metrics import with_latest_metrics
from loghelm.operators.incidents import with_rule_report
from loghelm.operators.lookup import lookup
from loghelm.operators.models import ModelTables, score_texts
from loghelm.operators.triage import LEARNING_RATE, apply_verdicts, verdict_counts
from loghelm.session import materialize
from loghelm.sources.records import parse_feedback

# Fixed values of a live alert.
LIVE_THRESHOLD = 0.50
CONTEXT_SIZE = 5
#: Most lines of an Arrow batch.
FRAME_ROWS = 2_000
#: Time without lines after which a stream is forgotten.
IDLE = "7 days"
STATE_SCHEMA = "count BIGINT, held ARRAY<STRING>, alerted BOOLEAN"
ALERT_SCHEMA = "stream STRING, pos BIGINT, raw_text STRING, live_score DOUBLE, context_window ARRAY<STRING>"
# Order of a stream's lines; `raw_id` is the scan order within a batch.
LINE_ORDER = ("file_time", "file", "split_start", "raw_id")


def tail_directory(
    spark: SparkSession, path: str, max_files: int = 1_000, stream_pattern: str = r"([^/]+?)(\.[^/]*)?$"
) -> DataFrame:
    """Stream of the non-blank lines of files that appear in a folder.

    Files are complete when they appear (rotate and move). `stream` is the
    file name up to its first dot; files of a stream follow each other by time.
    """
    scan = spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
    lines = scan.select(
        drop_undecodable(F.col("value")).alias("value"),
        F.regexp_extract("_metadata.file_path", stream_pattern, 1).alias("stream"),
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
    )
    return lines.where(~is_blank(F.col("value")))


def _scan_order(lines: DataFrame) -> DataFrame:
    """Add `raw_id`, the order in which a task reads the rows (streams have no
    built-in function for it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            made = pa.array(range(number, number + batch.num_rows), pa.int64())
            number += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, "raw_id"])

    return lines.mapInArrow(run, T.StructType([*lines.schema.fields, T.StructField("raw_id", T.LongType())]))


def as_live(scored: DataFrame) -> DataFrame:
    """Alert flag and score of decided lines: a line alerts on two votes or on
    an alert word, and its score is the largest raw score."""
    return scored.drop("anomaly_score", "is_anomaly", "threshold_used").withColumns(
        {
            "live_score": F.greatest(*MODELS),
            "is_alert": (F.col("votes") >= 2) | has_any_word(F.col("raw_text")),
            "is_highlighted": has_any_word(F.col("raw_text"), HIGHLIGHT_WORDS),
        }
    )


def score_events(lines: DataFrame, models: ModelTables, dim: int = 384) -> DataFrame:
    """Score every line of a stream on its own, without state; same values as
    the scores per template of a batch."""
    return as_live(decide(score_texts(parse_lines(lines), models, dim), load_params(models.params)))


def stateful_alerts(
    scored: DataFrame, order: tuple[str, ...], first_only: bool = False, size: int = CONTEXT_SIZE, idle: str = IDLE
) -> DataFrame:
    """Alerts of a stream of scored lines (`stream`, `seeded`, order columns, `raw_text`,
    `is_alert`, `live_score`), each with the last `size` lines of its stream.

    The engine keeps, per stream, the number of its lines, the last of them and
    whether it has alerted: a batch touches the streams that have lines in it and
    no others, and a stream that says nothing for the time `idle` is forgotten. The
    engine also sorts the lines of a batch (on disk, where they are many), so that Python
    walks through a stream of any length and holds one Arrow batch of it. Seeded rows
    come first and do not alert. Start such a query with `_started`.
    """
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    by = ["seeded", "seed_pos", *order]

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        count, held, alerted = state.get if state.exists else (0, [], False)
        before = None
        for rows in frames:
            first, last = _place(rows, by, 0), _place(rows, by, -1)
            if before is not None and first < before:
                raise RuntimeError("lines of a stream came out of order")
            before = last
            given = int(rows["seeded"].sum())
            if given:
                # a seed carries its own positions
                count = int(rows["seed_pos"].iloc[:given].max()) + 1 - given
            texts = [*held, *rows["raw_text"].tolist()]
            found = rows.index[rows["is_alert"] & ~rows["seeded"]].tolist()
            if first_only:
                found = [] if alerted else found[:1]
            ends = [len(held) + i + 1 for i in found]
            if found:
                yield pd.DataFrame(
                    {
                        "stream": key[0],
                        "pos": [count + i for i in found],
                        "raw_text": [texts[e - 1] for e in ends],
                        "live_score": rows["live_score"].iloc[found].tolist(),
                        "context_window": [texts[max(0, e - size) : e] for e in ends],
                    }
                )
            count, held = count + len(rows), texts[-size:]
            alerted = bool(alerted or rows["is_alert"].any())
        state.update((count, held, alerted))
        state.setTimeoutDuration(idle_ms)

    rows = scored.select("stream", "seeded", "seed_pos", *order, "raw_text", "is_alert", "live_score")
    ascending = [F.col(c).desc() if c == "seeded" else F.col(c).asc_nulls_last() for c in by]
    placed = rows.repartition("stream").sortWithinPartitions("stream", *ascending)
    return placed.groupBy("stream").applyInPandasWithState(
        advance, ALERT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.ProcessingTimeTimeout
    )


def _place(rows: pd.DataFrame, by: list[str], i: int) -> tuple:
    """Place of a row in the order of a stream: seeded rows first, missing values last."""
    values = [rows[c].iloc[i] for c in by]
    return (not values[0], *((True, 0) if pd.isna(v) else (False, v) for v in values[1:]))


def as_alerts(found: DataFrame) -> DataFrame:
    """Found alerts in the columns of the detection contract."""
    return found.select(
        F.concat_ws("_", F.lit("live"), "stream", F.col("pos").cast("string")).alias("log_id"),
        "stream",
        "pos",
        "raw_text",
        F.round("live_score", 4).alias("anomaly_score"),
        F.lit(True).alias("is_anomaly"),
        F.lit(LIVE_THRESHOLD).alias("threshold_used"),
        "context_window",
    )


def report_alerts(alerts: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    """Alerts with the report of the rules and, where samples of host metrics
    (`stream`, `ts`, values) are given, the newest one of their stream."""
    ruled = with_rule_report(alerts, "report")
    reported = ruled.select(*alerts.columns, *[f"report.{c}" for c in ("severity", "explanation", "recommended_actions")])
    return reported if metrics is None else with_latest_metrics(reported, metrics, "stream")


def run_live_alerts(
    lines: DataFrame,
    models: ModelTables,
    out_path: str,
    checkpoint_path: str,
    order: tuple[str, ...] = LINE_ORDER,
    seed: DataFrame | None = None,
    first_only: bool = False,
    dim: int = 384,
    trigger: dict | None = None,
    reports: bool = False,
    metrics: DataFrame | None = None,
    idle: str = IDLE,
    scoring_tasks: int | None = None,
) -> StreamingQuery:
    """Start the live job on a stream of (`stream`, `value`, order columns).

    Lines are scored without state, then meet the state of their stream, which
    the engine keeps under the checkpoint; the alerts go to `out_path` exactly
    once. `seed` gives the last lines of each stream before the start (`seed_state`).
    With `reports` each alert brings its report and the newest of the `metrics`,
    a table that is read anew in every batch. `scoring_tasks` deals the lines out
    for the scoring where a source gives few, large tasks. The trigger is
    `{"processingTime": "300 milliseconds"}` or the like, by default all that
    is there, once.
    """
    placed = _scan_order(lines) if "raw_id" in order else lines
    scored = score_events(placed.repartition(scoring_tasks) if scoring_tasks else placed, models, dim)
    no_pos = F.lit(None).cast("long").alias("seed_pos")
    fresh = scored.select("stream", F.lit(False).alias("seeded"), no_pos, *order, "raw_text", "is_alert", "live_score")
    if seed is not None:
        fresh = fresh.unionByName(_seeded(seed, fresh, order, f"{checkpoint_path}-seed"))
    alerts = as_alerts(stateful_alerts(fresh, order, first_only, idle=idle))
    writer = alerts.writeStream.outputMode("append").option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    if not reports:
        return _started(lines.sparkSession, writer.format("parquet").option("path", out_path))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        report_alerts(materialize(batch), metrics).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    return _started(lines.sparkSession, writer.foreachBatch(on_batch))


def _started(spark: SparkSession, writer: DataStreamWriter) -> StreamingQuery:
    """Start a job with sorted batches and time-outs.

    The engine refuses a sort in a stream, as it can not order a stream as a whole; within the tasks of a
    batch, which is what the state needs, it can, so its check is off for the start. It would also run batch
    after batch without data, one a trigger, to look for streams whose time has passed; they pass in the next
    batch with lines. Python's reader of a state's rows holds some dozens of Arrow batches, which are small therefore."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    given = int(spark.conf.get(rows))
    settings = {
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
        "spark.sql.streaming.unsupportedOperationCheck": "false",
        rows: str(min(FRAME_ROWS, given) if given > 0 else FRAME_ROWS),
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        return writer.start()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _seeded(seed: DataFrame, fresh: DataFrame, order: tuple[str, ...], path: str) -> DataFrame:
    """The seed as rows of the first batch, in order of their positions."""
    seed.write.mode("ignore").parquet(path)
    rows = seed.sparkSession.readStream.schema(seed.schema).parquet(path)
    kinds = {f.name: f.dataType for f in fresh.schema}
    return rows.select(
        "stream", F.lit(True).alias("seeded"), F.col("pos").alias("seed_pos"),
        *(F.lit(None).cast(kinds[c]).alias(c) for c in order),
        "raw_text", F.lit(False).alias("is_alert"), F.lit(0.0).alias("live_score"),
    )


def seed_state(lines: DataFrame, size: int = CONTEXT_SIZE) -> DataFrame:
    """The last `size` of the lines (`stream`, `pos`, `raw_text`) that are there
    already, by the newest position of each stream (no sort of the stream)."""
    ends = materialize(lines.groupBy("stream").agg(F.max("pos").alias("end")))
    kept = lookup(lines, ends, "stream", ("pos",))
    return kept.where(F.col("pos") > F.col("end") - size).select("stream", "pos", "raw_text")


def running_verdicts(feedback_lines: DataFrame) -> DataFrame:
    """Triage counts over a stream of feedback lines (complete output mode)."""
    return verdict_counts(parse_feedback(feedback_lines))


def run_threshold(
    verdicts: DataFrame,
    model_path: str,
    checkpoint_path: str,
    order: str,
    rate: float = LEARNING_RATE,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the job that moves the stored cutoff as verdicts (`order`,
    `administrator_verdict`) arrive, `order` being unique. A batch costs what its verdicts cost."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        apply_verdicts(materialize(batch), batch_id, model_path, order, rate)

    writer = verdicts.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_path)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def quiet_period(alerts: DataFrame, ts: str = "event_ts", period: str = "1 hour") -> DataFrame:
    """Let one alert per stream through, then none for the period (streams of
    alerts with an event time)."""
    return alerts.withWatermark(ts, period).dropDuplicatesWithinWatermark(["stream"])
