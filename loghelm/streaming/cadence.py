"""How often a running job polls, what each poll finds and how long it takes."""

from __future__ import annotations

import threading
import time
from contextlib import suppress

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loghelm.session import parameter_table

TRIGGER_TIMES = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("started", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("trigger_ms", T.LongType()),
        T.StructField("batch_ms", T.LongType()),
    ]
)
#: Triggers held back before they are written.
FLUSH_TRIGGERS = 500


def _seen(job: StreamingQuery) -> list[tuple]:
    """The recent triggers that ran a batch, as rows of the table of times."""
    rows = []
    for p in job.recentProgress:
        took = p["durationMs"]
        if "addBatch" in took:
            rows.append((p["id"], p["batchId"], p["timestamp"], p["numInputRows"], took["triggerExecution"], took["addBatch"]))
    return rows


def follow(job: StreamingQuery, path: str, every: float = 0.2, until_idle: bool = False) -> None:
    """Wait for the job and append one row per trigger that ran a batch to the table in `path`.

    The session keeps the last `spark.sql.streaming.numRecentProgressUpdates` triggers,
    which are looked at every `every` seconds; at most `FLUSH_TRIGGERS` of
    them are held here. With `until_idle` the job is stopped once all that was there at the call is
    done; a job that fails raises its error after its times are written.
    """
    spark = SparkSession.getActiveSession()
    held: dict[int, tuple] = {}
    written = -1

    def flush() -> None:
        nonlocal written
        if held:
            parameter_table(spark, TRIGGER_TIMES, list(held.values())).coalesce(1).write.mode("append").parquet(path)
            written = max(held)
            held.clear()

    def look() -> None:
        held.update({row[1]: row for row in _seen(job) if row[1] > written})

    def finish() -> None:
        with suppress(StreamingQueryException):  # a failure is raised to the caller below
            job.processAllAvailable()
        job.stop()

    try:
        if until_idle:
            threading.Thread(target=finish, daemon=True).start()
        while job.isActive:
            look()
            if len(held) >= FLUSH_TRIGGERS:
                flush()
            time.sleep(every)
    finally:
        look()
        flush()
    job.awaitTermination()


def latency(times: DataFrame) -> DataFrame:
    """Per job: triggers that found rows, their rows, the middle and the 95th percentile of the time a
    trigger took, and rows per second of it."""
    busy = times.where(F.col("rows") > 0)
    return busy.groupBy("query").agg(
        F.count("*").alias("triggers"),
        F.sum("rows").alias("rows"),
        F.percentile("trigger_ms", 0.5).alias("p50_ms"),
        F.percentile("trigger_ms", 0.95).alias("p95_ms"),
        (F.sum("rows") * 1000 / F.sum("trigger_ms")).alias("rows_per_second"),
    )
