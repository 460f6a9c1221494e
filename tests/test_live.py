import time
import weakref

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loghelm.functions.text import parse_lines
from loghelm.operators.detection import score_lines
from loghelm.operators.models import fit
from loghelm.operators.vectors import template_vectors
from loghelm.streaming.live import as_live, quiet_period, report_alerts, run_live_alerts, running_verdicts, score_events, seed_state, stateful_alerts, tail_directory

DIM = 16


def log(stream, n, faults):
    return [f"2024-02-03T08:20:11Z [ERROR] [svc]: HikariPool-1 lost {stream} {i}" if i in faults else f"{stream} line {i} ok step{i % 5}" for i in range(n)]


LOGS = {"web": log("web", 40, {3, 17, 39}), "db": log("db", 23, {0, 11}), "idle": log("idle", 6, set())}


@pytest.fixture(scope="module")
def models(spark):
    rows = [(t,) for lines in LOGS.values() for t in lines]
    parsed = parse_lines(spark.createDataFrame(rows, "value string"))
    fitted = fit(template_vectors(parsed, DIM), n_clusters=2, ae_latent_dim=2)
    fitted.params = fitted.params.withColumn("threshold", F.lit(9.0))  # only alert words alert
    return fitted


def put(folder, stream, part, lines):
    (folder / f"{stream}.{part}.log").write_text("\n".join(lines) + "\n\n")
    time.sleep(0.02)


def expected(first_only=False, start=0):
    out = {}
    for stream, lines in LOGS.items():
        for i, line in enumerate(lines):
            if i >= start and "HikariPool" in line:
                out[f"live_{stream}_{i}"] = lines[max(0, i - 4) : i + 1]
                if first_only:
                    break
    return out


@pytest.mark.parametrize("first_only", [False, True])
def test_alerts_over_several_batches(spark, models, tmp_path, first_only):
    """Files arrive between runs; context and positions carry over."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    paths = [str(tmp_path / p) for p in ("out", "checkpoint")]
    for part in range(4):
        for stream, lines in LOGS.items():
            size = -(-len(lines) // 4)
            put(inbox, stream, part, lines[part * size : (part + 1) * size])
        run_live_alerts(tail_directory(spark, str(inbox)), models, *paths, first_only=first_only, dim=DIM).awaitTermination()
    rows = spark.read.parquet(paths[0]).collect()
    assert {r["log_id"]: r["context_window"] for r in rows} == expected(first_only)
    assert {r["threshold_used"] for r in rows} == {0.5}
    assert all(r["is_anomaly"] for r in rows)


def test_seeded_start(spark, models, tmp_path):
    """Lines present at the start give context but no alerts."""
    seen = [(s, i, t) for s, lines in LOGS.items() for i, t in enumerate(lines[:10])]
    seed = seed_state(spark.createDataFrame(seen, "stream string, pos long, raw_text string"))
    assert seed.count() == 5 + 5 + 5
    inbox = tmp_path / "in"
    inbox.mkdir()
    for stream, lines in LOGS.items():
        put(inbox, stream, 0, lines[10:] or [""])
    paths = [str(tmp_path / p) for p in ("out", "checkpoint")]
    run_live_alerts(tail_directory(spark, str(inbox)), models, *paths, seed=seed, dim=DIM).awaitTermination()
    rows = spark.read.parquet(paths[0]).collect()
    assert {r["log_id"].replace("idle", "") for r in rows} == set(expected(start=10))
    by_id = {r["log_id"]: r["context_window"] for r in rows}
    assert by_id["live_db_11"] == LOGS["db"][7:12]


def test_silent_streams_are_forgotten(spark, models, tmp_path):
    """A stream without lines for the idle time starts anew; one that goes on keeps its place.
    The state lies under the checkpoint alone."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    paths = [str(tmp_path / p) for p in ("out", "checkpoint")]
    run = lambda: run_live_alerts(tail_directory(spark, str(inbox)), models, *paths, dim=DIM, idle="4 seconds").awaitTermination()
    put(inbox, "web", 0, LOGS["web"][:4])
    put(inbox, "db", 0, LOGS["db"][:2])
    run()
    time.sleep(5)
    put(inbox, "idle", 0, ["tick"])  # a batch in which the others time out
    run()
    put(inbox, "web", 1, LOGS["web"][17:18])
    run()
    rows = {r["log_id"]: r["context_window"] for r in spark.read.parquet(paths[0]).collect()}
    assert set(rows) == {"live_web_3", "live_db_0", "live_web_0"} - ({"live_db_1"} if "lost" not in LOGS["db"][1] else set())
    assert rows["live_web_0"] == LOGS["web"][17:18] and rows["live_web_3"] == LOGS["web"][:4]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["checkpoint", "in", "out"]


def test_restart_after_a_failed_batch(spark, models, tmp_path):
    """A batch that is run again after its state was written leaves each alert once."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    paths = [str(tmp_path / p) for p in ("out", "checkpoint")]
    run = lambda: run_live_alerts(tail_directory(spark, str(inbox)), models, *paths, dim=DIM).awaitTermination()
    put(inbox, "web", 0, LOGS["web"][:20])
    run()
    put(inbox, "web", 1, LOGS["web"][20:])
    run()
    last = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))[-1]
    for kept in (last, last.parent / f".{last.name}.crc"):
        kept.unlink(missing_ok=True)
    run()
    rows = spark.read.parquet(paths[0]).collect()
    assert sorted(r["log_id"] for r in rows) == sorted(k for k in expected() if "web" in k)


def test_stream_scores_equal_batch_scores(spark, models, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    for stream, lines in LOGS.items():
        put(inbox, stream, 0, lines)
    scored = score_events(tail_directory(spark, str(inbox)), models, DIM).select("raw_text", "live_score", "is_alert", "is_highlighted")
    job = scored.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "o"))
    job.trigger(availableNow=True).start().awaitTermination()
    streamed = {tuple(r) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    lines = [("f", i, t) for i, t in enumerate(t for v in LOGS.values() for t in v)]
    parsed = parse_lines(spark.createDataFrame(lines, "file string, line_no long, value string"))
    batch = as_live(score_lines(parsed, models, dim=DIM)).select("raw_text", "live_score", "is_alert", "is_highlighted")
    assert streamed == {tuple(r) for r in batch.collect()}


def test_reports_of_alerts(spark):
    alerts = spark.createDataFrame(
        [("live_a_1", "a", 0.75, ["worker", "no heap space"]), ("live_b_1", "b", 0.5, ["quiet"])],
        "log_id string, stream string, anomaly_score double, context_window array<string>",
    )
    samples = [("a", 1, 10.0, 20.0), ("a", 5, 30.0, 40.0), ("a", 5, 35.0, 1.0), ("c", 9, 1.0, 1.0)]
    metrics = spark.createDataFrame(samples, "stream string, ts long, cpu_percent double, memory_percent double")
    rows = {r["log_id"]: r for r in report_alerts(alerts, metrics).collect()}
    assert (rows["live_a_1"]["severity"], rows["live_a_1"]["cpu_percent"], rows["live_a_1"]["memory_percent"]) == ("critical", 35.0, 1.0)
    assert (rows["live_b_1"]["severity"], rows["live_b_1"]["cpu_percent"]) == ("medium", None)
    assert "0.5000" in rows["live_b_1"]["explanation"]
    assert report_alerts(alerts).columns[-3:] == ["severity", "explanation", "recommended_actions"]


def test_running_verdicts(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.jsonl").write_text('{"log_id":"a","administrator_verdict":"confirmed"}\n{"log_id":"b","administrator_verdict":"dismissed"}\nbad\n')
    counts = running_verdicts(spark.readStream.text(str(inbox)))
    job = counts.writeStream.outputMode("complete").format("memory").queryName("verdicts_now").start()
    job.processAllAvailable()
    assert tuple(spark.table("verdicts_now").first()) == (2, 1, 1)
    (inbox / "b.jsonl").write_text('{"log_id":"c","administrator_verdict":"dismissed"}\n')
    job.processAllAvailable()
    job.stop()
    assert tuple(spark.table("verdicts_now").first()) == (3, 1, 2)


def test_quiet_period(spark, tmp_path):
    rows = [("a", "2026-01-01 00:00:00"), ("a", "2026-01-01 00:10:00"), ("b", "2026-01-01 00:20:00")]
    spark.createDataFrame(rows, "stream string, t string").selectExpr("stream", "cast(t as timestamp) event_ts").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("stream string, event_ts timestamp").parquet(str(tmp_path / "in"))
    job = quiet_period(source).writeStream.outputMode("append").format("memory").queryName("quiet").start()
    job.processAllAvailable()
    job.stop()
    assert sorted(r["stream"] for r in spark.table("quiet").collect()) == ["a", "b"]


class Plan:
    """A table whose steps return itself, and the function that is to run on the state."""

    def __getattr__(self, name):
        return lambda *args: args[0] if name == "applyInPandasWithState" else self


class State:
    exists = hasTimedOut = False

    def update(self, value):
        self.value = value

    def setTimeoutDuration(self, ms):
        pass


def test_a_stream_is_walked_through_frame_by_frame():
    """Of the lines of a stream in one batch no more than two frames are held at a time."""
    texts = [f"line {i}" for i in range(50)]
    held, most = [], []

    def frames():
        for a in range(0, 50, 5):
            alive = [f for f in held if f() is not None]
            most.append(len(alive))
            frame = pd.DataFrame({"seeded": False, "seed_pos": None, "line_no": range(a, a + 5), "raw_text": texts[a : a + 5],
                                  "is_alert": [False, True, False, False, False], "live_score": 0.5})
            held.append(weakref.ref(frame))
            yield frame
            del frame

    state = State()
    found = []
    for part in stateful_alerts(Plan(), ("line_no",))(("web",), frames(), state):
        found += zip(part["pos"], part["context_window"])
        del part
    assert found == [(i, texts[max(0, i - 4) : i + 1]) for i in range(1, 50, 5)]
    assert state.value == (50, texts[-5:], True)
    assert max(most) <= 2


def test_lines_of_a_batch_that_comes_in_many_frames(spark, models, tmp_path):
    """Many files of a stream in one batch, dealt to tasks at random, read as Arrow batches of three rows."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    for part in range(8):
        for stream, lines in LOGS.items():
            put(inbox, stream, part, lines[part * 5 : part * 5 + 5] if part < 7 else lines[35:])
    paths = [str(tmp_path / p) for p in ("out", "checkpoint")]
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        job = run_live_alerts(tail_directory(spark, str(inbox)), models, *paths, dim=DIM, scoring_tasks=7)
        job.awaitTermination()
    finally:
        spark.conf.set(key, before)
    assert spark.conf.get("spark.sql.streaming.unsupportedOperationCheck", "true") == "true"
    rows = spark.read.parquet(paths[0]).collect()
    assert {r["log_id"]: r["context_window"] for r in rows} == expected() and len(rows) == len(expected())
