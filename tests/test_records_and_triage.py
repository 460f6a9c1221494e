import json
import random

import pytest
from pyspark.sql import functions as F

from loghelm import schemas
from loghelm.operators.host_metrics import metrics_as_of, with_latest_metrics
from loghelm.operators.triage import (
    adapt_threshold, persist_adapted_cutoff, publish_settings, replay_threshold, stored_settings, verdict_counts,
)
from loghelm.plans import log_view
from loghelm.plans.jobs import record_of
from loghelm.sources.parameters import PLAIN
from loghelm.sources.records import append_feedback, read_feedback, read_records, split_by_dimension, with_metric_columns, write_records_json


def feedback(spark, confirmed, dismissed):
    rows = [(f"log_{i}", "confirmed" if i < confirmed else "dismissed", i) for i in range(confirmed + dismissed)]
    return spark.createDataFrame(rows, "log_id string, administrator_verdict string, at long")


# --- records ---


def test_record_contract_round_trip(spark, tmp_path):
    line = spark.createDataFrame(
        [("line-7", "2025-02-11T06:31:07Z", "Lease renewed on blk_88", "node-c", "Lease renewed on <BLOCK>")],
        "log_id string, timestamp string, raw_text string, source string, template string",
    )
    metrics = F.create_map(F.lit("cpu_percent"), F.lit(3.25), F.lit("memory_percent"), F.lit(71.5))
    record = record_of(line, "template", 64, metrics)
    assert record.columns == schemas.PREPROCESSED.names
    write_records_json(record, str(tmp_path / "r"))
    back = read_records(spark, str(tmp_path / "r"), "jsonl")
    assert back.collect() == record.collect()
    assert len(back.first()["embedding"]) == 64
    assert with_metric_columns(back).first()["memory_percent"] == 71.5


def write_folder(folder, csv=True):
    records = [{"log_id": f"j{i}", "timestamp": "t", "raw_text": "r", "source": "s", "embedding": [i, 0.5], "metrics": None} for i in range(5)]
    text = "\n".join(json.dumps(r) for r in records[:2]) + "\n\n  \n" + "\n".join(json.dumps(r) for r in records[2:]) + "\n"
    (folder / "preprocessed_logs.jsonl").write_text(text)
    if csv:
        rows = ["log_id,timestamp,raw_text,source,embedding,metrics"]
        rows += ['c0,t,"a, ""quoted""\nsecond line",s,"[0.25, 2]",', "c1,t,r,s,not json,", "c2,t,r,s,,"]
        (folder / "preprocessed_logs.csv").write_text("\n".join(rows) + "\n")


def test_csv_is_preferred(spark, tmp_path):
    write_folder(tmp_path)
    rows = {r["log_id"]: r for r in read_records(spark, str(tmp_path)).collect()}
    assert rows["c0"]["embedding"] == [0.25, 2.0] and rows["c0"]["raw_text"] == 'a, "quoted"\nsecond line'
    assert rows["c1"]["embedding"] == [] and rows["c2"]["embedding"] == []
    assert {r["log_id"] for r in read_records(spark, str(tmp_path), limit=2).collect()} == {"c0", "c1"}


def test_json_lines_and_limit(spark, tmp_path):
    write_folder(tmp_path, csv=False)
    assert read_records(spark, str(tmp_path)).count() == 5
    assert {r["log_id"] for r in read_records(spark, str(tmp_path), limit=3).collect()} == {"j0", "j1", "j2"}
    assert read_records(spark, str(tmp_path), limit=0).count() == 0


def test_no_record_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_records(spark, str(tmp_path))


def test_dimension_check(spark):
    rows = [("a", [1.0, 2.0]), ("b", [1.0]), ("c", []), ("d", None), ("e", [1.0, None]), ("f", [1.0, float("nan")])]
    df = spark.createDataFrame(rows, "log_id string, embedding array<double>")
    good, bad = split_by_dimension(df, 2)
    assert [r["log_id"] for r in good.collect()] == ["a"]
    assert {r["log_id"] for r in bad.collect()} == set("bcdef")


# --- feedback ---


def test_saved_feedback(spark, tmp_path):
    path = str(tmp_path / "feedback")
    assert read_feedback(spark, path).count() == 0
    append_feedback(feedback(spark, 1, 0), path)
    append_feedback(feedback(spark, 0, 2), path)
    rows = read_feedback(spark, path).collect()
    assert all(r["timestamp"].endswith("+00:00") for r in rows)
    assert tuple(verdict_counts(read_feedback(spark, path)).first()) == (3, 1, 2)


def test_unknown_verdict_is_not_saved(spark, tmp_path):
    bad = spark.createDataFrame([("a", "perhaps")], "log_id string, administrator_verdict string")
    with pytest.raises(Exception, match="unknown verdict"):
        append_feedback(bad, str(tmp_path / "f"))


def test_bad_feedback_lines_are_skipped(spark, tmp_path):
    path = tmp_path / "f.jsonl"
    path.write_text(
        "\n".join(
            [
                '{"log_id":"a","administrator_verdict":"confirmed","timestamp":"t1"}',
                ' {"log_id":"b","administrator_verdict":"dismissed","extra":[1]} ',
                '{"log_id":5,"administrator_verdict":"confirmed"}',
                '{"log_id":"c","administrator_verdict":"maybe"}',
                '{"log_id":"d","administrator_verdict":"confirmed","timestamp":null}',
                '{"administrator_verdict":"confirmed"}',
                '["log_id"]',
                "not json",
                "",
            ]
        )
    )
    rows = {r["log_id"]: r for r in read_feedback(spark, str(path)).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"]["timestamp"] == "t1"
    assert rows["b"]["timestamp"].startswith("20")


@pytest.mark.parametrize(
    ("confirmed", "dismissed", "base", "rate", "expected"),
    [(0, 5, 0.5, 0.02, 0.6), (5, 0, 0.5, 0.02, 0.4), (0, 90, 0.5, 0.02, 0.95), (90, 0, 0.5, 0.02, 0.1), (0, 0, 0.97, 0.02, 0.97), (1, 1, 0.05, 0.02, 0.1)],
)
def test_adaptation(spark, confirmed, dismissed, base, rate, expected):
    assert adapt_threshold(feedback(spark, confirmed, dismissed), base, rate).first()["threshold"] == pytest.approx(expected)


def test_persisted_cutoff(spark, tmp_path):
    model, log = str(tmp_path / "m"), str(tmp_path / "f")
    assert persist_adapted_cutoff(spark, model, log) is None
    publish_settings(spark, model, {"contamination": 0.05}, PLAIN)
    append_feedback(feedback(spark, 0, 1), log)
    assert persist_adapted_cutoff(spark, model, log, rate=0.05) == pytest.approx(0.55)
    assert persist_adapted_cutoff(spark, model, log, rate=0.05) == pytest.approx(0.60)  # history applies again
    _, kept = stored_settings(spark, model)
    assert kept == {"contamination": 0.05, "consensus_cutoff": pytest.approx(0.60)}


def test_replay_of_two_dismissals(spark):
    assert replay_threshold(feedback(spark, 0, 2), "at").first()["threshold"] == pytest.approx(0.56)
    assert replay_threshold(feedback(spark, 0, 0), "at", base=0.37).first()["threshold"] == pytest.approx(0.37)


@pytest.mark.parametrize("chunk", [3, 10, 1000])
def test_replay_equals_a_loop(spark, chunk):
    rng = random.Random(11)
    verdicts = [rng.choice(["confirmed", "dismissed"]) for _ in range(157)]
    rows = [("x", v, i) for i, v in enumerate(verdicts)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "log_id string, administrator_verdict string, at long").repartition(3)
    cutoff, net = 0.5, 0
    for v in verdicts:
        net += 1 if v == "dismissed" else -1
        cutoff = round(max(0.1, min(0.95, cutoff + net * 0.02)), 4)
    row = replay_threshold(table, "at", rows_per_chunk=chunk).first()
    assert (row["total"], row["threshold"]) == (157, pytest.approx(cutoff))


# --- metrics ---


@pytest.mark.parametrize("rows_per_range", [5, 1000])
def test_metrics_as_of(spark, rows_per_range):
    rng = random.Random(6)
    host = lambda: "hot" if rng.random() < 0.4 else f"h{rng.randint(0, 5)}"
    samples = [(host(), rng.randint(0, 300), float(i), None if i % 7 == 0 else float(-i)) for i in range(80)]
    samples = list({(h, t): (h, t, c, m) for h, t, c, m in samples}.values())
    faults = [(host(), rng.randint(0, 300), f"log_{i}") for i in range(60)]
    ts = F.timestamp_seconds("t").alias("ts")
    metrics = spark.createDataFrame(samples, "host string, t long, cpu_percent double, memory_percent double").select("host", ts, "cpu_percent", "memory_percent")
    incidents = spark.createDataFrame(faults, "host string, t long, log_id string").select("host", ts, "log_id")
    got = {r["log_id"]: (r["cpu_percent"], r["memory_percent"]) for r in metrics_as_of(incidents, metrics, rows_per_range=rows_per_range).collect()}
    for h, t, log in faults:
        before = [s for s in samples if s[0] == h and s[1] <= t]
        assert got[log] == (max(before, key=lambda s: s[1])[2:] if before else (None, None))
    newest = with_latest_metrics(incidents, metrics).collect()
    for r in newest:
        own = [s for s in samples if s[0] == r["host"]]
        assert r["cpu_percent"] == (max(own, key=lambda s: s[1])[2] if own else None)


def test_latest_metrics_join_a_stream(spark, tmp_path):
    metrics = spark.createDataFrame([("a", 1, 10.0, 1.0), ("a", 2, 20.0, 2.0)], "host string, t long, cpu_percent double, memory_percent double")
    metrics = metrics.select("host", F.timestamp_seconds("t").alias("ts"), "cpu_percent", "memory_percent")
    spark.createDataFrame([("a", "x"), ("b", "y")], "host string, log_id string").write.parquet(str(tmp_path / "in"))
    alerts = spark.readStream.schema("host string, log_id string").parquet(str(tmp_path / "in"))
    job = with_latest_metrics(alerts, metrics).writeStream.format("memory").queryName("with_metrics").start()
    job.processAllAvailable()
    job.stop()
    assert {(r["log_id"], r["cpu_percent"]) for r in spark.table("with_metrics").collect()} == {("x", 20.0), ("y", None)}


def test_an_input_is_dealt_to_as_many_tasks_as_its_rows_need(spark):
    rows = spark.range(0, 95, numPartitions=1)
    assert log_view.spread(rows, 10).rdd.getNumPartitions() == 10
    assert sorted(r["id"] for r in log_view.spread(rows, 10).collect()) == list(range(95))
    assert log_view.spread(rows).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert log_view.spread(spark.range(0, 95, numPartitions=30), 10).rdd.getNumPartitions() == 30
