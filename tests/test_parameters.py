"""Versions of parameter tables, the cutoff that a stream carries on, and the record of polls."""

import os
import random

import pytest

from loghelm import schemas
from loghelm.operators.triage import apply_verdicts, publish_settings, replay_threshold, stored_settings
from loghelm.session import parameter_table
from loghelm.sources import parameters
from loghelm.streaming.cadence import TRIGGER_TIMES, follow, latency


def settings_table(spark, **values):
    return parameter_table(spark, schemas.MODEL_SETTINGS, list(values.items()))


def test_a_write_without_its_mark_changes_nothing(spark, tmp_path):
    model = str(tmp_path / "m")
    parameters.publish(spark, model, {"settings": settings_table(spark, cutoff=0.5)})
    # a job that stopped after its tables, and one that stopped within its mark
    settings_table(spark, cutoff=0.9).write.parquet(f"{model}/settings-000000000002-dead")
    (tmp_path / "m" / parameters.MARKS / "000000000002.json").write_text('{"settings": "setti')
    assert stored_settings(spark, model) == (1, {"cutoff": 0.5})
    assert parameters.publish(spark, model, {"settings": settings_table(spark, cutoff=0.6)}) == 3
    assert stored_settings(spark, model) == (3, {"cutoff": 0.6})


def test_a_reader_keeps_the_version_it_opened(spark, tmp_path):
    model = str(tmp_path / "m")
    first = {"settings": settings_table(spark, cutoff=0.5), "params": settings_table(spark, a=1.0)}
    parameters.publish(spark, model, first)
    _, opened = parameters.read_tables(spark, model, ("settings", "params", "missing"))
    assert set(opened) == {"settings", "params"}
    publish_settings(spark, model, {"cutoff": 0.7}, follows=1)
    assert [tuple(r) for r in opened["settings"].collect()] == [("cutoff", 0.5)]
    _, now = parameters.read_tables(spark, model, ("settings", "params"))
    assert [tuple(r) for r in now["settings"].collect()] == [("cutoff", 0.7)]
    assert [tuple(r) for r in now["params"].collect()] == [("a", 1.0)]


def test_two_writers_of_one_version(spark, tmp_path):
    model = str(tmp_path / "m")
    publish_settings(spark, model, {"cutoff": 0.5}, parameters.PLAIN)
    publish_settings(spark, model, {"cutoff": 0.6}, follows=1)
    with pytest.raises(parameters.VersionConflict):
        publish_settings(spark, model, {"cutoff": 0.7}, follows=1)
    assert stored_settings(spark, model) == (2, {"cutoff": 0.6})


def test_tables_without_a_version(spark, tmp_path):
    model = str(tmp_path / "m")
    assert stored_settings(spark, model) == (parameters.PLAIN, None)
    settings_table(spark, cutoff=0.5).write.parquet(f"{model}/settings")
    assert stored_settings(spark, model) == (parameters.PLAIN, {"cutoff": 0.5})


@pytest.mark.parametrize("rate", [0.02, 0.003])
def test_batches_of_verdicts_equal_the_whole_replay(spark, tmp_path, rate):
    rng = random.Random(4)
    rows = [(i, rng.choice(["confirmed", "dismissed", "dismissed"])) for i in range(60)]
    schema = "at long, administrator_verdict string"
    model = str(tmp_path / "m")
    for batch, (low, high) in enumerate([(0, 13), (13, 13), (13, 41), (41, 60)]):
        part = spark.createDataFrame(rows[low:high], schema)
        for _ in range(2):  # the second call is a batch run again: it must not count twice
            apply_verdicts(part, batch, model, "at", rate)
    _, settings = stored_settings(spark, model)
    whole = replay_threshold(spark.createDataFrame(rows, schema), "at", rate=rate).first()
    assert settings["consensus_cutoff"] == whole["threshold"]
    assert (settings["verdict_total"], settings["verdict_net"]) == (whole["total"], whole["net"])


def test_polls_are_recorded(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    for i in range(6):
        (inbox / f"{i}.txt").write_text(f"line {i}\nmore\n")
    lines = spark.readStream.option("maxFilesPerTrigger", 2).text(str(inbox))
    writer = lines.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    job = writer.option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="50 milliseconds").start()
    follow(job, str(tmp_path / "times"), until_idle=True)
    times = spark.read.parquet(str(tmp_path / "times"))
    assert [(r["batch_id"], r["rows"]) for r in times.where("rows > 0").orderBy("batch_id").collect()] == [(0, 4), (1, 4), (2, 4)]
    row = latency(times).first()
    assert (row["triggers"], row["rows"]) == (3, 12) and 0 < row["p50_ms"] <= row["p95_ms"]


def test_a_failing_job_raises_and_leaves_its_times(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "0.txt").write_text("1\n2\n")

    def fail(batch, number):
        if number == 1:
            raise ValueError("second batch")

    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(str(inbox))
    (inbox / "1.txt").write_text("3\n")
    job = lines.writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "c")).start()
    with pytest.raises(Exception, match="second batch"):
        follow(job, str(tmp_path / "times"), until_idle=True)
    assert os.path.isdir(tmp_path / "times")


def test_latency_of_known_times(spark):
    rows = [("q", i, "t", n, ms, ms) for i, (n, ms) in enumerate([(10, 100), (0, 5), (30, 300)])]
    row = latency(spark.createDataFrame(rows, TRIGGER_TIMES)).first()
    assert tuple(row) == ("q", 2, 40, 200.0, 290.0, 100.0)
