"""The source of growing files: appended, unfinished, rotated and replaced files."""

import random

import pyarrow as pa
import pytest

from loghelm.plans import queries
from loghelm.sources import growing


@pytest.fixture()
def job(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()

    def run(range_bytes=40):
        lines = growing.tail_growing(spark, str(inbox), range_bytes)
        out = lines.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "mark"))
        query = out.trigger(availableNow=True).start()
        assert query.awaitTermination(60)
        rows = spark.read.parquet(str(tmp_path / "out")).collect()
        return sorted((r["stream"], r["value"]) for r in rows)

    return inbox, run


def append(path, text):
    with open(path, "ab") as file:
        file.write(text.encode())


def test_appended_bytes_and_unfinished_lines(job):
    inbox, run = job
    append(inbox / "a.log", "one\ntwo\nthr")
    append(inbox / "b.log", "no end")
    assert run() == [("a", "one"), ("a", "two")]
    append(inbox / "a.log", "ee\n\n \nfour é\r\n")
    append(inbox / "b.log", " yet\n")
    want = [("a", "four é"), ("a", "one"), ("a", "three"), ("a", "two"), ("b", "no end yet")]
    assert run() == sorted(want)
    assert run() == sorted(want)  # a restart without news reads nothing again


def test_rotation_and_replacement(job):
    inbox, run = job
    append(inbox / "app.log", "first line\nsecond\n")
    append(inbox / "other.log", "long line of the old file\nx\n")
    run()
    append(inbox / "app.log", "late\n")
    (inbox / "app.log").rename(inbox / "app.log.1")
    append(inbox / "app.log", "new file\n")
    (inbox / "other.log").write_text("short\n")
    want = [("app", v) for v in ("first line", "late", "new file", "second")] + [("other", v) for v in ("long line of the old file", "short", "x")]
    assert run() == sorted(want)


@pytest.mark.parametrize("size", [1, 3, 7, 64, 1000])
def test_ranges_hold_every_line_once(tmp_path, size):
    rng = random.Random(size)
    lines = [bytes(rng.choices(b"ab c", k=rng.choice([0, 1, 2, 9, 30]))) for _ in range(60)]
    (tmp_path / "f").write_bytes(b"\n".join(lines) + b"\nunfinished")
    found = []
    with pa.OSFile(str(tmp_path / "f")) as file:
        end = growing.last_line_end(file, file.size())
        for a in range(0, end, size):
            found += growing.range_lines(file, growing.ByteRange("f", a, min(a + size, end), a == 0, 0))
    assert [line for _, line in found] == lines
    assert [s for s, _ in found] == [sum(len(x) + 1 for x in lines[:i]) for i in range(len(lines))]


def test_offsets_decide_where_to_go_on():
    old = {"a": [10, 1, 7], "b": [5, 1, 8]}
    assert growing.resume_at("a", old, {"a": [30, 2, 7]}) == 10
    assert growing.resume_at("a", old, {"a": [4, 2, 7]}) == 0  # cut short: replaced
    assert growing.resume_at("a", old, {"a": [30, 2, 9]}) == 0
    assert growing.resume_at("a.1", old, {"a.1": [30, 2, 7], "a": [3, 2, 9]}) == 10
    assert growing.resume_at("c", old, {"a": [10, 1, 7], "c": [9, 2, 7]}) == 0  # a copy is a file of its own


def test_lines_are_appended_in_order_over_many_arrow_batches(spark, tmp_path):
    """The second call goes on behind the mark, cuts what lies there back, and ends the line before."""
    rows = [(f"host-{i % 3}", i, f"ü {i}") for i in range(60)]
    lines = spark.createDataFrame(rows, "stream string, line_no long, value string").repartition(5)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "4")
    try:
        queries._append_by_stream(lines.where("line_no < 30"), str(tmp_path))
        for n in range(3):
            (tmp_path / f".host-{n}.end").write_text(str((tmp_path / f"host-{n}.log").stat().st_size))
        with open(tmp_path / "host-1.log", "ab") as file:
            file.write(b"left by a task that failed")
        queries._append_by_stream(lines.where("line_no >= 30"), str(tmp_path))
    finally:
        spark.conf.set(key, before)
    for n in range(3):
        assert (tmp_path / f"host-{n}.log").read_text() == "\n".join(v for s, _, v in rows if s == f"host-{n}")
