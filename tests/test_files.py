import os
import random

import pytest
from pyspark.errors import AnalysisException

from loghelm.plans.jobs import parsed_log
from loghelm.sources.files import read_numbered_lines


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write_logs(folder, seed=3):
    rng = random.Random(seed)
    expected = {}
    for f in range(3):
        rows = [rng.choice(["", "  ", f"file {f} line {i} " + "x" * rng.randint(0, 30)]) if i % 3 else f"f{f} {i}" for i in range(70 * (f + 1))]
        (folder / f"part-{f}.log").write_text("\n".join(rows) + "\n")
        pos = 0
        for i, row in enumerate(rows):
            if row.strip():
                expected[(f"part-{f}.log", i)] = (pos, row)
                pos += 1
    return expected


def test_numbers_per_file(spark, tmp_path, small_splits):
    expected = write_logs(tmp_path)
    lines = read_numbered_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 5
    got = {(os.path.basename(r["file"]), r["line_no"]): (r["pos"], r["value"]) for r in lines.collect()}
    assert got == expected


def test_files_as_one_log(spark, tmp_path, small_splits):
    write_logs(tmp_path)
    rows = sorted(read_numbered_lines(spark, str(tmp_path), one_log=True).collect(), key=lambda r: r["line_no"])
    text = "".join((tmp_path / f"part-{f}.log").read_text() for f in range(3)).split("\n")
    assert [(r["line_no"], r["value"]) for r in rows] == [(i, t) for i, t in enumerate(text) if t.strip()]
    assert [r["pos"] for r in rows] == list(range(len(rows)))


def test_record_limit_counts_blank_lines(spark, tmp_path):
    path = tmp_path / "a.log"
    path.write_text("one\n\ntwo\nthree\n")
    assert [r["value"] for r in read_numbered_lines(spark, str(path), 3).collect()] == ["one", "two"]
    assert read_numbered_lines(spark, str(path), 0).count() == 3


def test_line_ends_and_bad_bytes(spark, tmp_path):
    path = tmp_path / "a.log"
    path.write_bytes(b"a\xff b\r\nc\n\xe9d")
    assert [r["value"] for r in read_numbered_lines(spark, str(path)).orderBy("line_no").collect()] == ["a b", "c", "d"]


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_numbered_lines(spark, str(tmp_path / "none.log"))


def test_ids_carry_the_file_name_for_several_files(spark, tmp_path):
    for name in ("a.log", "b.log"):
        (tmp_path / name).write_text("x\ny\n")
    assert {r["log_id"] for r in parsed_log(spark, str(tmp_path / "a.log")).collect()} == {"log_0000000", "log_0000001"}
    assert {r["log_id"] for r in parsed_log(spark, str(tmp_path)).collect()} == {
        "a.log:log_0000000", "a.log:log_0000001", "b.log:log_0000000", "b.log:log_0000001"
    }
