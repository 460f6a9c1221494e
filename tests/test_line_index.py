import gzip
import io
import os
import random
import re

import pytest
from pyspark.errors import AnalysisException, PythonException
from pyspark.sql import functions as F

from loghelm.plans.jobs import index_log, parsed_log
from loghelm.sources import line_index
from loghelm.sources.files import read_numbered_lines

ENDS = [b"\n", b"\r\n", b"\r", b"\n\n", b"\r\r\n"]
TEXTS = [b"", b"  ", b"\xc2\xa0", b"plain", b"bad\xff byte", b"\xef\xbf\xbd", b"\xff", b"\xe2\x82\xac", b"x" * 90]


def random_log(rng, n):
    return b"".join(rng.choice(TEXTS) + rng.choice(ENDS) for _ in range(n)) + rng.choice([b"", b"open end"])


def lines_of(data):
    return re.split(rb"\r\n|\r|\n", data)[: None if data and not data.endswith((b"\n", b"\r")) else -1]


def expected(name, data):
    out, pos = {}, 0
    for i, line in enumerate(lines_of(data)):
        text = line.decode("utf-8", "ignore") if line != b"\xff" else ""
        if text.strip():
            out[name, i] = (pos, text)
            pos += 1
    return out


def found(lines):
    return {(os.path.basename(r["file"]), r["line_no"]): (r["pos"], r["value"]) for r in lines.collect()}


@pytest.mark.parametrize("step", [1, 2, 7, 1 << 20])
def test_ranges_share_out_every_line_once(monkeypatch, step):
    monkeypatch.setattr(line_index, "STEP", step)
    rng = random.Random(step)
    for _ in range(120):
        data = random_log(rng, rng.randint(0, 12))
        width = rng.randint(1, 40)
        got, ends = [], []
        for a in range(0, len(data), width):
            b = min(a + width, len(data))
            start = line_index.first_start(io.BytesIO(data), a, b)
            if start is None:
                continue
            assert a <= start < b and start == (ends[-1] if ends else 0)
            source = io.BytesIO(data)
            source.seek(start)
            groups = list(line_index.line_groups(source.read, start, b))
            got += [line for group in groups for line in group]
            ends.append(start + sum(g.width for g in groups))
        assert got == lines_of(data)
        assert not data or ends[-1] == len(data)


@pytest.mark.parametrize("range_bytes", [50, 333, 1 << 20])
def test_numbers_equal_a_loop_and_the_scan(spark, tmp_path, range_bytes):
    rng = random.Random(5)
    want = {}
    for name in ("a b%20.log", "b.log", "c.log"):
        data = random_log(rng, 60)
        (tmp_path / name).write_bytes(data)
        want |= expected(name, data)
    (tmp_path / "empty.log").write_bytes(b"")
    lines = line_index.indexed_lines(line_index.build_index(spark, str(tmp_path), range_bytes))
    got = {(k[0].replace("%20", " ", 1).replace("%2520", "%20"), k[1]): v for k, v in found(lines).items()}
    assert got == want
    assert found(lines) == found(read_numbered_lines(spark, str(tmp_path)))


def test_files_as_one_log(spark, tmp_path):
    for f in range(4):
        (tmp_path / f"part-{f}").write_text("".join(f"{f} {i}\n\n" for i in range(20)))
    lines = line_index.indexed_lines(line_index.build_index(spark, str(tmp_path), 30, one_log=True)).orderBy("pos").collect()
    assert [r["line_no"] for r in lines] == list(range(0, 160, 2))
    assert [r["value"] for r in lines] == [f"{f} {i}" for f in range(4) for i in range(20)]


def test_numbers_do_not_depend_on_the_parallelism(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(random_log(random.Random(1), 300))
    index = line_index.build_index(spark, str(tmp_path), 100)
    keys = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.shuffle.partitions": "13", "spark.sql.files.minPartitionNum": "9"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    other = line_index.build_index(spark, str(tmp_path), 100)
    assert sorted(other.collect()) == sorted(index.collect())
    assert found(line_index.indexed_lines(other)) == found(line_index.indexed_lines(index))
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_a_line_longer_than_many_ranges(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"one\n" + b"y" * 3_000_000 + b"\nthree\n")
    index = line_index.build_index(spark, str(tmp_path), 100_000)
    assert index.agg(F.sum("lines")).first()[0] == 3 and index.count() == 2
    assert [(r["line_no"], len(r["value"])) for r in line_index.indexed_lines(index).orderBy("pos").collect()] == [(0, 3), (1, 3_000_000), (2, 5)]


def test_compressed_file_is_one_range(spark, tmp_path):
    with gzip.open(tmp_path / "a.log.gz", "wb") as file:
        file.write(b"one\n\ntwo\r\nthree")
    index = line_index.build_index(spark, str(tmp_path), 4)
    assert index.count() == 1
    assert found(line_index.indexed_lines(index)) == {("a.log.gz", 0): (0, "one"), ("a.log.gz", 2): (1, "two"), ("a.log.gz", 3): (2, "three")}


@pytest.mark.parametrize("limit", [1, 2, 40, 75, 10_000])
def test_first_lines_leave_the_rest_unread(spark, tmp_path, limit):
    (tmp_path / "long.log").write_text("".join(f"l{i}\n\n" for i in range(400)))
    (tmp_path / "short.log").write_text("s0\n\ns2\n")
    index = line_index.index_of_first(spark, str(tmp_path), limit, 50)
    whole = line_index.build_index(spark, str(tmp_path), 50)
    need = line_index.indexed_lines(whole, limit)
    assert found(line_index.indexed_lines(index, limit)) == found(need) == found(read_numbered_lines(spark, str(tmp_path), limit))
    if limit <= 75:
        assert index.agg(F.max("stop")).first()[0] < 1_600
    first = {k: v for k, v in found(line_index.indexed_lines(whole)).items() if v[0] < limit}
    assert found(line_index.indexed_lines(whole, max_kept=limit)) == first


def test_index_is_refreshed_by_file(spark, tmp_path, monkeypatch):
    logs, place = tmp_path / "logs", str(tmp_path / "index")
    logs.mkdir()
    for name in ("keep", "grow", "gone"):
        (logs / name).write_text("".join(f"{name} {i}\n" for i in range(30)))
    line_index.save_index(line_index.build_index(spark, str(logs), 64), place)
    (logs / "gone").unlink()
    (logs / "new").write_text("n\n")
    with open(logs / "grow", "a") as file:
        file.write("more\n")
    with pytest.raises(PythonException, match="changed since it was indexed|No such file"):
        line_index.indexed_lines(line_index.load_index(spark, place)).collect()
    read = []
    plan = line_index.planned_ranges
    monkeypatch.setattr(line_index, "planned_ranges", lambda files, n: read.extend(r["file"] for r in files.collect()) or plan(files, n))
    line_index.save_index(line_index.refreshed_index(spark, line_index.load_index(spark, place), str(logs), 64), place)
    assert sorted(os.path.basename(p) for p in read) == ["grow", "new"]
    assert found(line_index.indexed_lines(line_index.load_index(spark, place))) == found(read_numbered_lines(spark, str(logs)))


def test_missing_and_empty(spark, tmp_path):
    with pytest.raises(AnalysisException):
        line_index.build_index(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        line_index.load_index(spark, str(tmp_path / "none"))
    (tmp_path / "a.log").write_bytes(b"")
    assert line_index.indexed_lines(line_index.build_index(spark, str(tmp_path))).count() == 0
    assert line_index.read_first_lines(spark, str(tmp_path), 5).count() == 0


def test_jobs_read_through_the_index(spark, tmp_path):
    path, place = str(tmp_path / "a.log"), str(tmp_path / "index")
    (tmp_path / "a.log").write_text("one\n\ntwo\nthree\n")
    index_log(spark, path, place)
    ids = lambda df: sorted((r["log_id"], r["raw_text"]) for r in df.collect())
    assert ids(parsed_log(spark, path, index_path=place)) == ids(parsed_log(spark, path))
    assert ids(parsed_log(spark, path, 3, index_path=place)) == ids(parsed_log(spark, path, 3)) == [("log_0000000", "one"), ("log_0000002", "two")]
