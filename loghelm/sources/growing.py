"""Streaming source of log files that are appended to, rotated and replaced.

An offset holds, per file, the byte behind its last finished line, its time and
the checksum of its first line. A line that has no end yet waits for it. A file
is known by its path and first line; where the first line of a path has changed, or
the file is shorter than what was read of it, the file was replaced and is read from
its start, and if another path now begins with the old first line, the file was
moved there and is read on from where it was. All is found out from the two offsets
of a batch, so a batch that is run again after a restart reads the same bytes.

What a batch reads is cut into byte ranges, each read by its own task: a line
belongs to the range in which it starts. The driver holds one entry per file.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from loghelm.functions.text import is_blank

SCHEMA = "value STRING, stream STRING, file_time TIMESTAMP, file STRING, start BIGINT"
#: Order of a stream's lines.
GROWING_ORDER = ("file_time", "file", "start")
STREAM_PATTERN = r"([^/]+?)(\.[^/]*)?$"
RANGE_BYTES = 32 << 20
#: Bytes read at once, and the most that are compared of a first line.
STEP = 1 << 20
HEAD = 4096
BATCH_LINES = 10_000


@dataclass
class ByteRange(InputPartition):
    """Lines of a file that start in [start, end); `first`: a line starts at `start`."""

    path: str
    start: int
    end: int
    first: bool
    time_us: int

    def __post_init__(self) -> None:
        super().__init__((self.path, self.start))


class GrowingReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))
        self.pattern = options.get("streampattern", STREAM_PATTERN)

    def _files(self) -> tuple[pafs.FileSystem, list[pafs.FileInfo]]:
        fs, path = pafs.FileSystem.from_uri(self.path)
        found = fs.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True))
        return fs, [f for f in found if f.is_file and not f.base_name.startswith((".", "_"))]

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        fs, files = self._files()
        out = {}
        for info in files:
            with fs.open_input_file(info.path) as file:
                head = first_line(file, info.size)
                end = last_line_end(file, info.size) if head is not None else 0
            if end:
                out[info.path] = [end, int(info.mtime.timestamp() * 1_000_000), head]
        return {"files": dict(sorted(out.items()))}

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        before, after = start["files"], end["files"]
        parts = []
        for path, (to, time_us, _) in after.items():
            at = resume_at(path, before, after)
            for a in range(at, to, self.range_bytes):
                parts.append(ByteRange(path, a, min(a + self.range_bytes, to), a == at, time_us))
        return parts

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        stream = re.search(self.pattern, part.path)
        name = stream.group(1) if stream else ""
        lines: list[str] = []
        starts: list[int] = []

        def flush() -> pa.RecordBatch:
            n = len(lines)
            columns = [
                pa.array(lines, pa.string()), pa.array([name] * n, pa.string()), pa.array([part.time_us] * n, pa.timestamp("us", "UTC")),
                pa.array([part.path] * n, pa.string()), pa.array(starts, pa.int64()),
            ]
            lines.clear()
            starts.clear()
            return pa.RecordBatch.from_arrays(columns, ["value", "stream", "file_time", "file", "start"])

        with fs.open_input_file(part.path) as file:
            for start, line in range_lines(file, part):
                starts.append(start)
                lines.append(line.decode("utf-8", "ignore"))
                if len(lines) >= BATCH_LINES:
                    yield flush()
        yield flush()

    def commit(self, end: dict) -> None:
        """Nothing is kept outside the offsets."""


class GrowingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> GrowingReader:
        return GrowingReader(self.options)


def first_line(file: pa.NativeFile, size: int) -> int | None:
    """Checksum of the first finished line (of its first bytes, if it is long)."""
    head = file.read_at(min(size, HEAD), 0)
    end = head.find(b"\n")
    if end < 0 and len(head) < HEAD:
        return None
    return zlib.crc32(head[: end + 1] if end >= 0 else head)


def last_line_end(file: pa.NativeFile, size: int) -> int:
    """Byte behind the last line end before `size`, 0 without one."""
    at = size
    while at > 0:
        start = max(0, at - STEP)
        found = file.read_at(at - start, start).rfind(b"\n")
        if found >= 0:
            return start + found + 1
        at = start
    return 0


def resume_at(path: str, before: dict, after: dict) -> int:
    """Where to read a file of the offset `after` on from, given the offset `before`."""
    to, _, head = after[path]
    known = before.get(path)
    if known and known[2] == head:
        return known[0] if to >= known[0] else 0
    moved = [p for p, old in before.items() if old[2] == head and (p not in after or after[p][2] != head)]
    return min((before[p][0] for p in moved if before[p][0] <= to), default=0) if len(moved) == 1 else 0


def range_lines(file: pa.NativeFile, part: ByteRange) -> Iterator[tuple[int, bytes]]:
    """Start and bytes of the lines that start in the range; all of them have an end."""
    at, rest = part.start, b""
    if not part.first:
        # the line that crosses the start belongs to the range before
        at -= 1
        while (found := (piece := file.read_at(STEP, at)).find(b"\n")) < 0:
            if not piece:
                return
            at += len(piece)
        at += found + 1
    start = at  # of the open line
    while start < part.end and (piece := file.read_at(STEP, at)):
        at += len(piece)
        *whole, rest = (rest + piece).split(b"\n")
        for line in whole:
            if start >= part.end:
                return
            yield start, line.removesuffix(b"\r")
            start += len(line) + 1


def tail_growing(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, stream_pattern: str = STREAM_PATTERN) -> DataFrame:
    """Stream of the finished, non-blank lines of the files in a folder, also of those that
    are appended to. `stream` is the file name up to its first dot, so that a rotated
    file stays in its stream; `GROWING_ORDER` orders a stream's lines."""
    spark.dataSource.register(GrowingSource)
    options = {"path": path, "rangeBytes": str(range_bytes), "streamPattern": stream_pattern}
    lines = spark.readStream.format("growing_log").options(**options).load()
    return lines.where(~is_blank(F.col("value")))
