"""Sparse index of the lines of log files.

One row per byte range of a file (32 MB, say): the byte at which its first line starts, the byte
behind its last one, and the numbers that these lines have. The ranges are planned from
file sizes alone, so the numbers do not depend on the cluster's size or settings.

With the index each range is read on its own and its lines know their numbers: lines
are numbered without a join, a sort or a second pass, and the first n lines are read without touching
the ranges behind them. The index is 100 bytes or so per range (300 MB for 100 TB) and stays a table.

Lines end with LF, CR or CR LF and belong to the range in which they start. A compressed file is one
range. Files are read through `pyarrow.fs`; `reaches` tells whether it knows a path's store.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loghelm.functions.text import WHITE_SPACE
from loghelm.operators.ordering import running_totals
from loghelm.session import materialize
from loghelm.sources import parameters

RANGE_BYTES = 32 << 20
#: Bytes read at once.
STEP = 1 << 20
BATCH_BYTES = 4 << 20
BATCH_LINES = 10_000
#: Each round of the search for the first lines reads this many times the ranges of all before.
GROWTH = 4
MAX_TASKS = 100_000
COMPRESSED = r"\.(gz|bz2|zst|lz4)$"
TABLE = "line_index"
STORES = ("file", "hdfs", "viewfs", "s3", "gs")

MEASURED = "file STRING, size BIGINT, modified TIMESTAMP, start BIGINT, stop BIGINT, lines BIGINT, kept BIGINT"
INDEX = f"{MEASURED}, log STRING, first_line BIGINT, first_pos BIGINT"
LINES = "value STRING, file STRING, line_no BIGINT, pos BIGINT"

_END = re.compile(rb"\r\n?|\n")


def reaches(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether `pyarrow.fs` knows the store that `path` lies in."""
    name = list_files(spark, path).select("file").first()
    return name is None or name[0].split(":")[0] in STORES


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Name, size and time of the files that a text scan of `path` would read; a missing
    path raises. Contents are not read."""
    found = spark.read.format("binaryFile").load(path)
    return found.select(
        F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def planned_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Byte ranges [start, stop) of the files, numbered per file; a compressed file is one range."""
    number = F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / range_bytes))
    whole = F.col("file").rlike(COMPRESSED)
    cut = files.where("size > 0").select("*", F.explode(F.when(whole, F.array(F.lit(0).cast("long"))).otherwise(number)).alias("number"))
    start = F.col("number") * range_bytes
    stop = F.when(whole, F.col("size")).otherwise(F.least(start + range_bytes, "size"))
    return cut.select("file", "size", "modified", start.alias("start"), stop.alias("stop"), "number")


def build_index(
    spark: SparkSession, path: str | list[str], range_bytes: int = RANGE_BYTES, one_log: bool = False
) -> DataFrame:
    """Read all files once and index their lines. With `one_log` the files are parts
    of one log: numbers run on from file to file in name order."""
    return numbered(materialize(measured(planned_ranges(list_files(spark, path), range_bytes))), one_log)


def refreshed_index(
    spark: SparkSession, index: DataFrame, path: str | list[str], range_bytes: int = RANGE_BYTES, one_log: bool = False
) -> DataFrame:
    """Index of what `path` holds now. Files of the same name, size and time keep the rows of
    `index`; only others are read, and files that are gone leave."""
    files = list_files(spark, path)
    same = ["file", "size", "modified"]
    kept = index.join(files, same, "left_semi").select(*spark.createDataFrame([], MEASURED).columns)
    changed = files.join(index.select(*same).distinct(), same, "left_anti")
    return numbered(materialize(kept.unionByName(measured(planned_ranges(changed, range_bytes)))), one_log)


def index_of_first(
    spark: SparkSession, path: str | list[str], max_records: int, range_bytes: int = RANGE_BYTES, one_log: bool = False
) -> DataFrame:
    """Index of the first ranges of each file, enough for its first `max_records` raw lines. Ranges
    are measured in rounds, each some times as long as all before, until every file has its lines."""
    ranges = materialize(planned_ranges(list_files(spark, path), range_bytes))
    open_files, found, done, upto = ranges.select("file").distinct(), None, 0, 1
    while True:
        here = ranges.where(F.col("number").between(done, upto - 1)).join(open_files, "file", "left_semi")
        part = materialize(measured(here))
        found = part if found is None else found.unionByName(part)
        seen = found.groupBy("file").agg(F.sum("lines").alias("seen"))
        rest = ranges.where(F.col("number") >= upto).join(open_files, "file", "left_semi").select("file").distinct()
        rest = rest.join(seen, "file", "left").where(F.coalesce("seen", F.lit(0)) < max_records)
        open_files = materialize(rest.select("file"))
        if open_files.isEmpty():
            return numbered(found, one_log)
        done, upto = upto, upto * (GROWTH + 1)


def numbered(ranges: DataFrame, one_log: bool = False) -> DataFrame:
    """Measured ranges with the numbers of their first lines."""
    folder = F.regexp_extract("file", "^(.*)/[^/]*$", 1)
    logs = ranges.withColumn("log", folder if one_log else F.col("file"))
    keys = () if one_log else ("log",)
    totals = {"first_line": F.col("lines"), "first_pos": F.col("kept")}
    counted = running_totals(logs, ("file", "start"), totals, keys)
    return materialize(counted.withColumns({"first_line": F.expr("first_line - lines"), "first_pos": F.expr("first_pos - kept")}))


def save_index(index: DataFrame, path: str) -> None:
    """Store the index as a new version; the one before stays readable until this one is whole."""
    parameters.publish(index.sparkSession, path, {TABLE: index})


def load_index(spark: SparkSession, path: str) -> DataFrame:
    _, tables = parameters.read_tables(spark, path, (TABLE,))
    if TABLE not in tables:
        raise FileNotFoundError(f"no line index in {path}")
    return tables[TABLE]


def indexed_lines(index: DataFrame, max_records: int | None = None, max_kept: int | None = None) -> DataFrame:
    """Non-blank lines with their log (`file`) and their place in it, from the
    ranges that the limits need. `max_records` counts raw lines of each log, `max_kept` non-blank ones; None
    and 0 mean all. A file of another size than the index knows stops the job."""
    limits = [(F.col(first), F.col(place), n) for first, place, n in
              (("first_line", "line_no", max_records), ("first_pos", "pos", max_kept)) if n]
    needed = index
    for first, _, n in limits:
        needed = needed.where(first < n)
    columns = ("file", "size", "start", "stop", "log", "first_line", "first_pos")
    lines = _each_on_its_own(needed.select(*columns)).mapInArrow(_read_ranges, LINES)
    for _, place, n in limits:
        lines = lines.where(place < n)
    return lines


def read_first_lines(
    spark: SparkSession, path: str | list[str], max_records: int, range_bytes: int = RANGE_BYTES, one_log: bool = False
) -> DataFrame:
    """The non-blank ones of the first `max_records` raw lines of each log, without reading on."""
    return indexed_lines(index_of_first(spark, path, max_records, range_bytes, one_log), max_records)


# --- ranges in tasks --------------------------------------------------------


def _each_on_its_own(ranges: DataFrame) -> DataFrame:
    """One range a task, as far as there are tasks; the count reads the range table only."""
    return ranges.repartition(max(1, min(ranges.count(), MAX_TASKS)))


def measured(ranges: DataFrame) -> DataFrame:
    """What the ranges hold: bytes of the first line's start and the last one's end, numbers of
    all and of non-blank lines. A range in which no line starts leaves."""
    return _each_on_its_own(ranges.drop("number")).mapInArrow(_measure_ranges, MEASURED)


def _measure_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            with _open(row) as source:
                packed = re.search(COMPRESSED, row["file"])
                start = 0 if packed else first_start(source, row["start"], row["stop"])
                lines = kept = 0
                if start is not None:
                    if start:
                        source.seek(start)
                    stop = None if packed else row["stop"]
                    end = start
                    for group in line_groups(source.read, start, stop):
                        lines += len(group)
                        kept += sum(not blank(line) for line in group)
                        end += group.width
            if lines:
                rows.append({**row, "start": start, "stop": end, "lines": lines, "kept": kept})
        yield pa.RecordBatch.from_pylist(rows, schema=_schema(batch, rows))


def _schema(batch: pa.RecordBatch, rows: list) -> pa.Schema:
    return pa.schema([*batch.schema, pa.field("lines", pa.int64()), pa.field("kept", pa.int64())])


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield from _range_lines(row)


def _range_lines(row: dict) -> Iterator[pa.RecordBatch]:
    values: list[str] = []
    places: list[int] = []
    width, line_no, pos = 0, row["first_line"], row["first_pos"]

    def flush() -> pa.RecordBatch:
        nonlocal width, pos
        n = len(values)
        columns = [
            pa.array(values, pa.string()), pa.array([row["log"]] * n, pa.string()),
            pa.array(places, pa.int64()), pa.array(range(pos, pos + n), pa.int64()),
        ]
        values.clear()
        places.clear()
        width, pos = 0, pos + n
        return pa.RecordBatch.from_arrays(columns, ["value", "file", "line_no", "pos"])

    with _open(row) as source:
        if row["start"]:
            source.seek(row["start"])
        stop = None if re.search(COMPRESSED, row["file"]) else row["stop"]
        for group in line_groups(source.read, row["start"], stop):
            for line in group:
                if not blank(line):
                    values.append(decoded(line))
                    places.append(line_no)
                    width += len(line)
                    if len(values) >= BATCH_LINES or width >= BATCH_BYTES:
                        yield flush()
                line_no += 1
    yield flush()


def _open(row: dict) -> pa.NativeFile:
    fs, path = pafs.FileSystem.from_uri(row["file"])
    if fs.get_file_info(path).size != row["size"]:
        raise ValueError(f"{row['file']} has changed since it was indexed; refresh the index")
    return fs.open_input_stream(path) if re.search(COMPRESSED, path) else fs.open_input_file(path)


def first_start(source: pa.NativeFile, start: int, stop: int) -> int | None:
    """Byte of the first line that starts in [start, stop), None without one."""
    if start == 0:
        return 0
    at = start - 1
    while at < stop:
        source.seek(at)
        piece = source.read(min(STEP, stop - at))
        if not piece:
            return None
        found = _END.search(piece)
        if found:
            end = at + found.end()
            if found.group() == b"\r" and found.end() == len(piece):
                source.seek(end)
                end += source.read(1) == b"\n"
            return end if end < stop else None
        at += len(piece)
    return None


class Group(list):
    """Some lines in a row, without their ends; `width` counts their bytes with the ends."""

    width = 0


def line_groups(read: Callable[[int], bytes], at: int, stop: int | None) -> Iterator[Group]:
    """The lines that start in [at, stop), as `read` gives their bytes from `at` on; a line
    starts at `at`. The last one is read to its end."""
    held: list[bytes] = []  # of the line that is open
    begin = at  # of that line
    while stop is None or begin < stop:
        piece = read(STEP)
        while piece.endswith(b"\r") and (more := read(1)):
            piece += more
        if not piece:
            break
        cut = max(piece.rfind(b"\n"), piece.rfind(b"\r")) + 1
        if not cut:
            held.append(piece)
            continue
        block = b"".join([*held, piece[:cut]])
        held = [piece[cut:]] if cut < len(piece) else []
        if stop is not None and begin + len(block) > stop:
            block = _up_to(block, stop - begin)
        begin += len(block)
        yield _group(block)
    if held and (stop is None or begin < stop):
        yield _group(b"".join(held))


def _up_to(block: bytes, width: int) -> bytes:
    """The lines of the block that start before `width`."""
    found = _END.search(block, width - 1)  # ends the last of them
    if found and block[width - 1 : width] == b"\n" and block[width - 2 : width - 1] == b"\r":
        return block[:width]
    return block[: found.end()] if found else block


def _group(block: bytes) -> Group:
    group = Group(block.splitlines())
    group.width = len(block)
    return group


def decoded(line: bytes) -> str:
    """Bytes that are no UTF-8 are left out, as the text scan does it."""
    try:
        return line.decode()
    except UnicodeDecodeError:
        return line.decode("utf-8", "ignore").replace("\ufffd", "")


def blank(line: bytes) -> bool:
    if line and 33 <= line[0] <= 126:
        return False
    return not decoded(line).strip(WHITE_SPACE)
