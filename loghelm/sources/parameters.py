"""Parameter tables in versions.

A version is a set of new folders and, written last, one mark file that names
the folder of each table. Nothing that a reader may hold open is ever written
again: a job that stops before its mark leaves the version before in force,
and all tables of one read come from one version.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from loghelm.sources.records import path_exists

MARKS = "_versions"
PLAIN = 0  # version of tables that lie in `path/<table>` without a mark


class VersionConflict(RuntimeError):
    """Another job has published the version that this one was to follow."""


def _filesystem(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _mark_numbers(spark: SparkSession, path: str) -> list[int]:
    if not path_exists(spark, f"{path}/{MARKS}"):
        return []
    fs, folder = _filesystem(spark, f"{path}/{MARKS}")
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted((int(n[: -len(".json")]) for n in names if n.endswith(".json") and n[0].isdigit()), reverse=True)


def _read_mark(spark: SparkSession, path: str, number: int) -> dict[str, str] | None:
    """Folders by table name; None for a mark whose writer stopped half way."""
    fs, mark = _filesystem(spark, f"{path}/{MARKS}/{number:012d}.json")
    stream = fs.open(mark)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def current(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """The newest whole version: its number and the folder of each table below `path`."""
    for number in _mark_numbers(spark, path):
        folders = _read_mark(spark, path, number)
        if folders is not None:
            return number, folders
    return PLAIN, {}


def read_tables(spark: SparkSession, path: str, names: tuple[str, ...]) -> tuple[int, dict[str, DataFrame]]:
    """The tables of the newest version and its number. A table that no version
    names is read from `path/<name>`, and is left out where that is missing."""
    number, folders = current(spark, path)
    places = {name: f"{path}/{folders.get(name, name)}" for name in names}
    found = {n: p for n, p in places.items() if n in folders or path_exists(spark, p)}
    return number, {n: spark.read.parquet(p) for n, p in found.items()}


def publish(spark: SparkSession, path: str, tables: dict[str, DataFrame], follows: int | None = None) -> int:
    """Store the tables as a new version, the others staying as they are.

    With `follows`, the version that the tables were computed from, a version
    published in between raises `VersionConflict` instead of being undone.
    """
    number, folders = current(spark, path)
    if follows is not None and follows != number:
        raise VersionConflict(f"version {number} of {path} came after version {follows}")
    number = max([number, *_mark_numbers(spark, path)]) + 1
    folders = dict(folders)
    for name, table in tables.items():
        folders[name] = f"{name}-{number:012d}-{uuid.uuid4().hex[:8]}"
        table.write.mode("error").parquet(f"{path}/{folders[name]}")
    fs, mark = _filesystem(spark, f"{path}/{MARKS}/{number:012d}.json")
    try:
        stream = fs.create(mark, False)
    except Py4JJavaError as error:
        raise VersionConflict(f"version {number} of {path} is there already") from error
    stream.write(bytearray(json.dumps(folders, sort_keys=True).encode()))
    stream.close()
    return number
