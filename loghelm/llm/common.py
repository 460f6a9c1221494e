"""Helpers that several operators share: stored intermediate tables, column
access by Arrow, word splitting on bytes, and packed number columns."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loghelm.session import fresh_path

NO_ID = -(2**63)


class TaskCache(dict):
    """A cache that is shipped empty: functions go to the tasks with their globals."""

    def __reduce__(self):
        return TaskCache, ()


def worker_memo() -> dict:
    """A dictionary that lives as long as its Python worker, over many tasks: functions
    come to a task with a copy of this package, so it hangs on a module of its own."""
    return sys.modules.setdefault("_loghelm_worker_memo", ModuleType("_loghelm_worker_memo")).__dict__


def store(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: later steps start
    from files that outlive any executor."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that the text operators read, a null text as the empty one."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def fold(text_col: str = "doc_id", modulus: int = 5) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(text_col).cast("string"), F.lit(""))) % modulus


def byte_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a batch as UTF-8 bytes."""
    col = batch.column(batch.schema.get_field_index(column))
    return col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()


def longs(batch: pa.RecordBatch, column: str, null: int = NO_ID) -> np.ndarray:
    """A LONG column as numpy, nulls as `null`."""
    col = batch.column(batch.schema.get_field_index(column))
    return col.fill_null(null).to_numpy(zero_copy_only=False).astype(np.int64)


def ids_back(values: np.ndarray) -> pa.Array:
    """Numpy ids as an Arrow column, `NO_ID` as null."""
    values = np.asarray(values, dtype=np.int64)
    return pa.array(values, mask=values == NO_ID)


def slices(texts: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Cut a list into runs of about `most` bytes; a longer text is a run of its own."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        if total and total + len(text) > most:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def _table(keep: bytes) -> bytes:
    out = bytearray(b" " * 256)
    for b in keep:
        out[b] = b
    for b in range(65, 91):
        out[b] = b + 32
    return bytes(out)


#: Lower-cases A-Z; every other byte stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Lower-cases A-Z and turns every byte but digits, letters and non-ASCII into a blank.
ALNUM = _table(bytes([*range(48, 58), *range(97, 123), *range(128, 256)]))


def blank_words(text: bytes) -> list[bytes]:
    """Lower-cased words between blanks (space and \\t\\n\\v\\f\\r)."""
    return text.translate(LOWER).split()


def alnum_words(text: bytes) -> list[bytes]:
    """Lower-cased words of digits, letters and non-ASCII characters."""
    return text.translate(ALNUM).split()


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


_CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_powers = TaskCache()
_LETTERS = np.random.default_rng(5).integers(1, 2**64, 256, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse."""
    size = max(_CHUNK, n) + 1
    if size not in _powers:
        made = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        if len(_powers) > 1:
            _powers.clear()
        _powers[size] = (made[0], made[1])
    return _powers[size]


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Sums that give a 64-bit number to every substring of `codes`."""
    up, _ = powers(len(codes))
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_LETTERS[codes] * up[: len(codes)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit numbers of the substrings [start, end), equal for equal substrings."""
    _, down = powers(len(sums))
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


#: The word numbers below are polynomials modulo this prime, 2**31 - 1, at two places.
_PRIME = np.uint64(0x7FFFFFFF)
_PLACES = (1_103_515_245, 1_664_525_003)
_PRIME_LETTERS = np.random.default_rng(11).integers(1, 2**31 - 1, (2, 256), dtype=np.uint64)
_prime_powers = TaskCache()


def prime_powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For both places, their powers modulo the prime and those of the inverse."""
    size = max(_CHUNK, n) + 1
    if size not in _prime_powers:
        made = []
        for place in _PLACES:
            both = []
            for base in (place, pow(place, -1, int(_PRIME))):
                steps = np.ones(1, np.uint64)
                while len(steps) < size:
                    steps = np.concatenate((steps, steps * np.uint64(pow(base, len(steps), int(_PRIME))) % _PRIME))
                both.append(steps[:size])
            made.append((both[0], both[1]))
        if len(_prime_powers) > 1:
            _prime_powers.clear()
        _prime_powers[size] = made
    return _prime_powers[size]


def prime_numbers(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, places: int = 2) -> np.ndarray:
    """Numbers of 31 bits a place of the substrings [start, end), spread over 64 bits.

    The letters' values are drawn below a prime, so equal numbers of different words
    come by chance alone (2**-62 a pair for two places), not by the shape of the words, as they do
    modulo a power of two.
    """
    out = np.zeros(len(starts), np.uint64)
    for letters, (up, down) in zip(_PRIME_LETTERS[:places], prime_powers(len(codes))):
        terms = letters[codes] * up[: len(codes)]
        terms = (terms & _PRIME) + (terms >> np.uint64(31))
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        out = (out << np.uint64(31)) | ((sums[ends] - sums[starts]) % _PRIME * down[starts] % _PRIME)
    return mix64(out)


def word_hashes(data: bytes, prime: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash and byte offset of each word between blanks (byte 32); with `prime`, the
    numbers of `prime_numbers`."""
    hashes, offsets, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    while at < len(data):
        # with `prime`, pieces whose arrays stay in the processor's cache
        to = min(len(data), at + (_CHUNK >> 3 if prime else _CHUNK))
        if to < len(data):
            cut = data.rfind(b" ", at, to)
            if cut < 0 and (cut := data.find(b" ", to)) < 0:
                cut = len(data)
            to = cut + 1
        codes = np.frombuffer(data[at:to], np.uint8)
        inside = np.zeros(len(codes) + 2, np.int8)
        inside[1:-1] = codes != 32
        edges = np.flatnonzero(np.diff(inside))
        starts, ends = edges[::2], edges[1::2]
        hashes.append(prime_numbers(codes, starts, ends) if prime else span_hashes(prefix_sums(codes), starts, ends))
        offsets.append(starts + at)
        at = to
    return np.concatenate(hashes), np.concatenate(offsets)


#: Lower-cases A-Z and turns the other blanks into spaces.
BLANKED = bytes(32 if b in b"\t\n\v\f\r" else LOWER[b] for b in range(256))


def document_words(texts: list[bytes], translation: bytes, prime: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order, and the number of words of each text."""
    hashes, offsets = word_hashes(b" ".join(texts).translate(translation), prime)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    upto = np.searchsorted(offsets, ends)
    return hashes, np.diff(upto, prepend=0)
