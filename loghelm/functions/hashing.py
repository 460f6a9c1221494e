"""Signed feature hashing of a template into a unit vector: a column, or a matrix inside an Arrow step."""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from loghelm.functions.text import SPACE, WHITE_SPACE

DEFAULT_DIM = 384

# The steps as SQL, each a function of what the step before bound to a name
# (`transform(array(x), name -> ...)[0]` computes x once per row, however
# often the body reads it).

TOKENS = rf"filter(split(lower({{text}}), r'(?U){SPACE}+'), t -> t <> '')"

# Bin: the token's md5 as a 128-bit number modulo the dimension, taken 32 bits
# at a time so that it stays inside a BIGINT. Sign: the lowest bit.
SIGNED_BINS = """
transform({tokens}, token -> transform(array(md5(encode(token, 'UTF-8'))), digest -> named_struct(
    'bin', cast({remainder} AS INT),
    'sign', if(substr(digest, 32, 1) IN ('1', '3', '5', '7', '9', 'b', 'd', 'f'), 1D, -1D)))[0])
"""

# One entry per bin, in bin order: the sorted hits are cut where the bin changes.
BIN_SUMS = """
transform(array(array_sort(hits)), sorted -> transform(array(filter(
    transform(sorted, (h, i) -> if(i = 0 OR get(sorted, i - 1).bin <> h.bin, i, NULL)), p -> p IS NOT NULL)), starts ->
    transform(starts, (p, j) -> named_struct('bin', get(sorted, p).bin, 'total', aggregate(
        slice(sorted, p + 1, coalesce(get(starts, j + 1), size(sorted)) - p), 0D, (acc, h) -> acc + h.sign))))[0])[0]
"""

# Divided by the norm, in single precision.
UNIT_VALUES = """
transform(array(cast(sqrt(aggregate(sums, 0D, (acc, s) -> acc + s.total * s.total)) AS FLOAT)), norm ->
    transform(sums, s -> named_struct('bin', s.bin, 'value',
        if(norm > 0, cast(cast(cast(s.total AS FLOAT) / norm AS FLOAT) AS DOUBLE), 0D))))[0]
"""

# The entries with runs of zeros before each and after the last.
DENSE = """
flatten(concat(
    transform(entries, (e, i) -> concat(
        array_repeat(0D, e.bin - if(i = 0, -1, get(entries, i - 1).bin) - 1), array(e.value))),
    array(array_repeat(0D, {last} - if(size(entries) = 0, -1, get(entries, size(entries) - 1).bin)))))
"""


def _remainder(dim: int) -> str:
    word = lambda i: f"cast(conv(substr(digest, {1 + 8 * i}, 8), 16, 10) AS BIGINT)"
    out = f"{word(0)} % {dim}L"
    for i in (1, 2, 3):
        out = f"(({out}) * 4294967296L + {word(i)}) % {dim}L"
    return out


def tokens(text: str) -> Column:
    return F.expr(TOKENS.format(text=text))


def hash_embedding(text: str = "template", dim: int = DEFAULT_DIM) -> Column:
    """Hashed vector of a text column (zeros for a blank text).

    Row-local: no shuffle, so it serves distinct templates in batch and single
    rows in a stream alike.
    """
    let = lambda value, name, body: f"transform(array({value}), {name} -> {body})[0]"
    hits = SIGNED_BINS.format(tokens=TOKENS.format(text=text), remainder=_remainder(dim))
    dense = DENSE.format(last=dim - 1)
    return F.expr(let(hits, "hits", let(BIN_SUMS, "sums", let(UNIT_VALUES, "entries", dense))))


_GAPS = re.compile(f"[{WHITE_SPACE}]+")


def hash_matrix(lowered: list[str], dim: int = DEFAULT_DIM) -> np.ndarray:
    """The vectors of `hash_embedding` for texts that are in lower case, one row each, for
    Arrow steps that see a template many times."""
    totals = np.zeros((len(lowered), dim))
    for row, text in zip(totals, lowered):
        for token in _GAPS.split(text):
            if token:
                number = int.from_bytes(hashlib.md5(token.encode(), usedforsecurity=False).digest(), "big")
                row[number % dim] += 1.0 if number & 1 else -1.0
    norms = np.sqrt((totals**2).sum(axis=1)).astype(np.float32)[:, None]
    return np.divide(totals.astype(np.float32), norms, out=np.zeros(totals.shape, np.float32), where=norms > 0).astype(np.float64)
