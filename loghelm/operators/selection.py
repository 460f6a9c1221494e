"""Exact order statistics without a sort: histograms over the bits of the values.

The 64 bits of a double, with the sign turned, order like the double itself. A pass counts the weights by the
16 bits that follow the prefixes under search, all columns and all ranks at once; only
histograms leave a task. When few rows are left under the prefixes, their values are fetched and
the search ends; otherwise four passes know every bit. The rows are never sorted or shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGIT_BITS = 16
FINISH_ROWS = 20_000
_SIGN = np.uint64(1 << 63)
_COUNTED = "col INT, prefix BIGINT, digit BIGINT, weight BIGINT, entries BIGINT"


def order_bits(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the doubles; -0.0 is 0.0 and NaN comes last."""
    canonical = np.where(np.isnan(values), np.nan, values) + 0.0
    bits = canonical.view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def value_of(key: int) -> float:
    """The double of an order number."""
    bits = np.uint64(key)
    return float((bits ^ _SIGN if bits & _SIGN else ~bits).view(np.float64))


def weighted_quantiles(
    df: DataFrame, percents: dict[str, tuple[float, ...]], weight: str, finish_rows: int = FINISH_ROWS
) -> dict[str, list[float | None]]:
    """Linear-interpolated percentiles of the columns, a row counting `weight` times, as
    {column: [value per percent]}; percent 0 and 100 give the least and the greatest value. NULL values, and
    rows without a weight or of weight zero, do not count; a column with none left has None. A negative weight raises.

    `df` is read two to five times; pass a stored table. At most `finish_rows` distinct
    values and 65,536 counts per column and rank reach the driver at once.
    """
    if any(not 0 <= p <= 100 for ps in percents.values() for p in ps):
        raise ValueError("percentile must lie between 0 and 100")
    names = list(percents)
    columns = [F.col(n).cast("double").alias(f"v{i}") for i, n in enumerate(names)]
    rows = df.select(*columns, F.col(weight).cast("long").alias("w"))
    first = _count(rows, {i: [0] for i in range(len(names))}, 0, DIGIT_BITS)
    totals = {i: int(digits["weight"].sum()) for (i, _), digits in first.items()}
    ranks = {i: _ranks(totals.get(i, 0), percents[n]) for i, n in enumerate(names)}
    #: per column and rank: known leading bits, and the rank among the values that have them
    search = {(i, r): (0, r) for i in ranks for pair in ranks[i] for r in pair[1:]}
    found = _search(rows, search, first, finish_rows)
    return {n: [_between(found, i, *r) for r in ranks[i]] if ranks[i] else [None] * len(percents[n]) for i, n in enumerate(names)}


def _ranks(total: int, percents: tuple[float, ...]) -> list[tuple[float, int, int]]:
    exact = [(total - 1) * (p / 100) for p in percents] if total else []
    return [(rank, math.floor(rank), math.ceil(rank)) for rank in exact]


def _between(found: dict[tuple[int, int], float], col: int, rank: float, low: int, high: int) -> float:
    a, b = found[col, low], found[col, high]
    return a if a == b or low == high else (high - rank) * a + (rank - low) * b


def _search(rows: DataFrame, search: dict, counts: dict, finish_rows: int) -> dict[tuple[int, int], float]:
    known = 0
    while search:
        left = {}
        for (col, rank), (prefix, inside) in search.items():
            digits = counts[col, prefix]
            upto = np.cumsum(digits["weight"])
            at = int(np.searchsorted(upto, inside, side="right"))
            before = int(upto[at - 1]) if at else 0
            step = digits["bits"]
            found = prefix << step | int(digits["digit"][at])
            search[col, rank] = (found, inside - before)
            left[col, found] = int(digits["entries"][at])
        known += step
        if known == 64:
            break
        wanted: dict[int, list[int]] = {}
        for col, prefix in left:
            wanted.setdefault(col, []).append(prefix)
        rest = 64 - known
        counts = _count(rows, wanted, known, rest if sum(left.values()) <= finish_rows else DIGIT_BITS)
    return {place: value_of(key) for place, (key, _) in search.items()}


def _count(rows: DataFrame, prefixes: dict[int, list[int]], known: int, bits: int) -> dict[tuple[int, int], dict]:
    """Weights and entries by the `bits` bits that follow the prefixes of `known` bits, in their order."""
    active = {col: np.array(sorted(found), dtype=np.uint64) for col, found in prefixes.items()}
    parts = rows.mapInArrow(_counter(active, known, bits), _COUNTED)
    sums = parts.groupBy("col", "prefix", "digit").agg(F.sum("weight").alias("weight"), F.sum("entries").alias("entries"))
    table = sums.toArrow()
    col, prefix, digit = (table[n].to_numpy() for n in ("col", "prefix", "digit"))
    digit, prefix = digit.view(np.uint64), prefix.view(np.uint64)
    out = {}
    for c, found in active.items():
        for p in found:
            mine = np.flatnonzero((col == c) & (prefix == p))
            mine = mine[np.argsort(digit[mine])]
            if len(mine):
                sorted_counts = {n: table[n].to_numpy()[mine] for n in ("weight", "entries")}
                out[c, int(p)] = {"digit": digit[mine], "bits": bits, **sorted_counts}
    return out


def _counter(active: dict[int, np.ndarray], known: int, bits: int) -> Callable:
    def batches_to_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            weight = batch["w"].fill_null(0).to_numpy(zero_copy_only=False)
            if (weight < 0).any():
                raise ValueError("a weight is negative")
            for col, found in active.items():
                column = batch[f"v{col}"]
                use = (weight > 0) & column.is_valid().to_numpy(zero_copy_only=False)
                keys = order_bits(column.fill_null(0.0).to_numpy(zero_copy_only=False)[use])
                w = weight[use]
                above = keys >> np.uint64(64 - known) if known else np.zeros(len(keys), np.uint64)
                low = keys << np.uint64(known) >> np.uint64(64 - bits)
                for p in found:
                    here = above == p
                    if here.any():
                        held[col, int(p)] = _merged(held.get((col, int(p))), low[here], w[here])
        yield from (_rows_of(col, p, counts) for (col, p), counts in held.items())

    return batches_to_counts


def _merged(held: list[np.ndarray] | None, digits: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Distinct digits with their weights and entries, those held before included."""
    entries = np.ones(len(digits), np.int64)
    if held is not None:
        digits, weights, entries = (np.concatenate(pair) for pair in zip(held, (digits, weights, entries)))
    distinct, place = np.unique(digits, return_inverse=True)
    sums = [np.zeros(len(distinct), np.int64) for _ in range(2)]
    np.add.at(sums[0], place, weights)
    np.add.at(sums[1], place, entries)
    return [distinct, *sums]


def _rows_of(col: int, prefix: int, counts: list[np.ndarray]) -> pa.RecordBatch:
    digit, weight, entries = counts
    n = len(digit)
    prefixes = np.full(n, prefix, np.uint64).view(np.int64)
    columns = [pa.array(np.full(n, col, np.int32)), pa.array(prefixes), pa.array(digit.view(np.int64)), pa.array(weight), pa.array(entries)]
    return pa.RecordBatch.from_arrays(columns, ["col", "prefix", "digit", "weight", "entries"])


def weighted_percentiles(
    df: DataFrame, values: tuple[str, ...], weight: str, percent: float, finish_rows: int = FINISH_ROWS
) -> dict[str, float | None]:
    """One percentile of each column, a row counting `weight` times; see `weighted_quantiles`."""
    found = weighted_quantiles(df, {v: (percent,) for v in values}, weight, finish_rows)
    return {v: found[v][0] for v in values}
