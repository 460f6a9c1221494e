"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams: lower-cased words, and runs of one, two and
three word shapes (a shape keeps punctuation and tells capitals, small letters
and digits, each run of one kind once; a word equal to the one before has a mark
of its own). A shape run also has an indicator for each power of two of its
count. Each indicator is scaled by the log ratio of its smoothed class counts;
a linear hinge-loss model is fitted on the scaled indicators by dual coordinate
descent, and a logistic curve through the margins of rows left out of the fit
turns margins into scores.

The model is fitted on a bounded sample of labelled rows (`fit_rows`, near
copies once) and holds `2 ** BITS` weights; every document is scored whole.

Cases: null and empty texts have the bias only; rows that repeat are scored each;
without labelled rows, or with one label only, every score is that label's share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghelm.llm.common import BLANKED, byte_texts, doc_text, document_words, fold, mix64, slices, store
from loghelm.llm.labelled import training_sample

BITS = 18
FIT_ROWS = 12_000
MAX_LEVEL = 8

_SHAPES = bytes(
    88 if 65 <= b <= 90 else 120 if 97 <= b <= 122 or b >= 128 else 57 if 48 <= b <= 57 else 32 if b in b"\t\n\v\f\r" else b
    for b in range(256)
)

_AS_IT_IS = bytes(range(256))  # BLANKED would make capitals small


def _shape_hashes(texts: list[bytes]) -> np.ndarray:
    """Hash of the shape of every word of the texts."""
    codes = np.frombuffer(b" ".join(texts).translate(_SHAPES), np.uint8)
    keep = np.ones(len(codes), bool)
    keep[1:] = codes[1:] != codes[:-1]
    hashes, _ = document_words([codes[keep].tobytes()], _AS_IT_IS)
    return hashes


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of all distinct indicators, ordered by both."""
    words, counts = document_words(texts, BLANKED)
    shapes = _shape_hashes(texts)
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), counts)
    again = np.zeros(len(words), bool)
    if len(words) > 1:
        again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    shapes = np.where(again, mix64(shapes + np.uint64(1)), shapes)
    salt = [np.uint64(11), np.uint64(13), np.uint64(17)]
    rows, hashes = [doc], [mix64(words + np.uint64(7))]
    run = shapes
    for k in range(3):
        if k:
            run = mix64(run[:-1] + shapes[k:] * np.uint64(3)) if len(run) else run
        own = doc[k:] if k else doc
        inside = own == doc[: len(own)]
        key = np.bitwise_or(own[inside].astype(np.uint64) << np.uint64(40), mix64(run[inside] + salt[k]) >> np.uint64(24))
        pairs, n = np.unique(key, return_counts=True)
        level = np.minimum(np.log2(n).astype(np.int64), MAX_LEVEL)
        every = np.repeat(pairs, level + 1)
        step = np.arange(len(every)) - np.repeat(np.cumsum(level + 1) - level - 1, level + 1)
        rows.append((every >> np.uint64(40)).astype(np.int64))
        hashes.append(mix64((every & np.uint64((1 << 40) - 1)) + step.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    flat = np.concatenate([h >> np.uint64(64 - BITS) for h in hashes]).astype(np.int64)
    pairs = np.unique(np.concatenate(rows) << BITS | flat)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def _rows(texts: list[bytes], most: int = 1 << 21) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, sizes, features) for runs of texts."""
    for a, b in slices(texts, most):
        row, feature = features(texts[a:b])
        yield a, np.bincount(row, minlength=b - a), feature


def dual_descent(
    indptr: np.ndarray, index: np.ndarray, value: np.ndarray, y: np.ndarray, c: np.ndarray, dims: int, epochs: int = 12
) -> np.ndarray:
    """Weights of the linear hinge-loss model min |w|^2/2 + sum c_i max(0, 1 - y_i w.x_i),
    by steps on one dual variable at a time, boxed to [0, c_i]."""
    w = np.zeros(dims)
    alpha = np.zeros(len(y))
    square = np.add.reduceat(np.append(value**2, 0), indptr[:-1]) * (np.diff(indptr) > 0)
    rng = np.random.default_rng(3)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            if square[i] <= 0:
                continue
            a, b = indptr[i], indptr[i + 1]
            own, x = index[a:b], value[a:b]
            gradient = y[i] * (w[own] @ x) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), c[i])
            if new != alpha[i]:
                w[own] += (new - alpha[i]) * y[i] * x
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def _curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through margins, by Newton steps."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, float(np.log((n1 + 1) / (n0 + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, h = p - target, np.maximum(p * (1 - p), 1e-9)
        grad = np.array([g @ margin, g.sum()]) + np.array([1e-3 * a, 0])
        hess = np.array([[h @ margin**2 + 1e-3, h @ margin], [h @ margin, h.sum()]]) + 1e-9 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return a, b


def fit(sizes: np.ndarray, feature: np.ndarray, y: np.ndarray, cost: float = 1.0) -> tuple[np.ndarray, float, float]:
    """Weight of every feature, and the slope and offset of the score curve."""
    dims = 1 << BITS
    share = float((y.mean() + 1) / 2) if len(y) else 0.5
    if not len(y) or abs(y.sum()) == len(y):
        return np.zeros(dims, np.float32), 0.0, float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    indptr = np.concatenate(([0], np.cumsum(sizes)))
    owner = np.repeat(y, sizes)
    p = np.bincount(feature[owner > 0], minlength=dims) + 1.0
    q = np.bincount(feature[owner < 0], minlength=dims) + 1.0
    seen = (p + q) > 3
    ratio = np.where(seen, np.log(p / p.sum()) - np.log(q / q.sum()), 0.0)
    norm = np.sqrt(np.maximum(np.bincount(np.repeat(np.arange(len(y)), sizes), ratio[feature] ** 2, len(y)), 1e-9))
    value = ratio[feature] / np.repeat(norm, sizes)
    c = np.where(y > 0, cost * len(y) / (2 * (y > 0).sum()), cost * len(y) / (2 * (y < 0).sum()))
    part = np.arange(len(y)) % 4 == 3
    fits = [dual_descent(*_pick(indptr, feature, value, ~part), y[~part], c[~part], dims)] if 20 < len(y) else []
    if fits and len({*y[part]}) == 2:
        ip, ix, va = _pick(indptr, feature, value, part)
        margin = np.add.reduceat(np.append(fits[0][ix] * va, 0), ip[:-1]) * (np.diff(ip) > 0)
        slope, offset = _curve(margin, y[part])
    else:
        slope, offset = 2.0, float(np.log(share / (1 - share)))
    w = dual_descent(indptr, feature, value, y, c, dims)
    return np.stack([w * ratio, ratio**2]).astype(np.float32), slope, offset


def _pick(indptr: np.ndarray, index: np.ndarray, value: np.ndarray, chosen: np.ndarray) -> tuple:
    sizes = np.diff(indptr)
    mask = np.repeat(chosen, sizes)
    return np.concatenate(([0], np.cumsum(sizes[chosen]))), index[mask], value[mask]


def fit_sample(sample: DataFrame) -> tuple[np.ndarray, float, float]:
    """Fit on a bounded sample of (label, text). Indicators are made in parallel;
    one task fits them, and only the weights reach the driver."""

    def indicators(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, out = byte_texts(batch, "text"), []
            for _, sizes, feature in _rows(texts):
                out += [f.astype(np.int32).tobytes() for f in np.split(feature, np.cumsum(sizes)[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["label", "made"])

    def one(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("label").to_pylist(), table.column("made").to_pylist()), key=lambda r: (r[1], r[0]))
        order = np.random.default_rng(1).permutation(len(rows))
        rows = [rows[i] for i in order]
        made = [np.frombuffer(r[1], np.int32) for r in rows]
        sizes = np.fromiter(map(len, made), np.int64, len(made))
        y = np.array([1.0 if r[0] else -1.0 for r in rows])
        weights, slope, offset = fit(sizes, np.concatenate(made), y)
        return pa.table({"weights": pa.array([weights.tobytes()], pa.binary()), "slope": [slope], "offset": [offset]})

    made = store(sample.mapInArrow(indicators, "label int, made binary"), "indicators")
    rows = made.groupBy().applyInArrow(one, "weights binary, slope double, offset double").collect()
    if not rows:
        return np.zeros((2, 1 << BITS), np.float32), 0.0, 0.0
    weights = np.frombuffer(rows[0]["weights"], np.float32)
    if len(weights) == 1 << BITS:
        weights = np.concatenate((weights, weights))
    return weights.reshape(2, -1), rows[0]["slope"], rows[0]["offset"]


def score(docs: DataFrame, model: tuple[np.ndarray, float, float]) -> DataFrame:
    """doc_id, score of every whole text."""
    weights, slope, offset = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch, "text")
            margin = np.zeros(len(texts))
            for a, sizes, feature in _rows(texts):
                row = np.repeat(np.arange(len(sizes)), sizes)
                total = np.bincount(row, weights[0][feature], len(sizes))
                norm = np.sqrt(np.maximum(np.bincount(row, weights[1][feature], len(sizes)), 1e-9))
                margin[a : a + len(sizes)] = total / norm
            made = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made)], ["doc_id", "score"])

    return doc_text(docs).mapInArrow(run, "doc_id long, score double")


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column | None = None,
    label: str = "quality",
    threshold: float = 0.3,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """doc_id, held_out, score, predicted. Labels of held-out ids are never read."""
    held_out = fold("doc_id", 5) == 0 if held_out is None else held_out
    model = fit_sample(training_sample(docs, labels, label, ~held_out, fit_rows))
    return score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
