"""Product codes against plain loops."""

import hashlib
import math
import random

import numpy as np
import pytest

from loghelm.llm import slice_masks

SCHEMA = "vec_id long, embedding array<float>, label int, v string, code string, key string, error long"


def table(spark, rows):
    """Rows with columns whose names the operator uses inside."""
    return spark.createDataFrame([(*r, "v", "c", "k", 1) for r in rows], SCHEMA)


def brute(rows, parts=4, entries=256, rounds=4):
    kept = []
    for vec_id, v, label in rows:
        if v and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(1024 * float(np.float32(x))) for x in v], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    kept = [r for r in kept if len(r[1]) == width * parts]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    best = lambda x, book: min(range(len(book)), key=lambda i: (gap(x, book[i]), i))
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, v, _ in kept:
                members.setdefault(best(cut(v, p), books[p]), []).append(cut(v, p))
            for i, own in members.items():
                books[p][i] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    out, sums = [], {}
    for vec_id, v, label in kept:
        code = [best(cut(v, p), books[p]) for p in range(parts)]
        error = sum(gap(cut(v, p), books[p][i]) for p, i in enumerate(code))
        sums[label] = sums.get(label, 0) + error
        out.append((vec_id, "".join(f"{i:02x}" for i in code), error, label))
    return sorted(((i, c, e, sums[label], digest) for i, c, e, label in out), key=str)


def vectors(rng, n, width=12, spread=1.0):
    centers = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(9)]
    made = [[rng.gauss(c, spread) for c in rng.choice(centers)] for _ in range(n)]
    return [(i * 3 % n + 5, v, rng.choice([0, 1, 2, None])) for i, v in enumerate(made)]


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_codes_equal_brute_force(spark, spread):
    rows = vectors(random.Random(2), 400, spread=spread)
    rows += [rows[7], rows[7], (None, [0.5] * 12, 3), (9001, [1.0] * 12, 4)]
    rows += [(9002, None, 1), (9003, [1.0] * 11 + [None], 1), (9004, [float("nan")] * 12, 1), (9005, [float("inf")] + [0.0] * 11, 1)]
    rows += [(9006, [], 1), (9007, [1.0] * 8, 1)]
    got = result(slice_masks.product_codes(table(spark, rows).repartition(5)))
    assert got == brute(rows)


def test_fewer_vectors_than_entries_and_ties(spark):
    rows = [(i, [float(i % 3)] * 8, i % 2) for i in range(20)]
    assert result(slice_masks.product_codes(table(spark, rows))) == brute(rows)


def test_empty_table(spark):
    got = slice_masks.product_codes(table(spark, [(1, None, 1)]))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and got.count() == 0


@pytest.mark.parametrize("size", [7, 1 << 26])
def test_candidates_hold_every_nearest_entry(size):
    rng = np.random.default_rng(3)
    book = rng.integers(-size, size, (70, 5))
    book[3] = book[60]
    slices = slice_masks.Slices(book)
    x = np.concatenate([rng.integers(-size, size, (500, 5)), book])
    gaps = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
    least = gaps.min(axis=1)
    masks = slices.candidates(x, slices.radii(x))
    bits = np.unpackbits(masks.view(np.uint8), axis=1, bitorder="little", count=70).astype(bool)
    assert (slices.radii(x) >= least).all() and bits[gaps == least[:, None]].all()
    for choose in (slices.among_few, slices.among_many) if size < 100 else (slices.among_few,):
        index, error = choose(x, bits)
        assert (index == gaps.argmin(axis=1)).all() and (error == least).all()
    assert (slices.nearest(x)[0] == gaps.argmin(axis=1)).all()
    # near entries leave few candidates
    tight = slices.candidates(book, np.zeros(len(book), np.int64))
    assert np.bitwise_count(tight).sum() < 70 * 70 / (2 if size < 100 else 30)
