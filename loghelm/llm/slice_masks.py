"""Product codes of vectors, with exact nearest entries by slices and bitmasks.

A vector is cut into equal parts; each part gets the index of the nearest entry
of its position's codebook. Work is in whole numbers: a component x counts as
floor(scale * x), so results do not depend on the order of sums.

Search. Per codebook dimension the entries' coordinates are sorted, and prefix i
holds a mask of the entries among the first i. An initial radius comes from the
distances to the entries that lie next to the vector in each dimension: the
nearest entry is no farther than the least of these. The radius cuts one slice out of every sorted
dimension; the masks at its two ends give the entries of the slice, and the AND
over all dimensions the candidates: every entry within the radius, so the nearest one and
all its ties. Candidates are compared by their full distance, ties to the lower
index: pair by pair where they are few; where a radius takes in much of the codebook, as
in parts without clusters, all at once by a matrix product.

Fit. Each round is one pass over the table: every task adds up the parts per
entry and sends one row per entry it met, so a round moves a few
hundred rows a task and the driver holds the codebooks only (their size is a
parameter). The table is read again in every round, nothing is cached.

Cases: vectors that are null or hold null or non-finite components, that lack
the length of the least kept id's vector, or that reach 2**27 after scaling (a
distance would no longer be a whole number of 64 bits) are left out, as are empty ones; fewer
vectors than entries give smaller codebooks; a null id comes last in the order
of ids and keeps its row; repeated ids are ordered by their vectors; null labels
count together; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghelm.llm.common import store
from loghelm.operators.lookup import lookup

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Components at or beyond this have distances that 64 bits may not hold.
MOST = 1 << 27
#: Share of the entries from which on candidates are compared by a matrix product.
DENSE = 1 / 16
#: Vectors whose masks and candidate pairs are held at once.
BLOCK = 1024


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, v: the usable vectors as whole numbers."""
    x = F.col("embedding")
    fine = lambda e: e.isNotNull() & (F.abs(e.cast("double")) * scale < MOST - 1)  # noqa: E731  NaN is greater than any number
    usable = embeddings.where(x.isNotNull() & (F.size(x) > 0) & F.forall(x, fine))
    return usable.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").alias("label"),
        F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("int")).alias("v"),
    )


def seeds(vectors: DataFrame, entries: int, parts: int) -> np.ndarray | None:
    """The first codebooks (parts, entries, width): the parts of the vectors of the
    smallest ids. At most `entries` rows reach the driver."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    usable = vectors.where(F.size("v") % parts == 0)
    rows = usable.orderBy(*order).limit(entries).select("v").collect()
    if not rows:
        return None
    if any(len(r["v"]) != len(rows[0]["v"]) for r in rows):
        rows = usable.where(F.size("v") == len(rows[0]["v"])).orderBy(*order).limit(entries).select("v").collect()
    made = np.array([r["v"] for r in rows], np.int64)
    return np.ascontiguousarray(made.reshape(len(made), parts, -1).transpose(1, 0, 2))


class Slices:
    """One codebook, its coordinates sorted per dimension with prefix masks."""

    def __init__(self, book: np.ndarray):
        self.book = book
        n, width = book.shape
        self.words = -(-n // 64)
        self.order = np.argsort(book, axis=0, kind="stable")
        self.sorted = np.take_along_axis(book, self.order, axis=0)
        bits = np.zeros((n, self.words), np.uint64)
        bits[np.arange(n), np.arange(n) // 64] = np.uint64(1) << (np.arange(n, dtype=np.uint64) % np.uint64(64))
        #: prefix[j, i]: the entries of the i smallest coordinates of dimension j
        self.prefix = np.zeros((width, n + 1, self.words), np.uint64)
        for j in range(width):
            self.prefix[j, 1:] = np.bitwise_or.accumulate(bits[self.order[:, j]], axis=0)

    def radii(self, x: np.ndarray) -> np.ndarray:
        """Squared distance to the best of the entries that follow each vector in
        one of its dimensions."""
        best = np.full(len(x), np.iinfo(np.int64).max)
        for j in range(x.shape[1]):
            at = np.minimum(np.searchsorted(self.sorted[:, j], x[:, j]), len(self.book) - 1)
            away = x - self.book[self.order[at, j]]
            np.minimum(best, np.einsum("ij,ij->i", away, away), out=best)
        return best

    def candidates(self, x: np.ndarray, squared: np.ndarray) -> np.ndarray:
        """Masks (rows, words) of the entries within the radius in every dimension."""
        radius = np.ceil(np.sqrt(squared.astype(np.float64))).astype(np.int64) + 1
        masks = np.full((len(x), self.words), ~np.uint64(0))
        for j in range(x.shape[1]):
            low = np.searchsorted(self.sorted[:, j], x[:, j] - radius, "left")
            high = np.searchsorted(self.sorted[:, j], x[:, j] + radius, "right")
            masks &= self.prefix[j, high] ^ self.prefix[j, low]
        return masks

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of and squared distance to the nearest entry of each row."""
        index, error = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
        peak = max(int(np.abs(x).max(initial=0)), int(np.abs(self.book).max(initial=0)))
        exact_floats = 4 * x.shape[1] * peak * peak < 1 << 53
        for at in range(0, len(x), BLOCK):
            own = x[at : at + BLOCK]
            masks = self.candidates(own, self.radii(own))
            bits = np.unpackbits(masks.view(np.uint8), axis=1, bitorder="little", count=len(self.book)).view(bool)
            choose = self.among_many if exact_floats and bits.mean() > DENSE else self.among_few
            index[at : at + BLOCK], error[at : at + BLOCK] = choose(own, bits)
        return index, error

    def among_few(self, x: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best candidate of each row, by the distances of the candidate pairs alone."""
        rows, cols = np.nonzero(bits)
        away = np.take(x, rows, axis=0) - np.take(self.book, cols, axis=0)
        gaps = np.einsum("ij,ij->i", away, away)
        # pairs come by row and then by index: the first least gap of a row wins
        starts = np.searchsorted(rows, np.arange(len(x)))
        least = np.minimum.reduceat(gaps, starts)
        hits = np.flatnonzero(gaps == np.repeat(least, np.diff(starts, append=len(rows))))
        return cols[hits[np.searchsorted(rows[hits], np.arange(len(x)))]], least

    def among_many(self, x: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same where many entries are candidates: the distances of the block come
        from one matrix product, whole numbers below 2**53 throughout."""
        own, book = x.astype(np.float64), self.book.astype(np.float64)
        gaps = (own * own).sum(axis=1)[:, None] - 2 * (own @ book.T) + (book * book).sum(axis=1)
        gaps[~bits] = np.inf
        index = gaps.argmin(axis=1)
        return index, gaps[np.arange(len(x)), index].astype(np.int64)


def _parts(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """The vectors of a batch as (parts, rows, width)."""
    v = batch.column(batch.schema.get_field_index("v"))
    flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(v), parts, -1).transpose(1, 0, 2)


def round_sums(vectors: DataFrame, books: np.ndarray) -> dict[tuple[int, int], tuple[int, np.ndarray]]:
    """(part, entry): number and sum of the parts nearest to the entry."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books]
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for p, x in enumerate(_parts(batch, parts)):
                index, _ = slices[p].nearest(x)
                counts[p] += np.bincount(index, minlength=entries)
                order = np.argsort(index, kind="stable")
                first = np.flatnonzero(np.diff(index[order], prepend=-1))
                sums[p, index[order][first]] += np.add.reduceat(x[order], first, axis=0) if len(first) else 0
        met = np.argwhere(counts)
        columns = [met[:, 0], met[:, 1], counts[met[:, 0], met[:, 1]], *sums[met[:, 0], met[:, 1]].T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns], names)

    names = ["part", "entry", "n", *(f"s{j}" for j in range(width))]
    found = vectors.select("v").mapInArrow(run, ", ".join(f"{c} long" for c in names))
    added = found.groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in names[2:]))
    return {(r["part"], r["entry"]): (r["n"], np.array(r[3:], np.int64)) for r in added.collect()}


def fit(vectors: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after `rounds` rounds; an entry without parts stays."""
    for _ in range(rounds):
        books = books.copy()
        for (part, entry), (n, total) in round_sums(vectors, books).items():
            books[part, entry] = total // n
    return books


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encoded(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (two hex digits a part), error (squared distances added up)."""
    parts, entries, _ = books.shape
    digits = 2 * max(1, -(-(entries - 1).bit_length() // 8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books]
        for batch in batches:
            found = [slices[p].nearest(x) for p, x in enumerate(_parts(batch, parts))]
            codes = ["".join(f"{i:0{digits}x}" for i in row) for row in zip(*(i.tolist() for i, _ in found))]
            error = np.sum([e for _, e in found], axis=0)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("vec_id", "label")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(codes, pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def _label_key(label: str = "label") -> Column:
    """Equal labels have one key, so do null ones."""
    return F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("null"))


def product_codes(
    embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> DataFrame:
    """vec_id, code, error, label_error (error added up over equal labels),
    codebooks_sha256 of every usable vector."""
    vectors = whole_vectors(embeddings, scale)
    books = seeds(vectors, entries, parts)
    if books is None:
        schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        return embeddings.sparkSession.createDataFrame([], schema)
    vectors = vectors.where(F.size("v") == parts * books.shape[2])
    books = fit(vectors, books, rounds)
    made = store(encoded(vectors, books).withColumn("key", _label_key()), "codes")
    totals = store(made.groupBy("key").agg(F.sum("error").alias("label_error")), "label-errors")
    return lookup(made, totals, "key", ("vec_id",)).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )
