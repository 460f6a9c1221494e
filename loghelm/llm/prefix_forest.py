"""Approximate nearest neighbours by a forest of long hash strings.

Each tree gives every vector a string of 64 bits: the number of the nearest of a
few centres (fitted on a bounded sample), then the signs of random orthogonal
projections of the rest. A shard of the index keeps, for every tree, its strings
as one sorted array. A query descends each array to its longest common prefixes;
the counts of all trees and shards by prefix length are summed, and from the
longest prefix on, all trees ascend in step until together they hold enough
candidates. These are compared by their exact Euclidean distance.

Queries are taken in blocks of bounded size against all shards. `share` sets how
many candidates (repeats over the trees counted) a query gets, as a part of the
index, so recall does not fall with its size.

Cases: rows without an id, and vectors that are null, zero, of another length
than the most frequent one or that hold a null or non-finite component take no
part; equal vectors are candidates of their own, ties go to the smaller id; rows
that repeat a query's id are its own and no candidates; fewer candidates than
`k` are all returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loghelm.llm.common import store

TREES = 20
CENTERS = 16
CENTER_BITS = 4
#: Candidates of a query over all trees, as a part of the indexed rows.
SHARE = 0.7
FIT_ROWS = 5_000
SHARD_ROWS = 8_192
QUERY_BLOCK = 2_000

INDEX_SCHEMA = "ids binary, vectors binary, strings binary, places binary"


def clean_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v: the rows that take part."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = table.select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))
    own = own.where(F.col("vec_id").isNotNull() & finite.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    sizes = own.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return own.where(F.size("v") == (sizes["n"] if sizes else 0))


def _centers(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centers = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)].copy()
    for _ in range(8):
        near = _nearest(sample, centers)
        for j in range(len(centers)):
            if (near == j).any():
                centers[j] = sample[near == j].mean(axis=0)
    return centers


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers**2).sum(axis=1) - 2 * x @ centers.T, axis=1)


class Forest:
    """The hash functions of all trees."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, seed: int = 17):
        rng = np.random.default_rng(seed)
        dims, bits = sample.shape[1], 64 - CENTER_BITS
        self.parts = []
        for _ in range(trees):
            centers = _centers(sample, CENTERS, rng)
            turn = rng.standard_normal((dims, bits))
            if dims >= bits:
                turn, _ = np.linalg.qr(turn)
            self.parts.append((centers, turn))

    def strings(self, x: np.ndarray) -> np.ndarray:
        """trees x rows hash strings as unsigned numbers."""
        weights = np.uint64(1) << np.arange(63 - CENTER_BITS, -1, -1, dtype=np.uint64)
        out = np.empty((len(self.parts), len(x)), np.uint64)
        for t, (centers, turn) in enumerate(self.parts):
            near = _nearest(x, centers)
            bits = (x - centers[near]) @ turn > 0
            out[t] = (bits * weights).sum(axis=1, dtype=np.uint64) | near.astype(np.uint64) << np.uint64(64 - CENTER_BITS)
        return out


def fit_forest(vectors: DataFrame, trees: int = TREES, fit_rows: int = FIT_ROWS) -> Forest | None:
    """Centres from a sample of about `fit_rows` rows, drawn by a hash of the id."""
    total = vectors.count()
    if not total:
        return None
    share = min(1_000_000, fit_rows * 1_000_000 // total + 1)
    sample = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < share).orderBy("vec_id").limit(2 * fit_rows)
    rows = [r["v"] for r in sample.select("v").collect()] or [vectors.first()["v"]]
    return Forest(np.array(rows), trees)


def build_index(vectors: DataFrame, forest: Forest, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: ids, vectors, and per tree the sorted strings with the
    place of each. Stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, shard_rows):
                part = batch.slice(at, shard_rows)
                ids = part.column(0).to_numpy()
                x = part.column(1).flatten().to_numpy().reshape(len(ids), -1)
                strings = forest.strings(x)
                order = np.argsort(strings, axis=1, kind="stable").astype(np.int32)
                made = (ids, x, np.take_along_axis(strings, order, axis=1), order)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m.tobytes()], pa.binary()) for m in made], ["ids", "vectors", "strings", "places"]
                )

    return store(vectors.mapInArrow(run, INDEX_SCHEMA), "forest")


def _shards(batches: Iterator[pa.RecordBatch], trees: int) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids = np.frombuffer(batch.column(0)[i].as_py(), np.int64)
            n = len(ids)
            yield (
                ids,
                np.frombuffer(batch.column(1)[i].as_py(), np.float64).reshape(n, -1),
                np.frombuffer(batch.column(2)[i].as_py(), np.uint64).reshape(trees, n),
                np.frombuffer(batch.column(3)[i].as_py(), np.int32).reshape(trees, n),
            )


def _range(strings: np.ndarray, own: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the sorted strings that share the first `depth` bits with each of `own`."""
    rest = (np.uint64(64) - depth.astype(np.uint64)) % np.uint64(64)
    full = np.where(depth == 0, np.uint64(2**64 - 1), (np.uint64(1) << rest) - np.uint64(1))
    full = np.where(depth == 64, np.uint64(0), full)
    low = own & ~full
    return np.searchsorted(strings, low), np.searchsorted(strings, low | full, side="right")


def search(
    index: DataFrame, forest: Forest, queries: tuple[np.ndarray, np.ndarray], enough: int, k: int
) -> DataFrame:
    """query_id, vec_id, score: the best `k` candidates of every shard for a block
    of queries (ids, vectors)."""
    trees = len(forest.parts)
    q_ids, q = queries
    q_strings = forest.strings(q)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(q_ids), 65), np.int64)
        for _, _, strings, _ in _shards(batches, trees):
            for t in range(trees):
                for depth in range(65):
                    a, b = _range(strings[t], q_strings[t], np.full(len(q_ids), depth))
                    total[:, depth] += b - a
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(q_ids))), *[pa.array(total[:, d].copy()) for d in range(65)]],
            ["q", *[f"d{d}" for d in range(65)]],
        )

    names = [f"d{d}" for d in range(65)]
    counted = index.mapInArrow(count, "q long, " + ", ".join(f"{n} long" for n in names))
    rows = counted.groupBy("q").agg(*[F.sum(n).alias(n) for n in names]).collect()
    depths = np.zeros(len(q_ids), np.int64)
    for row in rows:
        held = np.array([row[n] for n in names])
        depths[row["q"]] = np.flatnonzero(held >= enough).max(initial=0)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, vectors, strings, places in _shards(batches, trees):
            bounds = [_range(strings[t], q_strings[t], depths) for t in range(trees)]
            out = []
            for i in range(len(q_ids)):
                near = np.zeros(len(ids), bool)
                for t in range(trees):
                    near[places[t, bounds[t][0][i] : bounds[t][1][i]]] = True
                near &= ids != q_ids[i]
                own = np.flatnonzero(near)
                apart = vectors[own] - q[i]
                score = np.sqrt(np.einsum("ij,ij->i", apart, apart))
                best = np.lexsort((ids[own], score))[:k]
                out.append((np.full(len(best), i), np.full(len(best), q_ids[i]), ids[own[best]], score[best]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*out)], ["q", "query_id", "vec_id", "score"]
                )

    return index.mapInArrow(compare, "q long, query_id long, vec_id long, score double")


def nearest(
    table: DataFrame,
    is_query: Column,
    k: int = 10,
    trees: int = TREES,
    share: float = SHARE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score of the `k` nearest found for the rows that
    `is_query` (a condition on `vec_id`) selects."""
    spark = table.sparkSession
    vectors = clean_vectors(table, id_col, vector_col)
    forest = fit_forest(vectors, trees)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if forest is None:
        return empty
    index = build_index(vectors, forest)
    total = vectors.count()
    enough = int(max(share * total, (k + 1) * trees))
    asked = vectors.where(is_query)
    blocks = asked.count() // query_block + 1
    out = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).collect()
        if not rows:
            continue
        block_queries = np.array([r["vec_id"] for r in rows]), np.array([r["v"] for r in rows])
        found = search(index, forest, block_queries, enough, k)
        best = Window.partitionBy("q").orderBy("score", "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        ranked = ranked.select("query_id", "rank", "vec_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    return empty if out is None else out
