"""Isolation forest (Liu, Ting, Zhou 2008) over weighted distinct vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghelm.functions.scoring import matrix
from loghelm.schemas import FOREST_NODES

TREES = 100
SAMPLE = 256
SEED = 42
EULER = 0.5772156649015329


def average_path(n):
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype=np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        long = 2.0 * (np.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))


def draw_samples(
    vectors: DataFrame, total: int, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED
) -> DataFrame:
    """Candidate rows (`tree`, `draw`, `embedding`) for every tree: `sample`
    lines drawn without replacement from all `total` lines, seen through the
    weighted table.

    Each line holds one uniform number per tree and the smallest numbers win.
    A template of n lines only has to produce its numbers below a bound that
    the winners stay under (their count there is binomial, seeded by its `key`),
    so the lines are not read again and a template with a third of them costs
    no more than any other. About 2 x `sample` candidates per tree pass the
    bound; that many keys are broadcast to pick up their vectors.
    """
    bound = min(1.0, (sample + 12.0 * math.sqrt(sample) + 50.0) / total)

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            drawn = []
            for key, n in zip(batch["key"].to_numpy(), batch["n"].to_numpy()):
                rng = np.random.default_rng([seed, int(key) & 0xFFFFFFFFFFFFFFFF])
                tree = np.repeat(np.arange(trees, dtype=np.int32), rng.binomial(n, bound, size=trees))
                if len(tree):
                    drawn.append((tree, rng.random(len(tree)) * bound, np.full(len(tree), key)))
            if drawn:
                tree, draw, key = (np.concatenate(column) for column in zip(*drawn))
                yield pd.DataFrame({"tree": tree, "draw": draw, "key": key})

    drawn = vectors.select("key", "n").mapInPandas(candidates, "tree int, draw double, key long")
    return vectors.select("key", "embedding").join(F.broadcast(drawn), "key").drop("key")


def grow_tree(tree: int, x: np.ndarray, limit: int, seed: int = SEED) -> pd.DataFrame:
    """Random axis, uniform split between the extremes, until alone or `limit`."""
    rng = np.random.default_rng([seed, tree])
    nodes: list[list] = []
    pending = [(np.arange(len(x)), 0, -1, "")]
    while pending:
        rows, depth, parent, side = pending.pop()
        node = len(nodes)
        nodes.append([tree, node, -1, 0.0, -1, -1, len(rows), depth])
        if parent >= 0:
            nodes[parent][4 if side == "left" else 5] = node
        if depth >= limit or len(rows) <= 1:
            continue
        part = x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        open_axes = np.flatnonzero(high > low)
        if len(open_axes) == 0:
            continue
        axis = int(rng.choice(open_axes))
        cut = float(rng.uniform(low[axis], high[axis]))
        if cut >= high[axis]:
            cut = float(low[axis])
        goes_left = part[:, axis] <= cut
        nodes[node][2:4] = [axis, cut]
        pending.append((rows[~goes_left], depth + 1, node, "right"))
        pending.append((rows[goes_left], depth + 1, node, "left"))
    return pd.DataFrame(nodes, columns=FOREST_NODES.names)


def fit_forest(
    vectors: DataFrame, total: int, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED
) -> DataFrame:
    """Node table of the forest from rows (`embedding`, `n`, `key`). One task grows one tree from at most a few
    hundred rows, whatever the size of the log."""
    sample = min(sample, total)
    limit = math.ceil(math.log2(max(sample, 2)))

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # The vector breaks ties, so the drawn set never depends on arrival order.
        x = np.stack(rows["embedding"].to_numpy())
        chosen = np.lexsort((*x.T[::-1], rows["draw"].to_numpy()))[:sample]
        return grow_tree(int(key[0]), x[chosen], limit, seed)

    drawn = draw_samples(vectors, total, trees, sample, seed)
    return drawn.groupBy("tree").applyInPandas(grow, FOREST_NODES)


class Forest:
    """Node arrays of all trees, small enough for every task: their number is
    bounded by trees x 2 x sample."""

    def __init__(self, nodes: pd.DataFrame):
        self.trees = []
        sizes = []
        for _, tree in nodes.sort_values(["tree", "node"]).groupby("tree"):
            feature, left, right = (tree[c].to_numpy(np.int64) for c in ("feature", "left", "right"))
            path = tree["depth"].to_numpy(np.float64) + average_path(tree["n"].to_numpy())
            self.trees.append((feature, tree["split"].to_numpy(np.float64), left, right, path))
            sizes.append(int(tree.loc[tree["node"] == 0, "n"].iloc[0]))
        self.scale = float(average_path(max(sizes)))

    def isolation(self, x: np.ndarray) -> np.ndarray:
        """2^(-mean path / normal path): near 1 for rows that part early."""
        total = np.zeros(len(x))
        for feature, split, left, right, path in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            moving = np.flatnonzero(feature[at] >= 0)
            while len(moving):
                here = at[moving]
                below = x[moving, feature[here]] <= split[here]
                at[moving] = np.where(below, left[here], right[here])
                moving = moving[feature[at[moving]] >= 0]
            total += path[at]
        mean = total / len(self.trees)
        return np.exp2(-mean / self.scale) if self.scale > 0 else np.full(len(x), 0.5)


def isolation(embedding: Column, forest: Forest) -> Column:
    @F.arrow_udf("double")
    def score(vectors: pa.Array) -> pa.Array:
        return pa.array(forest.isolation(matrix(vectors)))

    return score(embedding)
