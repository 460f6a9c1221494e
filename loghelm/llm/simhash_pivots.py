"""SimHash near-duplicates by pivot distance tables.

Fingerprints: the majority bit of the XXH64 values of all word shingles.
Links: two fingerprints with at most `max_bits` differing bits.

Search. Every distinct fingerprint is cut into `max_bits + 4` blocks of bits;
two linked ones agree in at least four of them, so each choice of four blocks is
a key under which all links meet. A key leaves about a third of the bits free, so
the distinct fingerprints under it are bounded by the fingerprint width, however
many rows there are. Under one key, a table holds the Hamming distance of each
fingerprint to many fixed reference fingerprints; a pair whose distances to any
reference differ by more than `max_bits` can not be linked and is discarded,
survivors are verified by their differing bits. Links are returned as
(smallest member of the linked set under the key, member), so their number is
linear in the fingerprints; no link between sets is lost, and copies never
become pairs.

Components: minimum labels spread over the links with pointer jumping, all as
joins and aggregations.

Cases: a null or wordless text has fingerprint 0 and links like any other;
texts shorter than a shingle give one shingle of all their words; repeated rows
and equal texts share a fingerprint; null ids never are the smallest unless all
of a component are null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loghelm.llm.common import blank_words, byte_texts, doc_text, popcount, store
from loghelm.llm.suffix_arrays import unique_ids

SHINGLE = 3
MAX_BITS = 2
SEED = 42
PIVOTS = 24
#: Shingle hashes whose bits are counted at once.
BIT_CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the shingle hashes of one text."""
    words = blank_words(text)
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = len(words) - size + 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, count, BIT_CHUNK):
        to = min(count, at + BIT_CHUNK)
        cuts = zip(starts[at:to].tolist(), ends[at + size - 1 : to + size - 1].tolist())
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in cuts), np.uint64, to - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp: the fingerprint of each row as a signed LONG."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t, shingle) for t in byte_texts(batch, "text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], ["doc_id", "fp"])

    return doc_text(docs).mapInArrow(run, "doc_id long, fp long")


def _blocks(max_bits: int) -> list[tuple[int, ...]]:
    edges = [round(64 * i / (max_bits + 4)) for i in range(max_bits + 5)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(masks, 4)]


def pivot_links(values: np.ndarray, max_bits: int, pivots: int = PIVOTS) -> np.ndarray:
    """For distinct fingerprints (unsigned), the smallest member of the set that
    each one is connected to by links of at most `max_bits`."""
    values = np.sort(values)
    n = len(values)
    root = np.arange(n)
    if n < 2:
        return values
    refs = np.random.default_rng(7).integers(0, 2**64, pivots, dtype=np.uint64)
    first = popcount(values ^ refs[0]).astype(np.int16)
    order = np.argsort(first, kind="stable")
    first = first[order]
    table = np.stack([popcount(values[order] ^ r) for r in refs[1:]]).astype(np.int16)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    ends = np.searchsorted(first, first + max_bits, side="right")
    for at in range(0, n, 256):
        # pairs (row, later row) whose first coordinates are close, in slabs of bounded size
        to = min(n, at + 256)
        for left in range(at, ends[to - 1], 4096):
            right = min(int(ends[to - 1]), left + 4096)
            rows, cols = np.nonzero(
                (np.arange(left, right)[None, :] > np.arange(at, to)[:, None])
                & (first[None, left:right] - first[at:to, None] <= max_bits)
            )
            rows, cols = rows + at, cols + left
            for line in table:
                if not len(rows):
                    break
                near = np.abs(line[rows] - line[cols]) <= max_bits
                rows, cols = rows[near], cols[near]
            if len(rows):
                a, b = order[rows], order[cols]
                linked = popcount(values[a] ^ values[b]) <= max_bits
                for i, j in zip(a[linked].tolist(), b[linked].tolist()):
                    i, j = find(i), find(j)
                    if i != j:
                        root[max(i, j)] = min(i, j)
    return values[[find(i) for i in range(n)]]


def links(fps: DataFrame, max_bits: int = MAX_BITS, pivots: int = PIVOTS) -> DataFrame:
    """a, b: edges that connect the linked distinct fingerprints of column `fp`."""
    masks = _blocks(max_bits)

    def run(_key: tuple, group: pa.Table) -> pa.Table:
        values = group.column("fp").to_numpy().view(np.uint64)
        values = np.sort(values)
        least = pivot_links(values, max_bits, pivots)
        moved = least != values
        return pa.table({"a": least[moved].view(np.int64), "b": values[moved].view(np.int64)})

    signed = [m - 2**64 if m >= 2**63 else m for m in masks]
    keys = F.array(
        *[F.struct(F.lit(i).alias("side"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(signed)]
    )
    keyed = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.side", "k.part")
    counted = keyed.groupBy("side", "part").agg(F.count("*").alias("n")).where("n > 1")
    met = keyed.join(counted.select("side", "part"), ["side", "part"])
    return met.groupBy("side", "part").applyInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: for every node of the edges, the smallest node it can reach.

    Each round takes the least label among the neighbours and follows one label
    further; stars meet in few rounds. Every round is stored, so a lost executor
    costs one round.
    """
    edges = store(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = store(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("root").alias("near"))
        met = labels.join(near, labels.node == near.a).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root")
        )
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("further"))
        made = store(
            met.join(jump, "root", "left").select("node", "old", F.least("root", "further").alias("root")), "labels"
        )
        labels = made.select("node", "root")
        if made.where("root <> old").isEmpty():
            return labels


def simhash_components(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, pivots: int = PIVOTS
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    fps = store(fingerprints(docs, shingle), "fingerprints")
    classes = store(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(classes.select("fp"), max_bits, pivots))
    of_class = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = of_class.groupBy("root").agg(F.min("least").alias("component_id"))
    known = of_class.join(least, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return fps.join(known, "fp").select("doc_id", hexed, "component_id")


def keep_one_per_component(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component: that of the smallest id, of equal ids the one of the
    smallest text; a row without an id only if no row of its component has one."""
    numbered = unique_ids(docs.withColumn("__text", F.col("text")))
    # numbers of rows without an id start at 0; they go behind all others
    numbered = numbered.withColumn("id", F.when(F.col("doc_id").isNull(), F.col("id") + F.lit(1 << 62)).otherwise(F.col("id")))
    found = simhash_components(numbered.select(F.col("id").alias("doc_id"), "text"), shingle, max_bits)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("id"))
    rows = numbered.join(kept, "id", "left_semi")
    own = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text": F.col("rest.__text").alias("text")}
    return rows.select(*[own.get(c, F.col(f"rest.{c}")) for c in docs.columns])
