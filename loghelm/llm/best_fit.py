"""Conflict-constrained best-fit packing.

Documents become pieces of at most `capacity` words. Full pieces fill a bin each;
the rest of every document is packed longest first. A bin carries a bitmap of the
sources and of the duplicate clusters it holds; a piece may enter only a bin that
holds neither its source nor its cluster. Bins are kept in the order of their
residual room: the search starts at the first bin with enough room and goes on to
its successors until a compatible one is found, which then is the tightest
compatible bin; if there is none, a new bin is opened.

Documents are dealt to shards of about `shard_rows` by a hash, whatever their
source, and every shard packs its own bins. Only lengths, sources and cluster
keys are shuffled, not the texts. The cluster of a document is a hash of its
lower-cased words, or a given column.

Cases: null and wordless texts take no room and get a row without a bin; a null
source conflicts with nothing; pieces of equal length are packed by id, then by
cluster; bins of equal room are tried in the order they were opened; rows that
repeat are packed each and, being one cluster, never together; an empty table
gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loghelm.llm.common import NO_ID, blank_words, byte_texts

CAPACITY = 2048
SHARD_ROWS = 4096

PACKED_SCHEMA = (
    "doc_id long, piece int, start long, length int, bin string, bin_offset int, bin_used int, source string, cluster long"
)


def best_fit(
    lengths: list[int], sources: list[str | None], clusters: list[int], capacity: int
) -> tuple[list[int], list[int]]:
    """Bin and offset of pieces in the given order."""
    bit: dict[str, int] = {}
    source_bits = [0 if s is None else 1 << bit.setdefault(s, len(bit)) for s in sources]
    shared = {c: i for i, c in enumerate(c for c, n in Counter(clusters).items() if n > 1)}
    cluster_bits = [1 << shared[c] if c in shared else 0 for c in clusters]
    by_room: list[tuple[int, int]] = []
    held_sources: list[int] = []
    held_clusters: list[int] = []
    bins, offsets = [], []
    for length, source, cluster in zip(lengths, source_bits, cluster_bits):
        at = bisect_left(by_room, (length, -1))
        while at < len(by_room):
            number = by_room[at][1]
            if not held_sources[number] & source and not held_clusters[number] & cluster:
                break
            at += 1
        if at < len(by_room):
            room, number = by_room.pop(at)
        else:
            room, number = capacity, len(held_sources)
            held_sources.append(0)
            held_clusters.append(0)
        held_sources[number] |= source
        held_clusters[number] |= cluster
        bins.append(number)
        offsets.append(capacity - room)
        insort(by_room, (room - length, number))
    return bins, offsets


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, n (words) and cluster of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [blank_words(t) for t in byte_texts(batch, "text")]
            keys = [xxhash.xxh64_intdigest(b" ".join(w)) - 2**63 for w in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(map(len, words)), pa.int64()), pa.array(keys, pa.int64())],
                ["doc_id", "source", "n", "cluster"],
            )

    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return own.mapInArrow(run, "doc_id long, source string, n long, cluster long")


def pack_sizes(sized: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Pack (doc_id, source, n, cluster): one row per piece with its bin."""
    shards = sized.count() // shard_rows + 1

    def run(key: tuple, group: pa.Table) -> pa.Table:
        rows = group.select(["doc_id", "source", "n", "cluster"]).to_pylist()
        rows.sort(key=lambda r: (-(r["n"] % capacity), NO_ID if r["doc_id"] is None else r["doc_id"], r["cluster"], r["n"], r["source"] or ""))
        out = []
        rest = [r for r in rows if r["n"] % capacity]
        bins, offsets = best_fit([r["n"] % capacity for r in rest], [r["source"] for r in rest], [r["cluster"] for r in rest], capacity)
        used: Counter = Counter()
        for row, number in zip(rest, bins):
            used[number] += row["n"] % capacity
        shard = key[0].as_py()
        for row, number, offset in zip(rest, bins, offsets):
            full = row["n"] // capacity
            out.append((row, full, full * capacity, row["n"] % capacity, f"{shard}-{number}", offset, used[number]))
        number = len(used)
        for row in rows:
            for piece in range(row["n"] // capacity):
                out.append((row, piece, piece * capacity, capacity, f"{shard}-{number}", 0, capacity))
                number += 1
            if not row["n"]:
                out.append((row, 0, 0, 0, None, None, None))
        columns = list(zip(*out))
        return pa.Table.from_arrays(
            [
                pa.array([r["doc_id"] for r in columns[0]], pa.int64()),
                *[pa.array(c, t) for c, t in zip(columns[1:], (pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32()))],
                pa.array([r["source"] for r in columns[0]], pa.string()),
                pa.array([r["cluster"] for r in columns[0]], pa.int64()),
            ],
            ["doc_id", "piece", "start", "length", "bin", "bin_offset", "bin_used", "source", "cluster"],
        )

    dealt = sized.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(run, PACKED_SCHEMA)


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, cluster_col: str | None = None
) -> DataFrame:
    """Pack whole documents; `cluster_col` names a LONG column of duplicate clusters."""
    if cluster_col is None:
        return pack_sizes(sizes(docs), capacity, shard_rows)
    counted = docs.withColumn("__own", F.col(cluster_col).cast("long"))
    own = counted.groupBy("doc_id").agg(F.min("__own").alias("__own"))
    sized = sizes(docs)
    joined = sized.join(own, sized["doc_id"].eqNullSafe(own["doc_id"]), "left").drop(own["doc_id"])
    return pack_sizes(joined.select("doc_id", "source", "n", F.coalesce("__own", "cluster").alias("cluster")), capacity, shard_rows)


