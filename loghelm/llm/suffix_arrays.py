"""Exact removal of repeated passages by suffix arrays.

Every string of `SPAN` bytes that also starts earlier in the corpus is covered;
the bytes under covered strings are removed.

1. Cells. The least hash of the 32-byte grams inside a window of `SPAN` bytes is
   its anchor; neighbouring windows with the same anchor form a cell. Equal
   windows have equal anchors, so a window can repeat only if its anchor does.
   Anchors are counted over the whole corpus as packed numbers; a task sends an
   anchor that it saw several times once.
2. Cells with a repeated anchor are cut out of the texts. A task that holds the
   same cell several times sends its first one on; the others are covered.
3. Shards. Cells meet in shards by their anchor. A shard builds one suffix array
   over its distinct cells, by Larsson-Sadakane refinement in numpy, and the
   common prefixes by Kasai's walk, in step over all cells. Neighbours with a
   common prefix of at least `SPAN` bytes are equal windows; all but the first
   in corpus order are covered.
4. Merging. The cells of an anchor with very many of them are dealt to several
   shards. Windows sampled from their sorted distinct windows cut an anchor's
   windows into ranges, as many as its windows need; the shards' windows are cut at
   these by binary search, and the ranges of all shards are merged by binary
   search, again keeping the first occurrence.
5. The covered spans of a document meet its text, which is cut.

Cases: a null text is empty; texts shorter than `SPAN` lose nothing; matches
never cross documents and may overlap; rows that repeat an id are documents of
their own, ordered by their texts; null ids come first; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loghelm.llm.common import (
    byte_texts,
    longs,
    prefix_sums,
    slices,
    span_hashes,
    store,
)

SPAN = 100
GRAM = 32
#: Bytes that are compared at once.
WORD = 7
#: Text bytes whose windows are looked at together.
BLOCK = 512 << 10
#: Cells that a task holds before it sends them on.
HELD_CELLS = 1_000_000
#: Text bytes whose anchors meet in one group, and bytes of cells in one shard.
BUCKET_BYTES = 4 << 20
SHARD_BYTES = 512 << 10
#: Cells of one anchor in one shard.
HOT_CELLS = 10_000
#: Sorted windows of a shard in one row, and such rows that one range holds on average.
RUN_WINDOWS = 4096
RANGE_RUNS = 8

ANCHOR = np.dtype([("key", "<u8"), ("doc", "<i8"), ("first", "<i4"), ("size", "<i4")])
CELL = np.dtype([("key", "<u8"), ("first", "<i4"), ("size", "<i4")])


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of `width` values from each place on (places past the end are ignored)."""
    out, reach = values.copy(), 1
    while reach * 2 <= width:
        out[:-reach] = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    if width > reach and len(out) > width - reach:
        out[: -(width - reach)] = np.minimum(out[: -(width - reach)], out[width - reach :])
    return out


def cells(texts: list[bytes], span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text number, first window, bytes, anchor hash) of the cells of texts that
    together have at most a block of bytes."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer(b"".join(texts), np.uint8)
    n, ends = len(codes), np.cumsum(sizes)
    starts = ends - sizes
    edge = np.zeros(n + 1, np.int32)
    long_enough = sizes >= span
    np.add.at(edge, starts[long_enough], 1)
    np.add.at(edge, ends[long_enough] - span + 1, -1)
    windows = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    if not len(windows):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.astype(np.uint64)
    grams = np.arange(n - gram + 1)
    hashes = np.full(n, np.uint64(2**64 - 1))
    hashes[: len(grams)] = span_hashes(prefix_sums(codes), grams, grams + gram)
    place = np.uint64((1 << 21) - 1)
    least = _sliding_min((hashes & ~place) | np.arange(n, dtype=np.uint64), span - gram + 1)
    anchor = (least[windows] & place).astype(np.int64)
    new = np.ones(len(windows), bool)
    new[1:] = (np.diff(anchor) != 0) | (np.diff(windows) != 1)
    at = np.flatnonzero(new)
    first = windows[at]
    last = windows[np.append(at[1:], len(windows)) - 1]
    text = np.searchsorted(starts, first, side="right") - 1
    return text, first - starts[text], last - first + span, hashes[anchor[at]]


def _pieces(texts: list[bytes], span: int) -> Iterator[tuple[int, int, bytes]]:
    """(text number, offset, bytes): long texts in pieces that share no window."""
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - span + 1), BLOCK - span):
            yield i, at, text[at : at + BLOCK - 1]


def document_cells(texts: list[bytes], span: int = SPAN, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """`cells` of all texts, run by run, with text numbers and offsets put right."""
    parts = list(_pieces(texts, span))
    if span <= gram:
        raise ValueError("the span must be longer than the gram")
    raw = [p[2] for p in parts]
    for a, b in slices(raw, BLOCK):
        text, first, size, key = cells(raw[a:b], span, gram)
        number = np.array([p[0] for p in parts[a:b]], dtype=np.int64)
        offset = np.array([p[1] for p in parts[a:b]], dtype=np.int64)
        yield number[text], first + offset[text], size, key


def unique_ids(docs: DataFrame) -> DataFrame:
    """doc_id, text, rest (the other columns), id: `id` is unique and has the order
    of (doc_id, text). The ids themselves, where they do not repeat."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    kept = F.struct(*rest) if rest else F.lit(None).cast("string")
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), kept.alias("rest")
    )
    if own.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        return own.withColumn("id", F.col("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            made = pa.array(np.arange(number, number + batch.num_rows))
            number += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, made], ["doc_id", "text", "rest", "id"])

    order = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    ordered = own.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([*own.schema.fields, T.StructField("id", T.LongType())])
    return store(ordered.mapInArrow(run, schema), "numbered")


def _by_doc(doc: np.ndarray, made: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(document, its entries of `made` packed)."""
    order = np.argsort(doc, kind="stable")
    doc, made = doc[order], made[order]
    cut = np.flatnonzero(np.diff(doc)) + 1
    for part_doc, part in zip(doc[np.concatenate(([0], cut))] if len(doc) else [], np.split(made, cut)):
        yield int(part_doc), part.tobytes()


def repeated_cells(docs: DataFrame, span: int = SPAN, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """id, payload: packed cells whose anchor occurs more than once."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = total // bucket_bytes + 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> Iterator[pa.RecordBatch]:
            made = np.concatenate(held)
            made = made[np.argsort(made["key"], kind="stable")]
            first = np.flatnonzero(np.diff(made["key"], prepend=~made["key"][:1]))
            counts = np.diff(first, append=len(made))
            known = made[np.repeat(counts > 1, counts)]
            sent = made[first].copy()
            sent["size"][counts > 1] = 0
            sent["doc"][counts > 1] = 0
            sent["first"][counts > 1] = 0
            bucket = (sent["key"].astype(np.float64) / 2.0**64 * buckets).astype(np.int64).clip(0, buckets - 1)
            rows = [(b, None, p) for b, p in _by_columns(bucket, sent)]
            own = np.empty(len(known), CELL)
            for name in CELL.names:
                own[name] = known[name]
            rows += [(buckets + d % buckets, d, p) for d, p in _by_doc(known["doc"], own)]
            for at in range(0, len(rows), 5000):
                part = list(zip(*rows[at : at + 5000]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[0], pa.int64()), pa.array(part[1], pa.int64()), pa.array(part[2], pa.binary())],
                    ["bucket", "id", "payload"],
                )

        held, size = [], 0
        for batch in batches:
            ids = longs(batch, "id")
            for text, first, length, key in document_cells(byte_texts(batch, "text"), span, gram):
                made = np.empty(len(text), ANCHOR)
                made["key"], made["doc"], made["first"], made["size"] = key, ids[text], first, length
                held.append(made)
                size += len(made)
                if size >= HELD_CELLS:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    def meet(key: tuple, group: pa.Table) -> pa.Table:
        if key[0].as_py() >= buckets:
            return group.select(["id", "payload"])
        made = np.concatenate([_from_columns(p) for p in group.column("payload").to_pylist()])
        made = made[np.argsort(made["key"], kind="stable")]
        first = np.flatnonzero(np.diff(made["key"], prepend=~made["key"][:1]))
        counts = np.diff(first, append=len(made))
        # a size of 0 stands for several cells of one task, which has sent them itself
        lone = np.repeat(counts == 1, counts)
        made = made[~lone & (made["size"] > 0)]
        own = np.empty(len(made), CELL)
        for name in CELL.names:
            own[name] = made[name]
        rows = list(_by_doc(made["doc"], own))
        return pa.table({"id": pa.array([r[0] for r in rows], pa.int64()), "payload": pa.array([r[1] for r in rows], pa.binary())})

    sent = docs.select("id", "text").mapInArrow(scan, "bucket long, id long, payload binary")
    return sent.groupBy("bucket").applyInArrow(meet, "id long, payload binary")


def _by_columns(bucket: np.ndarray, made: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, its anchors column by column, which packs better)."""
    cut = np.flatnonzero(np.diff(bucket)) + 1
    for number, part in zip(bucket[np.concatenate(([0], cut))] if len(bucket) else [], np.split(made, cut)):
        yield int(number), b"".join(part[n].tobytes() for n in ANCHOR.names)


def _from_columns(payload: bytes) -> np.ndarray:
    n = len(payload) // ANCHOR.itemsize
    out, at = np.empty(n, ANCHOR), 0
    for name in ANCHOR.names:
        out[name] = np.frombuffer(payload, ANCHOR[name], n, at)
        at += n * ANCHOR[name].itemsize
    return out


FOUND_SCHEMA = "key long, cell binary, id long, first int, spans binary"


def _spans(found: dict[int, list[int]]) -> Iterator[pa.RecordBatch]:
    """Rows of covered spans, one per document."""
    items = list(found.items())
    for at in range(0, len(items), 5000):
        part = items[at : at + 5000]
        n = len(part)
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(n, pa.int64()),
                pa.nulls(n, pa.binary()),
                pa.array([p[0] for p in part], pa.int64()),
                pa.nulls(n, pa.int32()),
                pa.array([np.array(p[1], "<i4").tobytes() for p in part], pa.binary()),
            ],
            ["key", "cell", "id", "first", "spans"],
        )


def _cells(seen: dict[bytes, tuple[int, int, int]]) -> Iterator[pa.RecordBatch]:
    items = list(seen.items())
    for at in range(0, len(items), 5000):
        part = items[at : at + 5000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p[1][2] for p in part], pa.int64()),
                pa.array([p[0] for p in part], pa.binary()),
                pa.array([p[1][0] for p in part], pa.int64()),
                pa.array([p[1][1] for p in part], pa.int32()),
                pa.nulls(len(part), pa.binary()),
            ],
            ["key", "cell", "id", "first", "spans"],
        )


def _first_one(seen: dict, cell: bytes, doc: int, first: int, key: int, covered: dict[int, list[int]]) -> None:
    """Keep the first occurrence of a cell; any other one is covered."""
    old = seen.get(cell)
    if old is None:
        seen[cell] = (doc, first, key)
        return
    if (doc, first) < old[:2]:
        seen[cell] = (doc, first, key)
        doc, first = old[:2]
    elif (doc, first) == old[:2]:
        return
    covered[doc] += (first, first + len(cell))


def cut_cells(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The cells of `wanted` as bytes, first ones only, and the spans that later
    ones cover. Stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple[int, int, int]] = {}
        covered: dict[int, list[int]] = defaultdict(list)
        size = 0
        for batch in batches:
            ids = longs(batch, "id").tolist()
            for doc, text, packed in zip(ids, byte_texts(batch, "text"), batch.column(2).to_pylist()):
                made = np.frombuffer(b"".join(packed), CELL)
                own = zip(made["key"].view(np.int64).tolist(), made["first"].tolist(), made["size"].tolist())
                for key, first, length in own:
                    _first_one(seen, text[first : first + length], doc, first, key, covered)
                size += len(made)
            if size >= HELD_CELLS:
                yield from _cells(seen)
                yield from _spans(covered)
                seen, covered, size = {}, defaultdict(list), 0
        yield from _cells(seen)
        yield from _spans(covered)

    packed = wanted.groupBy("id").agg(F.collect_list("payload").alias("cells"))
    joined = docs.select("id", "text").join(packed, "id")
    return store(joined.mapInArrow(run, FOUND_SCHEMA), "cells")


def packed_words(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The next seven bytes from each place on as one number, nine bits each: a byte
    plus one, zero past the end."""
    n = len(codes)
    out = np.zeros(n, np.uint64)
    room = ends - np.arange(n)
    above = codes.astype(np.uint64) + np.uint64(1)
    for k in range(min(WORD, n)):
        own = np.where(room[: n - k] > k, above[k:], np.uint64(0))
        out[: n - k] |= own << np.uint64(9 * (WORD - 1 - k))
    return out


def suffix_array(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffixes in order, each up to the end of its string; equal ones by place.

    Larsson-Sadakane: suffixes are sorted by their first bytes; in every round only
    those that still share a group are sorted, by the group of the suffix that
    many bytes further on, which doubles the depth.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    rank = np.zeros(n, np.int64)

    def regroup(slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(new)
        counts = np.diff(at, append=len(keys))
        rank[order[slots]] = np.repeat(slots[at], counts) + 1
        return slots[np.repeat(counts > 1, counts)]

    slots = regroup(np.arange(n), words[order])
    depth, longest = WORD, int((ends - np.arange(n)).max()) if n else 0
    while len(slots) and depth < longest:
        own = order[slots]
        ahead = np.minimum(own + depth, n - 1)
        further = np.where(own + depth < ends[own], rank[ahead], 0)
        keys = rank[own] << 32 | further
        by = np.argsort(keys, kind="stable")
        order[slots] = own[by]
        slots = regroup(slots, keys[by])
        depth *= 2
    return order


def common_prefixes(order: np.ndarray, codes: np.ndarray, words: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
    """Bytes (at most `most`) that each suffix shares with the one before it in order.

    Kasai's walk: along a string, the common prefix shrinks by at most one per
    place. All strings are walked in step.
    """
    n = len(codes)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int32)
    own = starts.copy()
    stop = ends[starts] if n else starts
    h = np.zeros(len(own), np.int64)
    while len(own):
        prev = before[own]
        h = np.where(prev < 0, 0, h)
        todo = np.flatnonzero((prev >= 0) & (h < most))
        while len(todo):
            i, p = own[todo] + h[todo], prev[todo] + h[todo]
            room = np.minimum(ends[own[todo]] - i, ends[prev[todo]] - p)
            todo, i, p, room = todo[room > 0], i[room > 0], p[room > 0], room[room > 0]
            apart = words[i] ^ words[p]
            same = _same_bytes(apart)
            step = np.minimum(same, room)
            h[todo] += step
            todo = todo[(step == WORD) & (h[todo] < most)]
        out[own] = np.minimum(h, most)
        own = own + 1
        left = own < stop
        own, stop, h = own[left], stop[left], np.maximum(h[left] - 1, 0)
    return out


def _same_bytes(apart: np.ndarray) -> np.ndarray:
    """Equal leading bytes of packed words, from their exclusive or."""
    top = np.frexp(apart.astype(np.float64))[1] - 1
    guess = WORD - 1 - np.maximum(top, 0) // 9
    # rounding to a float may have carried into the byte before
    carried = (apart >> (9 * (WORD - 1 - guess)).astype(np.uint64)) & np.uint64(0x1FF) == 0
    return np.where(apart == 0, WORD, guess + carried)


def covered_windows(strings: list[bytes], span: int = SPAN) -> tuple[np.ndarray, ...]:
    """For distinct strings in corpus order: places of all windows in sorted
    order, whether each repeats an earlier place, and the start of each string."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    stops = np.cumsum(sizes)
    starts = stops - sizes
    codes = np.frombuffer(b"".join(strings), np.uint8)
    ends = np.repeat(stops, sizes)
    words = packed_words(codes, ends)
    order = suffix_array(words, ends)
    shared = common_prefixes(order, codes, words, starts, ends, span)
    windows = order[ends[order] - order >= span]
    new = shared[windows] < span
    new[:1] = True
    at = np.flatnonzero(new)
    least = np.minimum.reduceat(windows, at) if len(at) else windows
    return windows, windows != np.repeat(least, np.diff(at, append=len(windows))), starts


def _runs(places: np.ndarray, starts: np.ndarray, docs: list[int], firsts: list[int], span: int, covered: dict) -> None:
    """Add the spans under covered windows, neighbouring ones as one span."""
    places = np.sort(places)
    if not len(places):
        return
    string = np.searchsorted(starts, places, side="right") - 1
    new = np.ones(len(places), bool)
    new[1:] = (np.diff(places) != 1) | (np.diff(string) != 0)
    at = np.flatnonzero(new)
    last = places[np.append(at[1:], len(places)) - 1]
    for s, a, b in zip(string[at].tolist(), (places[at] - starts[string[at]]).tolist(), (last - places[at]).tolist()):
        covered[docs[s]] += (firsts[s] + a, firsts[s] + a + b + span)


SHARD_SCHEMA = FOUND_SCHEMA + ", piece int"


def shard_spans(
    found: DataFrame, span: int = SPAN, shard_bytes: int = SHARD_BYTES, hot_cells: int = HOT_CELLS, run_windows: int = RUN_WINDOWS
) -> DataFrame:
    """id, spans that the shards and their merging find among the stored cells."""
    own = found.where("cell IS NOT NULL").select("key", "cell", "id", "first")
    total = own.agg(F.sum(F.octet_length("cell"))).first()[0] or 0
    shards = total // shard_bytes + 1
    counts = own.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot_cells)
    hot = store(counts, "hot-anchors")

    def run(key: tuple, group: pa.Table) -> pa.Table:
        anchor = key[1].as_py()
        seen: dict[bytes, tuple[int, int, int]] = {}
        covered: dict[int, list[int]] = defaultdict(list)
        rows = zip(*[group.column(c).to_pylist() for c in ("cell", "id", "first", "key")])
        for cell, doc, first, own_key in rows:
            _first_one(seen, cell, doc, first, own_key, covered)
        ordered = sorted((v[0], v[1], c) for c, v in seen.items())
        docs, firsts, strings = [r[0] for r in ordered], [r[1] for r in ordered], [r[2] for r in ordered]
        windows, again, starts = covered_windows(strings, span)
        _runs(windows[again], starts, docs, firsts, span, covered)
        out = [b.append_column("piece", pa.nulls(b.num_rows, pa.int32())) for b in _spans(covered)]
        if anchor is not None:
            # the first sampled place differs by shard, or small shards would only ever show their least windows
            offset = zlib.crc32(f"{anchor} {key[2].as_py()}".encode()) % run_windows
            out += _sorted_runs(anchor, windows[~again], strings, starts, docs, firsts, offset, run_windows, span)
        return pa.Table.from_batches(out, schema=SHARD_TYPE) if out else SHARD_TYPE.empty_table()

    split = own.join(hot.withColumnRenamed("key", "hot_key"), F.col("key") == F.col("hot_key"), "left")
    salt = F.when(
        F.col("n").isNotNull(), F.pmod(F.xxhash64("id", "first"), F.ceil(F.col("n") / hot_cells))
    ).otherwise(F.lit(0))
    shard = F.when(F.col("n").isNotNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("key"), F.lit(shards)))
    dealt = split.select("key", "cell", "id", "first", "hot_key", shard.alias("shard"), salt.alias("salt"))
    made = store(dealt.groupBy("shard", "hot_key", "salt").applyInArrow(run, SHARD_SCHEMA), "spans")
    merged = window_ranges(made, span).groupBy("key", "piece").applyInArrow(merge_ranges(span), "id long, spans binary")
    return made.where("piece IS NULL").select("id", "spans").unionByName(merged)


SHARD_TYPE = pa.schema(
    [
        ("key", pa.int64()),
        ("cell", pa.binary()),
        ("id", pa.int64()),
        ("first", pa.int32()),
        ("spans", pa.binary()),
        ("piece", pa.int32()),
    ]
)


def _sorted_runs(
    anchor: int, windows: np.ndarray, strings: list[bytes], starts: np.ndarray, docs: list[int], firsts: list[int], offset: int, run_windows: int, span: int
) -> list[pa.RecordBatch]:
    """The sorted distinct windows of a shard in runs. Each run is one row: the
    windows in `cell`, their documents and places in `spans`; `piece` is 1 if its first
    window is a sample (one for `run_windows`), else 0."""
    text = b"".join(strings)
    string = np.searchsorted(starts, windows, side="right") - 1
    doc = np.array(docs, dtype=np.int64)[string]
    place = np.array(firsts, dtype=np.int64)[string] + windows - starts[string]
    bounds = [*range(offset, len(windows), run_windows), len(windows)]
    sampled = [1] * (len(bounds) - 1)
    if bounds[0]:
        bounds, sampled = [0, *bounds], [0, *sampled]
    out = []
    for piece, a, b in zip(sampled, bounds, bounds[1:]):
        if a < b:
            own = b"".join(text[w : w + span] for w in windows[a:b].tolist())
            where = np.stack([doc[a:b], place[a:b]]).astype("<i8").tobytes()
            out.append(
                pa.RecordBatch.from_arrays(
                    [pa.array([anchor]), pa.array([own], pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.array([where], pa.binary()), pa.array([piece], pa.int32())],
                    schema=SHARD_TYPE,
                )
            )
    return out


def window_ranges(made: DataFrame, span: int = SPAN, range_runs: int = RANGE_RUNS) -> DataFrame:
    """key, piece, cell, spans: the runs of all shards, cut at every `range_runs`-th of
    the sampled windows of their key. Equal windows get the same piece."""
    runs = made.where("piece IS NOT NULL").select("key", "cell", "spans", "piece")
    head = F.substring("cell", 1, span)
    place = F.row_number().over(Window.partitionBy("key").orderBy("head"))
    cuts = runs.where("piece = 1").select("key", head.alias("head")).withColumn("place", place)
    cuts = cuts.where(F.col("place") % range_runs == 0).groupBy("key").agg(F.sort_array(F.collect_set("head")).alias("cuts"))
    last = F.expr(f"substring(cell, octet_length(cell) - {span - 1}, {span})")
    none = F.array().cast("array<binary>")
    own = runs.join(F.broadcast(cuts), "key", "left").withColumn("cuts", F.coalesce("cuts", none))
    own = own.select(
        "key",
        F.size(F.filter("cuts", lambda c: c <= head)).alias("before"),
        F.filter("cuts", lambda c: (c > head) & (c <= last)).alias("inside"),
        "cell",
        "spans",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, before, inside, cell, where in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                windows, places = np.frombuffer(cell, f"S{span}"), np.frombuffer(where, "<i8").reshape(2, -1)
                at = np.searchsorted(windows, np.array(inside, f"S{span}")).tolist()
                bounds = [0, *at, len(windows)]
                rows = [(before + i, a, b) for i, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * len(rows), pa.int64()),
                        pa.array([r[0] for r in rows], pa.int32()),
                        pa.array([cell[a * span : b * span] for _, a, b in rows], pa.binary()),
                        pa.array([places[:, a:b].tobytes() for _, a, b in rows], pa.binary()),
                    ],
                    ["key", "piece", "cell", "spans"],
                )

    return own.mapInArrow(run, "key long, piece int, cell binary, spans binary")


def merge_ranges(span: int):
    """Merge the sorted windows of all shards for one range, two at a time."""

    def merge(a: tuple, b: tuple, covered: dict) -> tuple:
        (text_a, where_a), (text_b, where_b) = (a, b) if len(a[0]) >= len(b[0]) else (b, a)
        at = np.searchsorted(text_a, text_b)
        inside = np.minimum(at, len(text_a) - 1)
        equal = text_a[inside] == text_b
        for i, j in zip(inside[equal].tolist(), np.flatnonzero(equal).tolist()):
            old, new = tuple(where_a[:, i].tolist()), tuple(where_b[:, j].tolist())
            if new < old:
                where_a[:, i] = new
            late = max(old, new)
            if old != new:
                covered[late[0]] += (late[1], late[1] + span)
        fresh = ~equal
        return np.insert(text_a, at[fresh], text_b[fresh]), np.insert(where_a, at[fresh], where_b[:, fresh], axis=1)

    def run(_key: tuple, group: pa.Table) -> pa.Table:
        covered: dict[int, list[int]] = defaultdict(list)
        runs = [
            (np.frombuffer(c, f"S{span}"), np.frombuffer(w, "<i8").reshape(2, -1).copy())
            for c, w in zip(group.column("cell").to_pylist(), group.column("spans").to_pylist())
        ]
        while len(runs) > 1:
            runs = [merge(*runs[i : i + 2], covered) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
        return pa.table(
            {
                "id": pa.array(list(covered), pa.int64()),
                "spans": pa.array([np.array(v, "<i4").tobytes() for v in covered.values()], pa.binary()),
            }
        )

    return run


def merged_spans(packed: list[bytes]) -> list[tuple[int, int]]:
    """Maximal runs of the union of packed spans."""
    pairs = np.frombuffer(b"".join(packed), "<i4").reshape(-1, 2)
    if not len(pairs):
        return []
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")].astype(np.int64)
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.ones(len(pairs), bool)
    new[1:] = pairs[1:, 0] > reach[:-1]
    at = np.flatnonzero(new)
    return list(zip(pairs[at, 0].tolist(), reach[np.append(at[1:], len(pairs)) - 1].tolist()))


def repeated_spans(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot_cells: int = HOT_CELLS) -> tuple[DataFrame, DataFrame]:
    """The numbered documents, and (id, spans): lists of packed covered spans."""
    numbered = unique_ids(docs)
    found = cut_cells(numbered, repeated_cells(numbered, span, gram))
    own = found.where("spans IS NOT NULL").select("id", "spans")
    every = own.unionByName(shard_spans(found, span, hot_cells=hot_cells))
    return numbered, every.groupBy("id").agg(F.collect_list("spans").alias("spans"))


def cut(text: bytes, gone: list[tuple[int, int]]) -> bytes:
    """The text without the spans."""
    at, kept = 0, []
    for a, b in gone:
        kept.append(text[at:a])
        at = b
    return b"".join((*kept, text[at:]))


def cut_documents(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot_cells: int = HOT_CELLS) -> DataFrame:
    """`docs` with the covered bytes cut out of `text` (a character that loses some
    of its bytes goes too) and `n_chars`, where there is one, counted anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = zip(byte_texts(batch, "text"), batch.column("spans").to_pylist())
            left = pa.array([cut(t, merged_spans(p or [])).decode(errors="ignore") for t, p in made], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), left, batch.column("rest")], ["doc_id", "text", "rest"])

    numbered, spans = repeated_spans(docs, span, gram, hot_cells)
    own = numbered.select("doc_id", "text", "rest")
    joined = numbered.join(spans, "id", "left").select("doc_id", "text", "rest", "spans").mapInArrow(run, own.schema)
    out = joined.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"rest.{c}") for c in docs.columns])
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot_cells: int = HOT_CELLS) -> DataFrame:
    """doc_id, kept (bytes), n_bytes, n_removed, n_spans, kept_sha256 of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, packed in zip(byte_texts(batch, "text"), batch.column(2).to_pylist()):
                gone = merged_spans(packed or [])
                left = cut(text, gone)
                out.append((left, len(text), len(text) - len(left), len(gone), hashlib.sha256(left).hexdigest()))
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    numbered, spans = repeated_spans(docs, span, gram, hot_cells)
    joined = numbered.join(spans, "id", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(
        run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


