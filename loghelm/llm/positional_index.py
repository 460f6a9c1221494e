"""Benchmark decontamination by a distributed positional inverted index.

The index is stored as segments. A segment holds whole documents: its distinct
terms in order and, for each term, the ascending word positions at which it
occurs; a free position between two documents keeps phrases from crossing them.
A term is a word's number of 126 bits, of two hashes of different kinds.
Test items are searched in blocks of bounded size. For every window of an item
the postings of its rarest term in the segment, moved back by the term's place
in the window, are intersected with the moved postings of the next rarest term,
and so on. With `slop` 0 that gives exact phrases; with a larger one, windows
all of whose terms lie within `slop` words of their places.

Cases: a null or wordless text has no words and no matches; an item with fewer
words than a window is one window, an item without words none; repeated rows are
searched and returned each; items that repeat an id count once; an empty item
table leaves every document clean.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghelm.llm.common import ALNUM, byte_texts, doc_text, document_words, ids_back, longs, slices, store
from loghelm.llm.suffix_arrays import unique_ids

WINDOW = 10
#: Text bytes of a segment of the index (a longer document is a segment of its own).
SEGMENT_BYTES = 8 << 20
#: Text bytes of the items that are searched at once.
ITEM_BYTES = 8 << 20

#: Both hashes of a word, compared one after the other.
TERM = np.dtype([("a", np.uint64), ("b", np.uint64)])
INDEX_SCHEMA = "segment string, docs array<bigint>, words array<int>, terms binary, counts binary, steps binary"
HIT = "struct<item_id: string, window_no: int, start: int, length: int, phrase: boolean>"
FOUND_SCHEMA = f"segment string, row int, doc_id bigint, n_words bigint, hits array<{HIT}>"


def text_terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The terms of all texts in order, and the number of words of each text."""
    a, words = document_words(texts, ALNUM, prime=True)
    b, _ = document_words(texts, ALNUM)
    terms = np.empty(len(a), TERM)
    terms["a"], terms["b"] = a, b
    return terms, words


def term_order(terms: np.ndarray) -> np.ndarray:
    """The order of the terms, equal ones in the order given."""
    order = np.argsort(terms["a"], kind="stable")
    a, b = terms["a"][order], terms["b"][order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():  # two words of one first hash
        return np.lexsort((terms["b"], terms["a"]))
    return order


def build_index(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The stored positional index of `docs`, one row per segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = byte_texts(batch, "text"), longs(batch, "doc_id")
            for a, b in slices(texts, segment_bytes):
                terms, words = text_terms(texts[a:b])
                places = np.arange(len(terms), dtype=np.int64) + np.repeat(np.arange(b - a), words)
                order = term_order(terms)
                terms, places = terms[order], places[order]
                first = np.flatnonzero(np.concatenate((np.ones(min(len(terms), 1), bool), terms[1:] != terms[:-1])))
                counts = np.diff(first, append=len(terms))
                steps = np.diff(places, prepend=0)
                steps[first] = places[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([uuid.uuid4().hex]),
                        pa.array([ids_back(ids[a:b])], pa.list_(pa.int64())),
                        pa.array([words.astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([terms[first].tobytes()], pa.binary()),
                        pa.array([counts.astype(np.int32).tobytes()], pa.binary()),
                        pa.array([steps.astype(np.int32).tobytes()], pa.binary()),
                    ],
                    ["segment", "docs", "words", "terms", "counts", "steps"],
                )

    return store(doc_text(docs).mapInArrow(run, INDEX_SCHEMA), "postings")


class Segment:
    """Postings of one segment."""

    def __init__(self, terms: bytes, counts: bytes, steps: bytes):
        self.terms = np.frombuffer(terms, TERM)
        self.counts = np.frombuffer(counts, np.int32)
        self.ends = np.cumsum(self.counts, dtype=np.int64)
        self.steps = np.frombuffer(steps, np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Number of each wanted term in the segment, -1 if it has none."""
        if not len(self.terms):
            return np.full(len(wanted), -1)
        firsts = self.terms["a"]
        at = np.searchsorted(firsts, wanted["a"])
        found = np.full(len(wanted), -1)
        while True:  # one step, but for words of one first hash
            near = np.flatnonzero(at < len(firsts))
            near = near[firsts[at[near]] == wanted["a"][near]]
            if not len(near):
                return found
            same = self.terms["b"][at[near]] == wanted["b"][near]
            found[near[same]] = at[near[same]]
            at[near[same]] = len(firsts)
            at[near[~same]] += 1

    def postings(self, term: int) -> np.ndarray:
        end = self.ends[term]
        return np.cumsum(self.steps[end - self.counts[term] : end], dtype=np.int64)


def item_windows(texts: list[bytes], window: int) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray]]]:
    """Distinct terms of the items, and (item, window number, term numbers)."""
    every, words = text_terms(texts)
    order = term_order(every)
    begins = np.concatenate((np.zeros(min(len(every), 1), bool), every[order][1:] != every[order][:-1]))
    numbers = np.empty(len(every), np.int64)
    numbers[order] = np.cumsum(begins)
    terms = every[order][np.concatenate((np.ones(min(len(every), 1), bool), begins[1:]))]
    out, at = [], 0
    for item, n in enumerate(words.tolist()):
        size = min(window, n)
        for no in range(n - size + 1 if n else 0):
            out.append((item, no, numbers[at + no : at + no + size]))
        at += n
    return terms, out


def match(segment: Segment, terms: np.ndarray, windows: list, slop: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of the window, first positions) for every window that occurs."""
    at = segment.find(terms)
    sizes = np.where(at < 0, 0, segment.counts[at]) if len(segment.terms) else np.zeros(len(terms), np.int32)
    lists: dict[int, np.ndarray] = {}

    def postings(term: int) -> np.ndarray:
        if term not in lists:
            lists[term] = segment.postings(at[term])
        return lists[term]

    for number, (_, _, numbers) in enumerate(windows):
        frequency = sizes[numbers]
        if not frequency.all():
            continue
        starts = None
        for place in np.argsort(frequency, kind="stable"):
            moved = postings(int(numbers[place])) - place
            if starts is None:
                starts = moved
                continue
            near = np.searchsorted(moved, starts - slop)
            starts = starts[(near < len(moved)) & (moved[np.minimum(near, len(moved) - 1)] <= starts + slop)]
            if not len(starts):
                break
        if len(starts):
            yield number, starts


def search(index: DataFrame, items: list[tuple[str, bytes]], window: int = WINDOW, slop: int = 0) -> DataFrame:
    """One row per indexed document with its matches of the items (a block of
    bounded size). `start` and `length` are word positions in the document;
    `phrase` tells exact matches from near ones."""
    names = [n for n, _ in items]
    terms, windows = item_windows([t for _, t in items], window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row["terms"], row["counts"], row["steps"])
                words = np.array(row["words"], dtype=np.int64)
                bases = np.cumsum(words + 1) - words - 1
                hits: list[list[dict]] = [[] for _ in words]
                exact = {n: set(s.tolist()) for n, s in match(segment, terms, windows, 0)}
                found = match(segment, terms, windows, slop) if slop else ((n, np.array(sorted(s))) for n, s in exact.items())
                for number, starts in found:
                    item, no, numbers = windows[number]
                    docs = np.searchsorted(bases, starts, side="right") - 1
                    for doc, start in zip(docs.tolist(), starts.tolist()):
                        hits[doc].append(
                            {
                                "item_id": names[item],
                                "window_no": no,
                                "start": start - int(bases[doc]),
                                "length": len(numbers),
                                "phrase": start in exact.get(number, ()),
                            }
                        )
                n = len(words)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["segment"]] * n, pa.string()),
                        pa.array(np.arange(n, dtype=np.int32)),
                        pa.array(row["docs"], pa.int64()),
                        pa.array(words),
                        pa.array(hits, HIT_TYPE),
                    ],
                    ["segment", "row", "doc_id", "n_words", "hits"],
                )

    return index.mapInArrow(run, FOUND_SCHEMA)


HIT_TYPE = pa.list_(
    pa.struct(
        [
            ("item_id", pa.string()),
            ("window_no", pa.int32()),
            ("start", pa.int32()),
            ("length", pa.int32()),
            ("phrase", pa.bool_()),
        ]
    )
)


def item_blocks(
    items: DataFrame, item_bytes: int = ITEM_BYTES, id_col: str = "item_id", text_col: str = "text"
) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of about `item_bytes`, one block on the driver at a time."""
    named = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text")).where(
        F.col("item_id").isNotNull() & F.col("text").isNotNull()
    )
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // item_bytes + 1
    dealt = named.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for block in range(blocks):
        yield [(r["item_id"], r["text"].encode()) for r in dealt.where(F.col("block") == block).collect()]


def matches(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0, item_bytes: int = ITEM_BYTES
) -> DataFrame:
    """doc_id, n_words, hits of every document row, over all item blocks."""
    index = build_index(docs)
    parts = [search(index, block, window, slop) for block in item_blocks(items, item_bytes)]
    found = reduce(DataFrame.unionByName, parts)
    if len(parts) > 1:
        found = found.groupBy("segment", "row").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("hits")).alias("hits"),
        )
    return found.select("doc_id", "n_words", "hits")


def hit_words(hits: Column) -> Column:
    """Number of words inside any match."""
    places = F.transform(hits, lambda h: F.sequence(h["start"], h["start"] + h["length"] - 1))
    return F.size(F.array_distinct(F.flatten(places))).cast("long")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items."""
    names = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item_id"])))
    out = matches(docs, items, window, slop).select("doc_id", "n_words", hit_words(F.col("hits")).alias("n_hit"), names.alias("items"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs` without any window of the items. Rows are told apart by a
    number, so a row without an id, or of an id that others have, is judged alone."""
    numbered = store(unique_ids(docs.withColumn("__text", F.col("text"))), "numbered")
    found = contamination(numbered.select(F.col("id").alias("doc_id"), "text"), items, window)
    bad = found.where("contaminated").select(F.col("doc_id").alias("id"))
    clean = numbered.join(bad, "id", "left_anti")
    own = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text": F.col("rest.__text").alias("text")}
    return clean.select(*[own.get(c, F.col(f"rest.`{c}`").alias(c)) for c in docs.columns])
