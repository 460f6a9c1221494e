"""Language model scoring by a probabilistic suffix tree.

Contexts are strings of up to `DEPTH` words. A string counts as a node if it is
there `MIN_COUNT` times, whatever the size of the corpus, and nodes of a level are
counted only where their parts are nodes. A context is retained if its next-symbol
distribution diverges from that of its longest retained suffix by at least `GAIN`
nats over all its occurrences. Distributions are smoothed towards the suffix:
symbols that are nodes after a context get a share of their own, all others the
suffix's share, scaled to sum to one; at the root, all words with half a count
added. A text is scored with the longest suffix state at each token. Levels are
added until one has no nodes or `DEPTH` is reached.

Texts become stored blocks of word numbers. The counts of a block's distinct words
are asked for by hash range and answered per block, so the corpus counts of all
words are exact and no word table goes to one place. The nodes of a level are
counted alike, by ranges of the strings' hashes: a block asks for the strings it
holds. One of the blocks that hold a node sends it on to the range of its context,
which tests the context and answers the blocks that hold it.

Cases: a null or empty text is its end token; unknown words share one entry of
half a count; rows that repeat are counted and scored each; without training
texts all scores follow the formulas with zero counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghelm.llm.common import BLANKED, byte_texts, document_words, fold, ids_back, longs, mix64, slices, store

BLOCK_BYTES = 12 << 20
MIN_COUNT = 8
#: Most words of a context.
DEPTH = 4
GAIN = 20.0
#: Weight of the suffix's distribution in a context's own shares.
SMOOTH = 4.0
END = np.uint64(0xE17D)

BLOCK_SCHEMA = "block string, n_train long, ids binary, held binary, lengths binary, words binary, counts binary, codes binary"


def text_blocks(docs: DataFrame, held_out: Column) -> DataFrame:
    """The texts as blocks of word numbers, stored. `words`: ascending distinct
    hashes of a block; `counts`: how often its training texts hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = byte_texts(batch, "text"), longs(batch, "doc_id")
            held = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint8)
            for a, b in slices(texts, BLOCK_BYTES):
                hashes, lengths = document_words(texts[a:b], BLANKED, prime=True)
                hashes = np.where(hashes == END, END + np.uint64(1), hashes)
                hashes = np.insert(hashes, np.cumsum(lengths), END)
                lengths = lengths + 1
                words, codes = np.unique(hashes, return_inverse=True)
                train = np.repeat(held[a:b] == 0, lengths)
                counts = np.bincount(codes[train], minlength=len(words))
                parts = (ids[a:b], held[a:b], lengths.astype(np.int32), words, counts.astype(np.int32), codes.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().hex]), pa.array([int(train.sum())]), *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
                    [f.split()[0] for f in BLOCK_SCHEMA.split(", ")],
                )

    own = docs.withColumn("__held", F.coalesce(held_out, F.lit(False)))
    own = own.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "__held")
    return store(own.mapInArrow(run, BLOCK_SCHEMA), "blocks")


def corpus_counts(blocks: DataFrame, least: int) -> DataFrame:
    """Stored answers: rows (block, bucket, counts) with the corpus counts of the
    block's words of that hash range; per range one row with `distinct` and the
    words that occur at least `least` times (`heads`, `head_counts`)."""
    buckets = blocks.count() + 1

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, counts in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                words, counts = np.frombuffer(words, np.uint64), np.frombuffer(counts, np.int32)
                bucket = (words.astype(np.float64) / 2.0**64 * buckets).astype(np.int64).clip(0, buckets - 1)
                cut = np.flatnonzero(np.diff(bucket)) + 1
                starts = np.concatenate(([0], cut)) if len(words) else cut
                own = list(zip(np.split(words, cut), np.split(counts, cut))) if len(words) else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[starts]),
                        pa.array([block] * len(own), pa.string()),
                        pa.array([w.tobytes() for w, _ in own], pa.binary()),
                        pa.array([c.tobytes() for _, c in own], pa.binary()),
                    ],
                    ["bucket", "block", "words", "counts"],
                )

    def answer(key: tuple, group: pa.Table) -> pa.Table:
        words = [np.frombuffer(w, np.uint64) for w in group.column("words").to_pylist()]
        counts = [np.frombuffer(c, np.int32) for c in group.column("counts").to_pylist()]
        every, place = np.unique(np.concatenate(words), return_inverse=True)
        summed = np.bincount(place, np.concatenate(counts), len(every)).astype(np.int64)
        parts = np.split(summed[place], np.cumsum([len(w) for w in words])[:-1])
        head = np.flatnonzero(summed >= least)
        n = len(parts)
        return pa.table(
            {
                "block": pa.array([*group.column("block").to_pylist(), None], pa.string()),
                "bucket": pa.array([key[0].as_py()] * (n + 1), pa.int64()),
                "counts": pa.array([*[p.tobytes() for p in parts], None], pa.binary()),
                "distinct": pa.array([*[None] * n, int((summed > 0).sum())], pa.int64()),
                "heads": pa.array([*[None] * n, every[head].tobytes()], pa.binary()),
                "head_counts": pa.array([*[None] * n, summed[head].tobytes()], pa.binary()),
            }
        )

    asked = blocks.select("block", "words", "counts").mapInArrow(ask, "bucket long, block string, words binary, counts binary")
    made = asked.groupBy("bucket").applyInArrow(
        answer, "block string, bucket long, counts binary, distinct long, heads binary, head_counts binary"
    )
    return store(made, "counts")


def deflate(values: np.ndarray) -> bytes:
    """Numbers packed byte plane by byte plane."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def inflate(data: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    if not size:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(data[8:], size, "zstd", asbytes=True), np.uint8)
    return planes.reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value among ascending keys, -1 if it is not there."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def joined(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of the strings that are a context and a word."""
    return mix64(context * np.uint64(0x9E3779B97F4A7C15) + word)


def own_share(n: np.ndarray, total: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Share of a symbol that is a node after its context, `below` by the suffix."""
    return (n + SMOOTH * below) / (total + SMOOTH)


def shares(n: np.ndarray, total: np.ndarray, rest: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Shares after contexts: `rest` is what a context leaves to symbols that are
    no nodes after it, 0 if it is not retained."""
    return np.where(rest > 0, np.where(n > 0, own_share(n, total, below), rest * below), below)


def retained(context: np.ndarray, n: np.ndarray, total: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts and the share of their rest, 0 if not retained; from their nodes."""
    order = np.lexsort((below, n, context))
    context, n, total, below = context[order], n[order], total[order], below[order]
    every, first, group = np.unique(context, return_index=True, return_inverse=True)
    size, m = len(every), total[first]
    share = own_share(n, total, below)
    own, low = np.bincount(group, share, size), np.bincount(group, below, size)
    rest = np.maximum(1 - own, 1e-12) / np.maximum(1 - low, 1e-12)
    gain = np.bincount(group, n * np.log(share / below), size)
    gain = gain + np.maximum(m - np.bincount(group, n, size), 0) * np.log(rest)
    return every, np.where((gain >= GAIN) & (own < 1) & (low < 1), rest, 0.0)


class SuffixTree:
    """What all blocks share, and the stored answers to them."""

    def __init__(self, total: int, distinct: int, least: int, counted: DataFrame):
        self.total, self.distinct, self.least = total, distinct, least
        self.counted = counted
        self.levels: list[DataFrame] = []

    def __reduce__(self):
        return SuffixTree, (self.total, self.distinct, self.least, None)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.total + 0.5 * (self.distinct + 1))


class Block:
    """A stored block on its way down the levels."""

    def __init__(self, row: dict, tree: SuffixTree):
        self.lengths = np.frombuffer(row["lengths"], np.int32).astype(np.int64)
        self.held = np.frombuffer(row["held"], np.uint8) > 0
        self.tree = tree
        self.answers: dict[tuple[int, int], list] = {}
        for a in sorted(row["answers"], key=lambda a: a["bucket"]):
            self.answers.setdefault((a["level"], a["kind"]), []).append(a["made"])
        #: distinct words, and the number of the word at each place
        self.strings, self.codes = np.frombuffer(row["words"], np.uint64), np.frombuffer(row["codes"], np.int32)
        counts = [np.frombuffer(m, np.int64) for m in self.answers.pop((0, 0), [])]
        self.own = np.concatenate([np.zeros(0, np.int64), *counts])[self.codes]
        self.base = tree.base(self.own)

    def _answer(self, level: int, kind: int, number: type) -> np.ndarray:
        return np.concatenate([np.zeros(0, number), *[inflate(m, number) for m in self.answers.get((level, kind), [])]])

    def descend(self, level: int, ask: bool, last: bool = False) -> tuple:
        """Shares after the answers of the levels before `level`; if `ask`, what level
        `level` asks: its strings and their training counts (none if it is the last),
        the contexts of the level before, and the nodes of these that this block sends on.

        Strings go by their numbers: the context of a place is the string that ends
        at the place before, so each level sorts its new strings and nothing else.
        """
        at = np.arange(len(self.codes)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        train = np.repeat(~self.held, self.lengths)
        strings, codes = self.strings, self.codes
        count, share = np.where(self.own >= self.tree.least, self.own, 0), self.base
        contexts, nodes, nothing = np.zeros(0, np.uint64), [np.zeros(0, k) for k in NODE], np.zeros(0, np.int64)
        for depth in range(1, level + 1):
            total = np.where(at >= 1, np.roll(count, 1), 0)
            valid = np.flatnonzero(total > 0)
            context = np.roll(codes, 1)
            if depth == level and (last or not ask):
                return share, np.zeros(0, np.uint64), nothing, contexts, nodes
            possible = valid[count[valid] > 0]
            after = joined(strings[context[possible]], self.strings[self.codes[possible]])
            longer, place = np.unique(after, return_inverse=True)
            if depth == level:
                return share, longer, np.bincount(place[train[possible]], minlength=len(longer)), contexts, nodes
            made = self._answer(depth, 0, np.int64)
            count = np.zeros(len(codes), np.int64)
            count[possible] = (made >> 1)[place]
            there = np.zeros(len(strings), bool)
            there[context[valid]] = True
            if ask and depth == level - 1:
                some = np.empty(len(longer), np.int64)
                some[place] = possible
                sent = some[(made & 1 > 0) & (made > 1)]
                contexts, nodes = strings[there], [strings[context[sent]], count[sent], total[sent], share[sent]]
            else:
                number = np.cumsum(there, dtype=np.int32) - 1
                rest = self._answer(depth + 1, 1, np.float64)[number[context[valid]]]
                share = share.copy()
                share[valid] = shares(count[valid], total[valid], rest, share[valid])
            strings, codes = longer, np.full(len(codes), -1, np.int32)
            codes[possible] = place
        raise AssertionError


NODE = (np.uint64, np.int64, np.int64, np.float64)
ASK_SCHEMA = "kind int, bucket long, block string, keys binary, n binary, nodes array<binary>"
ANSWER_SCHEMA = "level int, kind int, bucket long, block string, keys binary, made binary"


def with_answers(blocks: DataFrame, tree: SuffixTree) -> DataFrame:
    """The blocks with all answers that they have so far."""
    made = tree.counted.where("block IS NOT NULL").select(
        "block", F.lit(0).alias("level"), F.lit(0).alias("kind"), "bucket", F.col("counts").alias("made")
    )
    for level in tree.levels:
        made = made.unionByName(level.where("block IS NOT NULL").select(made.columns))
    made = made.groupBy("block").agg(F.collect_list(F.struct("level", "kind", "bucket", "made")).alias("answers"))
    return blocks.select("block", "ids", "held", "lengths", "words", "codes").join(made, "block")


def count_level(blocks: DataFrame, tree: SuffixTree, level: int, last: bool) -> DataFrame:
    """Stored answers of a level: (kind 0) the counts of a block's strings of level + 1
    words, 0 if no node, doubled, plus one for the block that sends the node on;
    (kind 1) the rests of its contexts of level - 1 words. Rows without a block hold
    the nodes and contexts of a range. The last one asks for no strings."""
    buckets = blocks.count() + 1
    least = tree.least

    def bucket_of(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.float64) / 2.0**64 * buckets).astype(np.int64).clip(0, buckets - 1)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                _, strings, n, contexts, nodes = Block(row, tree).descend(level, True, last)
                rows = []
                if not last:
                    bucket = bucket_of(strings)
                    for b in np.unique(bucket).tolist():
                        a, z = np.searchsorted(bucket, [b, b + 1])
                        rows.append((0, b, row["block"], deflate(strings[a:z]), deflate(n[a:z]), None))
                bucket = bucket_of(contexts)
                order = np.argsort(nodes[0], kind="stable")
                nodes = [v[order] for v in nodes]
                sent = bucket_of(nodes[0])
                for b in np.unique(bucket).tolist():
                    a, z = np.searchsorted(bucket, [b, b + 1])
                    c, y = np.searchsorted(sent, [b, b + 1])
                    rows.append((1, b, row["block"], deflate(contexts[a:z]), None, [deflate(v[c:y]) for v in nodes]))
                for at in range(0, len(rows), 200):
                    part = list(zip(*rows[at : at + 200]))
                    kinds = (pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.binary()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(part, kinds)], [f.split()[0] for f in ASK_SCHEMA.split(", ")]
                    )

    def answer(key: tuple, group: pa.Table) -> pa.Table:
        kind, bucket = key[0].as_py(), key[1].as_py()
        asked = [inflate(k, np.uint64) for k in group.column("keys").to_pylist()]
        ends = np.cumsum([len(k) for k in asked])[:-1]
        if kind == 0:
            every, first, place = np.unique(np.concatenate(asked), return_index=True, return_inverse=True)
            summed = np.bincount(place, np.concatenate([inflate(n, np.int64) for n in group.column("n").to_pylist()]), len(every))
            summed = np.where(summed >= least, summed, 0).astype(np.int64)
            made = summed[place] * 2
            made[first] += 1
            every, values = every[summed > 0], summed[summed > 0]
        else:
            sent = [[inflate(v, k) for v, k in zip(row, NODE)] for row in group.column("nodes").to_pylist()]
            every, values = retained(*[np.concatenate([s[i] for s in sent]) for i in range(len(NODE))])
            at = find(every, np.concatenate(asked))
            made = np.where(at >= 0, values[np.maximum(at, 0)] if len(values) else 0.0, 0.0)
        parts = [deflate(p) for p in np.split(made, ends)]
        rows = len(parts) + 1
        return pa.table(
            {
                "level": pa.array([level] * rows, pa.int32()),
                "kind": pa.array([kind] * rows, pa.int32()),
                "bucket": pa.array([bucket] * rows, pa.int64()),
                "block": pa.array([*group.column("block").to_pylist(), None], pa.string()),
                "keys": pa.array([*[None] * len(parts), deflate(every)], pa.binary()),
                "made": pa.array([*parts, deflate(values)], pa.binary()),
            }
        )

    asked = with_answers(blocks, tree).mapInArrow(ask, ASK_SCHEMA)
    return store(asked.groupBy("kind", "bucket").applyInArrow(answer, ANSWER_SCHEMA), f"level-{level}")


def fit(blocks: DataFrame, min_count: int = MIN_COUNT, depth: int = DEPTH) -> tuple[SuffixTree, DataFrame]:
    """The tree of the training texts, and the stored corpus counts."""
    total = blocks.agg(F.sum("n_train")).first()[0] or 0
    counted = corpus_counts(blocks, min_count)
    distinct = counted.agg(F.sum("distinct")).first()[0] or 0
    tree = SuffixTree(total, distinct, min_count, counted)
    for level in range(1, depth + 2):
        made = count_level(blocks, tree, level, last=level > depth)
        tree.levels.append(made)
        # an empty packed column has only its size
        if made.where("kind = 0 AND block IS NULL AND octet_length(keys) > 8").isEmpty():
            break
    return tree, counted


SCORE_SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score_blocks(blocks: DataFrame, counted: DataFrame, tree: SuffixTree) -> DataFrame:
    """Scores of all texts of the blocks."""
    levels = len(tree.levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = Block(row, tree)
                share = block.descend(levels, False)[0]
                starts = np.cumsum(block.lengths) - block.lengths
                yield pa.RecordBatch.from_arrays(
                    [
                        ids_back(np.frombuffer(row["ids"], np.int64)),
                        pa.array(block.held),
                        pa.array(block.lengths),
                        pa.array(np.add.reduceat((block.own > 0).astype(np.int64), starts)),
                        pa.array(np.full(len(block.held), tree.total)),
                        pa.array(np.add.reduceat(np.log10(block.base), starts)),
                        pa.array(np.add.reduceat(np.log10(share), starts)),
                    ],
                    [f.split()[0] for f in SCORE_SCHEMA.split(", ")],
                )

    return with_answers(blocks, tree).mapInArrow(run, SCORE_SCHEMA)


def suffix_tree_scores(
    docs: DataFrame, held_out: Column | None = None, min_count: int = MIN_COUNT, depth: int = DEPTH
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    blocks = text_blocks(docs, fold("doc_id", 5) == 1 if held_out is None else held_out)
    tree, counted = fit(blocks, min_count, depth)
    return score_blocks(blocks, counted, tree)


