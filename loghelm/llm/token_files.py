"""Token files: ids ranked by frequency, in a byte-aligned variable-length code
whose control bytes lie apart from the data bytes.

A file holds the documents of a run of ascending ids. Rank 0 is the most
frequent id of the corpus, so most ids take one byte. Two control bits per id
give its length in bytes, four ids per control byte; a lookup table of 256
rows decodes them without branches. Files are the `payload` column of a
Parquet table in the shared folder: the engine's commit protocol makes a lost
task leave no half file, and every store the engine reads can hold them.

Cases: a null text is empty and has the end id only; null ids come first;
repeated ids are kept, ordered by their token ids; an empty table gives no file and no rows.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loghelm.llm.common import doc_text, ids_back, longs, prefix_sums, prime_numbers, slices, span_hashes, store, worker_memo

END_ID = 0
#: Ids after which a file is closed.
FILE_IDS = 4_000_000
#: Distinct text pieces whose ids a worker remembers.
MEMO_PIECES = 1_000_000
MAGIC = b"FRV1"
HEADER = "<4sIQQ"

_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)
_MASKS = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
MARKS = ".,;:!?"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it
    is visible, else the next one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)}


_BYTE_LETTERS = _byte_letters()
#: One pre-token whatever stands around it: letters of common scripts after one blank at most.
_LETTERS = re.compile("[ ]?[A-Za-zÀ-ÖØ-öø-ÿ]+")


def grown(values: np.ndarray, size: int) -> np.ndarray:
    """The array, or a copy with twice the room if `size` values do not fit."""
    return values if size <= len(values) else np.concatenate((values, np.zeros(max(size, 2 * len(values)) - len(values), values.dtype)))


class _Numbers:
    """Numbers of byte strings that are known by two hashes of different kinds, 95 bits
    together: a hash table in arrays, probed for all strings at once."""

    def __init__(self):
        self.a, self.b = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.count = 0
        self.slots = np.full(1 << 12, -1, np.int32)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each string, -1 for a new one."""
        mask = np.uint64(len(self.slots) - 1)
        out, left, at = np.full(len(a), -1, np.int64), np.arange(len(a)), (a & mask).astype(np.int64)
        while len(left):
            number = self.slots[at]
            used = number >= 0
            left, at, number = left[used], at[used], number[used]
            same = (self.a[number] == a[left]) & (self.b[number] == b[left])
            out[left[same]] = number[same]
            left, at = left[~same], at[~same] + 1 & int(mask)
        return out

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Number new distinct strings on from `count`."""
        need = self.count + len(a)
        self.a, self.b = grown(self.a, need), grown(self.b, need)
        self.a[self.count : need], self.b[self.count : need] = a, b
        left = np.arange(self.count, need)
        self.count = need
        if 2 * need > len(self.slots):
            self.slots = np.full(1 << (4 * need).bit_length(), -1, np.int32)
            left = np.arange(need)
        mask = len(self.slots) - 1
        at = (self.a[left] & np.uint64(mask)).astype(np.int64)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]  # of several for one slot the last stays
            out = self.slots[at] != left
            left, at = left[out], at[out] + 1 & mask


class _Ids:
    """Ids of numbered texts, one after the other."""

    def __init__(self):
        self.ends, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)
        self.count = 0

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        size, used = self.count + len(sizes), int(self.ends[self.count])
        self.ends, self.flat = grown(self.ends, size + 1), grown(self.flat, used + len(flat))
        self.ends[self.count + 1 : size + 1] = used + np.cumsum(sizes)
        self.flat[used : used + len(flat)] = flat
        self.count = size

    def take(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts in order, and where each text ends."""
        starts = self.ends[codes]
        sizes = self.ends[codes + 1] - starts
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(starts - ends + sizes, sizes) + np.arange(total)], ends


class Encoder:
    """Ids of texts by a tokenizer file. With a byte-level file, a blank or line end between two visible
    characters always begins a new pre-token, and so does a mark after a letter
    that ends such a piece. Texts are cut there, their pieces are hashed all at once, and
    the ids of the pieces are looked up among those already encoded. Other files get whole texts."""

    def __init__(self, path: str, memo: int = MEMO_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo = memo
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        settings = json.loads(self.tokenizer.to_str())
        self.byte_level = settings["normalizer"] is None and settings["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": settings["pre_tokenizer"].get("trim_offsets"), "use_regex": True
        }
        self.line_end, *marks = self.whole(["\n", *MARKS])
        self.marks = dict(zip(MARKS, marks))
        self.forget()

    def forget(self) -> None:
        self.numbers, self.known = _Numbers(), _Ids()
        self.cores, self.core_ids = {}, _Ids()

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of short texts and the number of each. Plain words are one pre-token
        and go to the model at once."""
        flags = [(t.isalpha() or (t[:1] == " " and t[1:].isalpha())) if t.isascii() else _LETTERS.fullmatch(t) is not None for t in texts]
        plain = np.array(flags, bool)
        others = self.whole(list(compress(texts, (~plain).tolist())))
        letters = _BYTE_LETTERS
        given = [t.replace(" ", "Ġ") if t.isascii() else t.encode().decode("latin-1").translate(letters) for t in compress(texts, flags)]
        model = self.tokenizer.model.tokenize
        made = [[t.id for t in model(text)] for text in given]
        sizes = np.empty(len(texts), np.int64)
        sizes[plain] = np.fromiter(map(len, made), np.int64, len(made))
        sizes[~plain] = np.fromiter(map(len, others), np.int64, len(others))
        out, mine = np.empty(int(sizes.sum()), np.uint32), np.repeat(plain, sizes)
        out[mine] = np.fromiter(chain.from_iterable(made), np.uint32, int(mine.sum()))
        out[~mine] = np.fromiter(chain.from_iterable(others), np.uint32, len(out) - int(mine.sum()))
        return out, sizes

    def learn(self, pieces: list[str]) -> None:
        """Encode new pieces: line end, core and mark on their own."""
        if not pieces:
            return
        lines = np.fromiter((p[:1] == "\n" and p[1:2].strip() != "" for p in pieces), bool, len(pieces))
        cores = [p[1:] if line else p for p, line in zip(pieces, lines.tolist())] if lines.any() else pieces
        marks = [c[-1] if c[-1:] in self.marks and c[-2:-1].isalpha() else "" for c in cores]
        cores = [c[:-1] if m else c for c, m in zip(cores, marks)]
        fresh = [c for c in dict.fromkeys(cores) if c not in self.cores]
        self.cores.update(zip(fresh, range(len(self.cores), len(self.cores) + len(fresh))))
        self.core_ids.add(*self.words(fresh))
        codes = np.fromiter(map(self.cores.__getitem__, cores), np.int64, len(cores))
        flat, ends = self.core_ids.take(codes)
        marked = np.fromiter(map(bool, marks), bool, len(marks))
        at, starts = np.flatnonzero(marked), np.concatenate(([0], ends[:-1]))
        # a mark stands before the line end of the piece after it
        places = np.concatenate((ends[at], starts[lines])).astype(np.int64)
        extra = [self.marks[marks[i]][0] for i in at.tolist()] + [self.line_end[0]] * int(lines.sum())
        self.known.add(np.insert(flat, places, np.array(extra, np.uint32)), np.diff(ends, prepend=0) + marked + lines)

    def plain(self, text: str) -> bool:
        """Whether every blank and line end lies between two visible characters or at
        an end of the text, so that it can be cut at all of them."""
        flat = text.replace("\n", " ")
        return "  " not in flat and flat.isprintable() and not any(s in text for s in self.special)

    def pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the pieces of plain texts, new ones learned, and how many pieces
        each text has. A piece loses the blank before it and keeps a line end."""
        data = [t.encode() for t in texts]
        sizes = np.fromiter(map(len, data), np.int64, len(data)) + 1
        # a blank behind each text ends its last piece
        codes = np.frombuffer(b" ".join([*data, b""]), np.uint8)
        cuts = np.flatnonzero((codes == 32) | (codes == 10))
        ends = np.cumsum(sizes)
        last = np.searchsorted(cuts, ends - 1)
        counts = np.diff(last, prepend=-1)
        starts = np.empty(len(cuts), np.int64)
        starts[1:] = cuts[:-1] + (codes[cuts[:-1]] == 32)
        firsts = last - counts + 1
        starts[firsts] = ends - sizes
        # a first piece has no blank before it, nor has one that starts with a line end
        lead = np.zeros(len(cuts), np.uint64)
        lead[firsts] = np.uint64(0x9E3779B97F4A7C15)
        a, b = span_hashes(prefix_sums(codes), starts, cuts) ^ lead, prime_numbers(codes, starts, cuts, 1)
        numbers = self.numbers.find(a, b)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            order = new[np.lexsort((b[new], a[new]))]
            begins = np.concatenate(([True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])))
            numbers[order] = self.numbers.count + np.cumsum(begins) - 1
            some = order[begins]
            raw = codes.tobytes()
            bare = (lead[some] > 0) | (codes[starts[some]] == 10)
            self.learn([
                (raw[s:e] if alone else b" " + raw[s:e]).decode()
                for s, e, alone in zip(starts[some].tolist(), cuts[some].tolist(), bare.tolist())
            ])
            self.numbers.add(a[some], b[some])
        return numbers, counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        collects = gc.isenabled()
        gc.disable()  # lists without cycles by the million: looking for cycles takes a fifth of the time
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not self.byte_level:
            made = self.whole(texts)
            sizes = np.fromiter(map(len, made), np.int64, len(made))
            return np.fromiter(chain.from_iterable(made), np.uint32, int(sizes.sum())), sizes
        if self.numbers.count > self.memo:
            self.forget()
        plain = [self.plain(t) for t in texts]
        odd = np.flatnonzero(~np.array(plain, bool))
        codes, counts = self.pieces(list(compress(texts, plain)))
        ids, ends = self.known.take(codes)
        upto = np.concatenate(([0], ends))[np.cumsum(counts)]
        lengths = np.diff(upto, prepend=0)
        if len(odd):
            own = self.whole([texts[i] for i in odd.tolist()])
            before = odd - np.arange(len(odd))  # plain texts in front of each
            extra = np.fromiter(map(len, own), np.int64, len(own))
            flat = np.fromiter(chain.from_iterable(own), np.uint32, int(extra.sum()))
            ids = np.insert(ids, np.repeat(np.concatenate(([0], upto))[before], extra), flat)
            lengths = np.insert(lengths, before, extra)
        return ids, lengths


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file, with the pieces it has met in
    earlier tasks."""
    with open(path, "rb") as file:
        key = hashlib.sha256(file.read()).hexdigest()
    kept = worker_memo().setdefault("encoders", {})
    if key not in kept:
        kept.clear()
        kept[key] = Encoder(path)
    return kept[key]


def text_runs(batches: Iterator[pa.RecordBatch], most: int = 1 << 18) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Ids and texts in runs of about `most` characters."""
    for batch in batches:
        ids, texts = longs(batch, "doc_id"), batch.column(1).to_pylist()
        at, total = 0, 0
        for i, text in enumerate(texts):
            total += len(text)
            if total >= most:
                yield ids[at : i + 1], texts[at : i + 1]
                at, total = i + 1, 0
        if at < len(texts):
            yield ids[at:], texts[at:]


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, ids (packed, with the end id) of every text. Stored, so that each
    text is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_path)
        kind = _id_type(coder, end_id)
        for ids, texts in text_runs(batches):
            made, lengths = coder.encode(texts)
            raw = np.insert(made, np.cumsum(lengths), end_id).astype(kind).tobytes()
            ends = np.cumsum(lengths + 1) * kind.itemsize
            parts = [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            yield pa.RecordBatch.from_arrays([ids_back(ids), pa.array(parts, pa.binary())], ["doc_id", "ids"])

    return store(doc_text(docs).mapInArrow(run, "doc_id long, ids binary"), "encoded")


def _id_type(coder: Encoder, end_id: int) -> np.dtype:
    return np.dtype("<u2" if max(coder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")


def id_counts(encoded: DataFrame, kind: np.dtype) -> DataFrame:
    """id, n: how often each id occurs in all texts; a task sends one row per id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            made = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind))
            if len(made) > len(counts):
                counts, made = made, counts
            counts[: len(made)] += made
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["id", "n"])

    found = encoded.select("ids").mapInArrow(run, "id long, n long")
    return found.groupBy("id").agg(F.sum("n").alias("n"))


def ranking(counts: DataFrame) -> np.ndarray:
    """Ids by falling frequency, ties to the smaller id. At most one row per id of
    the vocabulary reaches the driver."""
    rows = counts.orderBy(F.desc("n"), "id").collect()
    return np.array([r["id"] for r in rows], np.uint32)


def pack(doc_ids: np.ndarray, lengths: np.ndarray, ranks: np.ndarray, before: int) -> bytes:
    """One file. `before`: ids in earlier files of the same run of documents."""
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = extra
    control = padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    control = np.bitwise_or.reduce(control, axis=1).astype(np.uint8)
    raw = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = raw[np.arange(4)[None, :] <= extra[:, None]]
    head = struct.pack(HEADER, MAGIC, len(doc_ids), len(ranks), before)
    return b"".join(
        (head, doc_ids.astype("<i8").tobytes(), lengths.astype("<u4").tobytes(), control.tobytes(), data.tobytes())
    )


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Document ids, lengths, ranks and `before` of a file."""
    magic, n_docs, n, before = struct.unpack_from(HEADER, payload)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = struct.calcsize(HEADER)
    doc_ids = np.frombuffer(payload, "<i8", n_docs, at)
    lengths = np.frombuffer(payload, "<u4", n_docs, at := at + 8 * n_docs)
    groups = -(-n // 4)
    control = np.frombuffer(payload, np.uint8, groups, at := at + 4 * n_docs)
    sizes = _LENGTHS[control].reshape(-1)[:n]
    data = np.frombuffer(payload + b"\0\0\0", np.uint8, offset=at + groups)
    ends = np.cumsum(sizes, dtype=np.int64)
    starts = ends - sizes
    ranks = data[starts].astype(np.uint32)
    for k in range(1, int(sizes.max()) if n else 1):
        ranks |= data[starts + k].astype(np.uint32) << np.uint32(8 * k)
    return doc_ids, lengths, ranks & _MASKS[sizes - 1], before


def write_files(encoded: DataFrame, kind: np.dtype, by_rank: np.ndarray, file_ids: int = FILE_IDS) -> DataFrame:
    """The files of all documents in ascending id order: part, file_no, n_ids, payload.

    Documents are cut into ranges of ids; each range is sorted and written by its
    own task, which holds one file at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
        rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
        part = TaskContext.get().partitionId()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        number, size, before = 0, 0, 0

        def close() -> pa.RecordBatch:
            payload = pack(*[np.concatenate(x) for x in zip(*held)], before)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([size], pa.int64()), pa.array([payload], pa.binary())],
                ["part", "file_no", "n_ids", "payload"],
            )

        for batch in batches:
            ids, raw = longs(batch, "doc_id"), batch.column(1).to_pylist()
            for a, b in slices(raw, file_ids):
                lengths = np.fromiter(map(len, raw[a:b]), np.int64, b - a) // kind.itemsize
                made = np.frombuffer(b"".join(raw[a:b]), kind)
                held.append((ids[a:b], lengths, rank_of[made]))
                size += len(made)
                if size >= file_ids:
                    yield close()
                    held, number, before, size = [], number + 1, before + size, 0
        if held:
            yield close()

    order = [F.col("doc_id").asc_nulls_first(), F.col("ids")]
    # rows of one id are parted by the start of their ids, which orders them as `ids` does
    ranges = encoded.repartitionByRange(order[0], F.substring("ids", 1, 64))
    ordered = ranges.sortWithinPartitions(*order)
    return store(ordered.mapInArrow(run, "part int, file_no int, n_ids long, payload binary"), "token-files")


def read_files(files: DataFrame, by_rank: np.ndarray) -> DataFrame:
    """doc_id, start, n_tokens, ids of every document, from the files alone.
    The totals of the ranges (one number per range) go through the driver."""
    totals = {r["part"]: r["n"] for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    offset, offsets = 0, {}
    for part in sorted(totals):
        offsets[part] = offset
        offset += totals[part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids, lengths, ranks, before = unpack(payload.as_py())
                lengths = lengths.astype(np.int64)
                ends = np.cumsum(lengths)
                raw = by_rank[ranks].astype("<u4").tobytes()
                for a in range(0, len(doc_ids), 2000):
                    own, e = lengths[a : a + 2000], ends[a : a + 2000]
                    ids = [raw[4 * (x - n) : 4 * x] for x, n in zip(e.tolist(), own.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids_back(doc_ids[a : a + 2000]),
                            pa.array(offsets[part] + before + e - own),
                            pa.array(own),
                            pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return files.select("part", "payload").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> tuple[DataFrame, np.ndarray]:
    """Encode, count, rank, write: the files and the ids by rank that decode them."""
    encoded = encode_documents(docs, tokenizer_path, end_id)
    kind = _id_type(encoder(tokenizer_path), end_id)
    by_rank = ranking(id_counts(encoded, kind))
    return write_files(encoded, kind, by_rank), by_rank


def encoded_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write the documents as token files and read them back."""
    return read_files(*token_files(docs, tokenizer_path, end_id))
