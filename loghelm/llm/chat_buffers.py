"""Chat formatting by columnar byte assembly.

Template. A turn is an opening mark, the text and a closing mark:

    system      [SYS] text [/SYS]
    user        [INST] text [/INST]
    assistant   [ANS] text </s>
    any other   [ROLE] role [/ROLE] text [/TURN]

without the blanks shown here around the text and the role. Texts and roles that
hold a mark are escaped: one backslash is put behind the first character of the
mark, in front of any that stand there already, and reading back takes one away.
So no mark occurs inside a text, and every text comes back as it was.

Assembly. Rows are dealt by ranges of (conversation, turn, start of role and text) and
sorted, so a conversation of any size is spread over tasks. Per batch, numpy computes the length of
every segment (mark, role, text), their cumulative offsets and the scatter
indices of all bytes; marks and contents are copied into one preallocated Arrow buffer, whose
slices are the formatted rows. A formatted row is a run of turns of one
conversation: all of them, unless the conversation is longer than a piece or
crosses a range; such runs are numbered in order and marked as not whole. The
loss mask is a list of byte ranges of the formatted text: the texts of the
assistant's turns, without marks.

Reading back parses formatted rows alone. Whole conversations are read where
they lie; runs of the others are first brought together in order and pass one
digest as a stream, so no conversation is ever held.

Cases: a null role or text is empty; null turns come first, turns of one number
are ordered by role and text; a repeated row is a turn more; rows without an id
are one conversation without an id; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loghelm.llm.common import NO_ID, ids_back, longs, store

#: Opening and closing marks by role.
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>")}
#: Marks of other roles: before and after the role, after the text.
ROLE, END_ROLE, END_TURN = "[ROLE]", "[/ROLE]", "[/TURN]"
CONTROL = ("<s>", "</s>", *(f"[{slash}{name}]" for name in ("SYS", "INST", "ANS", "ROLE", "TURN") for slash in ("", "/")))
_TAILS = "|".join(re.escape(m[1:]) for m in CONTROL)
#: A mark with any number of backslashes behind its first character.
ESCAPE = rf"([<\[])(\\*)({_TAILS})"
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)({_TAILS})".encode())
_READ = re.compile("|".join(re.escape(m) for m in CONTROL).encode())
#: Bytes of the open conversation beyond which its turns so far become a row.
PIECE = 1 << 20
#: Bytes that are scattered at once.
SCATTER = 1 << 22
RUN_SCHEMA = "conv_id long, run long, whole boolean, text string, loss_start array<int>, loss_end array<int>"


def escaped(texts: pa.Array) -> pa.Array:
    """Texts with every mark escaped; those without one are not touched."""
    if pc.any(pc.match_substring_regex(texts, ESCAPE)).as_py():
        return pc.replace_substring_regex(texts, ESCAPE, r"\1\\\2\3")
    return texts


def unescaped(text: bytes) -> bytes:
    return _UNESCAPE.sub(rb"\1\2\3", text) if b"\\" in text else text


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (int64) of a text column without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), offsets


def scatter(out: np.ndarray, to: np.ndarray, source: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
    """Copy `source[start : start + size]` to `out[to : to + size]` for every row,
    by one index per byte, a bounded number of bytes at a time."""
    ends = np.cumsum(size)
    at = 0
    while at < len(size):
        before = int(ends[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + SCATTER, "right")))
        n = size[at:upto]
        if upto == at + 1:
            out[to[at] : to[at] + n[0]] = source[start[at] : start[at] + n[0]]
        else:
            inside = np.arange(int(ends[upto - 1]) - before) - np.repeat(ends[at:upto] - n - before, n)
            out[np.repeat(to[at:upto], n) + inside] = source[np.repeat(start[at:upto], n) + inside]
        at = upto


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The formatted turns in one buffer: bytes, where each turn ends, and where
    the text of each turn starts and ends."""
    marks = [*MARKS.values(), (ROLE, END_TURN)]
    kinds = pc.fill_null(pc.index_in(roles, pa.array(list(MARKS))), len(MARKS)).to_numpy(zero_copy_only=False)
    other = kinds == len(MARKS)
    named = escaped(pc.if_else(pa.array(other), roles, ""))
    role_data, role_at = _buffers(named)
    text_data, text_at = _buffers(escaped(texts))
    table = b"".join(x.encode() for pair in marks for x in pair) + END_ROLE.encode()
    sizes = np.array([len(x) for pair in marks for x in pair] + [len(END_ROLE)])
    places = np.cumsum(sizes) - sizes
    # segments of a turn: opening mark, role, end of the role, text, closing mark
    lengths = np.stack(
        [sizes[2 * kinds], np.diff(role_at), other * len(END_ROLE), np.diff(text_at), sizes[2 * kinds + 1]], axis=1
    ).astype(np.int64)
    ends = np.cumsum(lengths.reshape(-1)).reshape(-1, 5)
    to = ends - lengths
    out = np.empty(int(ends[-1, -1]) if len(ends) else 0, np.uint8)
    marked = np.frombuffer(table, np.uint8)
    scatter(out, to[:, 0], marked, places[2 * kinds], lengths[:, 0])
    scatter(out, to[:, 1], role_data, role_at[:-1], lengths[:, 1])
    scatter(out, to[:, 2], marked, np.full(len(kinds), places[-1]), lengths[:, 2])
    scatter(out, to[:, 3], text_data, text_at[:-1], lengths[:, 3])
    scatter(out, to[:, 4], marked, places[2 * kinds + 1], lengths[:, 4])
    return out, ends[:, 4], to[:, 3], ends[:, 3]


def _runs(ids: np.ndarray, roles: pa.Array, texts: pa.Array, runs: np.ndarray, numbers: np.ndarray, whole: np.ndarray) -> pa.RecordBatch:
    """Formatted rows of consecutive turns; row i has the turns from runs[i] to runs[i + 1]."""
    out, ends, text_from, text_to = assemble(roles, texts)
    edges = np.concatenate(([0], ends))[runs]
    formatted = pa.LargeStringArray.from_buffers(len(runs) - 1, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(out))
    masked = pc.equal(roles, "assistant").to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(runs) - 1), np.diff(runs))[masked]
    upto = np.searchsorted(row, np.arange(len(runs))).astype(np.int32)
    mask = [pa.ListArray.from_arrays(pa.array(upto), pa.array((x[masked] - edges[row]).astype(np.int32))) for x in (text_from, text_to)]
    return pa.RecordBatch.from_arrays(
        [ids_back(ids), pa.array(numbers), pa.array(whole), formatted.cast(pa.string()), *mask],
        ["conv_id", "run", "whole", "text", "loss_start", "loss_end"],
    )


def formatted(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """conv_id, run, whole, text, loss_start, loss_end (byte ranges of `text`):
    all conversations as formatted rows."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")),
    )
    keys = ["conv_id", "turn", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []  # turns of the open conversation, not yet formatted
        size, begun = 0, False  # bytes held; whether the open conversation may have earlier rows
        first = True
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.select(["conv_id", "role", "text"])
            if held and longs(held[-1], "conv_id")[-1] != longs(batch, "conv_id")[0]:
                yield from close(held, number, not begun and not first)
                number, held, size, begun, first = number + 1, [], 0, False, False
            ids = longs(batch, "conv_id")
            starts = np.flatnonzero(np.diff(ids, prepend=~ids[0]))
            if held and len(starts) > 1:
                yield from close([*held, batch.slice(0, starts[1])], number, not begun and not first)
                number, held, size, begun, first = number + 1, [], 0, False, False
                batch, ids, starts = batch.slice(starts[1]), ids[starts[1] :], starts[1:] - starts[1]
            if len(starts) > 1:
                done = batch.slice(0, starts[-1])
                whole = np.ones(len(starts) - 1, bool)
                whole[0] = not first
                yield _runs(ids[starts[:-1]], done.column(1), done.column(2), starts, number + np.arange(len(starts) - 1), whole)
                number, first = number + len(starts) - 1, False
                batch = batch.slice(starts[-1])
            held.append(batch)
            size += batch.nbytes
            if size >= piece:
                yield from close(held, number, False)
                number, held, size, begun = number + 1, [], 0, True
        if held:
            yield from close(held, number, False)  # the next range may go on with it

    def close(held: list[pa.RecordBatch], number: int, whole: bool) -> Iterator[pa.RecordBatch]:
        turns = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        yield _runs(longs(turns, "conv_id")[:1], turns.column(1), turns.column(2), np.array([0, turns.num_rows]), np.array([number]), np.array([whole]))

    # ranges are cut by short columns that order rows as the keys do: their sample goes to the driver
    role = F.substring("role", 1, 32)
    text = F.when(F.length("role") <= 32, F.substring("text", 1, 32)).otherwise(F.lit(""))
    ranges = rows.repartitionByRange(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), role, text)
    ordered = ranges.sortWithinPartitions(*keys)
    return store(ordered.mapInArrow(run, RUN_SCHEMA), "formatted")


def parsed(text: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Role and text of every turn of a formatted text."""
    opened = {a.encode(): (role.encode(), b.encode()) for role, (a, b) in MARKS.items()}
    role, closing, at = b"", b"", 0
    for found in _READ.finditer(text):
        mark = found.group()
        if closing:
            if mark == END_ROLE.encode() and closing == mark:
                role, closing = unescaped(text[at : found.start()]), END_TURN.encode()
            elif mark == closing:
                yield role, unescaped(text[at : found.start()])
                closing = b""
            else:
                raise ValueError(f"mark {mark!r} inside a turn")
        elif mark in opened:
            role, closing = opened[mark]
        elif mark == ROLE.encode():
            closing = END_ROLE.encode()
        else:
            raise ValueError(f"mark {mark!r} between turns")
        at = found.end()
    if closing:
        raise ValueError("a turn without an end")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What formatted rows say, one row per conversation; rows of a conversation follow each other."""
    names = [c.split()[0] for c in READ_SCHEMA.split(", ")]
    conv: int | None = None
    turns = loss = None
    n_turns = loss_chars = chars = 0
    for batch in batches:
        out: list[tuple] = []
        texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
        starts, ends = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("loss_start", "loss_end"))
        for own, text, a, b in zip(longs(batch, "conv_id").tolist(), texts, starts, ends):
            if own != conv or turns is None:
                if turns is not None:
                    out.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                conv, turns, loss = own, hashlib.sha256(), hashlib.sha256()
                n_turns = loss_chars = chars = 0
            for role, said in parsed(text):
                turns.update(role + b"\n" + said + b"\n")
                n_turns += 1
            for x, y in zip(a, b):
                said = unescaped(text[x:y])
                loss.update(said)
                loss_chars += len(said.decode())
            chars += len(text.decode())
        yield _digest_batch(out, names)
    if turns is not None:
        yield _digest_batch([(conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)], names)


READ_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 6
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    made = [ids_back(np.array(columns[0], np.int64)), *(pa.array(c, t) for c, t in zip(columns[1:], types[1:]))]
    return pa.RecordBatch.from_arrays(made, names)


def read_back(runs: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of every
    formatted conversation, from the formatted text and its loss mask."""
    columns = ["conv_id", "text", "loss_start", "loss_end"]
    whole = runs.where("whole").select(columns).mapInArrow(_digests, READ_SCHEMA)
    rest = runs.where("NOT whole").repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "run")
    return whole.unionByName(rest.select(columns).mapInArrow(_digests, READ_SCHEMA))
