"""Prefix trie of conversations, built as a burst trie over shards.

A turn is known by 16 bytes of the SHA-256 of its role and text (its turn id), a
conversation by its turn ids one after the other. Equal conversations are one
entry with their number, least id and the digest of all their ids, so a group of
copies is small before the trie is built.

Entries lie in containers under trie heads. A head is a prefix of turns, its
container holds every entry that starts with it. A container of more than
`limit` entries bursts: the turns that all its entries share (the common prefix
of its least and its greatest entry, both found by one aggregation) become a
chain of nodes, and the next turn id sends each entry to a new head below.
Bursting ends when no container is oversized; each round stores only entries of
burst containers. The remaining containers are dealt to shards, sorted by head
and turn ids, and swept into nodes with the path of the last entry as the only
state. Sums over subtrees that lie above containers come from one aggregation of
the containers' totals by the heads they hang under.

A task holds one batch, one path and the finished children along it: a container
at most. Every round is a stored table.

Cases: a null role or text is empty; turns of one number are ordered by role and
turn id, null numbers first; rows without a conversation id belong to no
conversation and have no node; a repeated row is a turn more; an empty table gives
no rows, not even the root. The turn ids and word counts of one conversation
(20 bytes a turn) are one row and must fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loghelm.llm.common import store
from loghelm.operators.lookup import lookup

#: Entries of a container beyond which it bursts.
LIMIT = 256
#: Ids of one group of equal conversations are chunked by this many bits of the id.
CHUNK_BITS = 8
ID_BYTES = 16
NO_WORDS = hashlib.sha256(b"").digest()
NODE_SCHEMA = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends binary, head binary"
)


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: the turns of each conversation in order, as (id, words)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    # the length of the role parts it from the text without a character of its own
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            role.alias("role"),
            F.substring(F.unhex(F.sha2(named, 256)), 1, ID_BYTES).alias("id"),
            F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).alias("words"),
        ).alias("t"),
    )
    # structs compare field by field, nulls first
    turns = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def rebuilt(turns: DataFrame, group: int = 20, modulus: int = 4) -> DataFrame:
    """conv_id, ids, words: the first h turns of the first conversation of the
    group of `group` ids, then the own turns after the first h, where h is the
    crc32 of the id modulo `modulus`."""
    c = F.col("conv_id")
    own = turns.withColumn("h", (F.crc32(c.cast("string")) % modulus).cast("int")).withColumn("base", c - c % group)
    first = turns.where(c % group == 0).select(c.alias("base"), F.slice("turns", 1, modulus - 1).alias("lead"))
    lead = F.slice(F.coalesce("lead", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    joined = own.join(first, "base", "left").select(
        "conv_id", F.concat(lead, F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns")
    )
    ids = F.unhex(F.array_join(F.transform("turns.id", lambda x: F.hex(x)), ""))
    return joined.select("conv_id", ids.alias("ids"), F.col("turns.words").alias("words"))


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """conv (least id), n, ends (SHA-256 of the comma-joined ids), ids, words of
    each distinct sequence.

    A group's ids are first gathered in chunks of neighbouring ids, then its
    chunks pass one digest in order: what stays in sequence is the hashing of the
    id text, which the digest itself demands.
    """
    chunk = F.shiftright("conv_id", CHUNK_BITS).alias("chunk")
    chunks = convs.groupBy(F.sha2("ids", 256).alias("seq"), chunk).agg(
        F.array_sort(F.collect_list("conv_id")).alias("convs"), F.first("ids").alias("ids"), F.first("words").alias("words")
    )
    texts = chunks.select(
        "seq", "chunk", F.col("convs")[0].alias("conv"), F.size("convs").cast("long").alias("n"),
        F.array_join(F.transform("convs", lambda c: c.cast("string")), ",").alias("text"), "ids", "words",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, least, total, digest = None, 0, 0, hashlib.sha256()
        held: pa.RecordBatch | None = None  # the row of the open group
        for batch in batches:
            closed: list[tuple[int, int, bytes]] = []
            rows: list[pa.RecordBatch] = []
            begins: list[int] = []
            names = ("seq", "conv", "n", "text")
            for i, (seq, conv, n, text) in enumerate(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names))):
                if seq != last:
                    if last is not None:
                        closed.append((least, total, digest.digest()))
                    begins.append(i)
                    last, least, total, digest = seq, conv, 0, hashlib.sha256()
                elif text:
                    digest.update(b",")
                total += n
                digest.update(text.encode())
            kept = batch.take(pa.array(begins, pa.int64())).select(["ids", "words"])
            rows = [r for r in (held, kept) if r is not None and r.num_rows]
            if rows:
                whole = pa.Table.from_batches(rows).combine_chunks()
                done = whole.slice(0, whole.num_rows - 1)
                held = whole.slice(whole.num_rows - 1).combine_chunks().to_batches()[0]
                yield from _sequences(closed, done)
        if held is not None:
            yield from _sequences([(least, total, digest.digest())], pa.Table.from_batches([held]))

    ordered = texts.repartition("seq").sortWithinPartitions("seq", "chunk")
    return ordered.mapInArrow(run, "conv long, n long, ends binary, ids binary, words array<int>")


def _sequences(closed: list[tuple[int, int, bytes]], rows: pa.Table) -> Iterator[pa.RecordBatch]:
    if closed:
        conv, n, ends = (list(x) for x in zip(*closed))
        made = pa.table([pa.array(conv, pa.int64()), pa.array(n, pa.int64()), pa.array(ends, pa.binary()), *rows.columns], ["conv", "n", "ends", "ids", "words"])
        yield from made.combine_chunks().to_batches()


def _depth(ids: str = "ids") -> Column:
    return (F.octet_length(ids) / ID_BYTES).cast("int")


def _under(entries: DataFrame, at: Column, up: Column, parent: Column) -> DataFrame:
    """Entries under the head of their first `at` turns; `ups` has the burst heads above."""
    head = F.substring(F.unhex(F.sha2(F.col("ids").substr(F.lit(1), at * ID_BYTES), 256)), 1, ID_BYTES)
    return entries.select(
        "conv", "n", "ends", "ids", "words", at.alias("at"), up.alias("ups"), parent.alias("parent"), head.alias("head")
    )


def _common_turns(lo: Column, hi: Column) -> Column:
    """Turns that two id strings share from the start."""
    least = (F.least(F.octet_length(lo), F.octet_length(hi)) / ID_BYTES).cast("int")
    piece = lambda x, i: x.substr((i - 1) * ID_BYTES + 1, F.lit(ID_BYTES))
    same = F.transform(F.sequence(F.lit(1), least), lambda i: piece(lo, i) == piece(hi, i))
    differs = F.when(least > 0, F.array_position(same, False)).otherwise(F.lit(0))
    return F.when(differs > 0, differs - 1).otherwise(least).cast("int")


def burst(sequences: DataFrame, limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    """The entries in containers of at most `limit`, and the burst heads.

    Heads: head, at, bottom (depth after the shared turns), parent, conv, n,
    words (of the shared turns), ends (of the entry that stops at the bottom),
    n_children, ups. The root is a burst head in any case.
    """
    turnless = F.max(F.when(F.octet_length("ids") == 0, F.col("ends"))).alias("ends")
    total = sequences.agg(F.sum("n").alias("n"), F.min("conv").alias("conv"), turnless).first()
    root = F.unhex(F.lit("00" * ID_BYTES))
    named = sequences.where(F.octet_length("ids") > 0)
    entries = _under(named, F.lit(1), F.array(root), F.lit(total["conv"]).cast("long"))
    tops = [
        sequences.sparkSession.range(1).select(
            root.alias("head"), F.lit(0).alias("at"), F.lit(0).alias("bottom"), F.lit(None).cast("long").alias("parent"),
            F.lit(total["conv"]).cast("long").alias("conv"), F.lit(total["n"]).cast("long").alias("n"),
            F.array(F.lit(0)).alias("words"), F.lit(total["ends"]).cast("binary").alias("ends"), F.array(root).alias("ups"),
        )
    ]
    settled, children = [], []
    while True:
        found = store(
            entries.groupBy("head").agg(
                F.count("*").alias("size"), F.sum("n").alias("n"), F.min("conv").alias("conv"),
                F.min("ids").alias("lo"), F.max("ids").alias("hi"), F.min_by("words", "ids").alias("words"), F.min_by("ends", "ids").alias("ends"),
                F.first("at").alias("at"), F.first("ups").alias("ups"), F.first("parent").alias("parent"),
            ),
            "containers",
        )
        children.append(found.groupBy(F.element_at("ups", -1).alias("head")).agg(F.count("*").alias("n_children")))
        large = found.where(F.col("size") > limit).withColumn("bottom", _common_turns(F.col("lo"), F.col("hi")))
        if large.isEmpty():
            settled.append(entries)
            break
        shared = F.slice("words", F.col("at"), F.col("bottom") - F.col("at") + 1)
        # an entry that stops where the shared turns do is the least one
        stops = F.when(_depth("lo") == F.col("bottom"), F.col("ends")).alias("ends")
        large = store(large.select("head", "at", "bottom", "parent", "conv", "n", shared.alias("words"), stops, "ups", "size"), "burst")
        tops.append(large.drop("size"))
        marks = store(large.select("head", "bottom", F.col("conv").alias("above")), "marks")
        marked = lookup(entries, marks, "head", ("conv",), large.select("head", F.col("size").alias("n")))
        settled.append(marked.where("bottom IS NULL").select(entries.columns))
        below = marked.where(_depth() > F.col("bottom"))
        ups = F.concat("ups", F.array("head"))
        entries = store(_under(below, F.col("bottom") + 1, ups, F.col("above")), "entries")
    heads = store(_all(tops), "tops").join(_all(children), "head", "left")
    return _all(settled), store(heads.fillna({"n_children": 0}), "heads")


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


class _Node:
    __slots__ = ("children", "conv", "ends", "leaves", "n", "rows", "saved", "words")

    def __init__(self, words: int):
        self.words, self.n, self.conv, self.children, self.leaves, self.saved = words, 0, None, 0, 0, 0
        self.ends, self.rows = NO_WORDS, []


def swept(batches: Iterator[pa.RecordBatch], rows_out: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose rows come sorted by head and turn ids.

    `path` holds the nodes of the last entry from its head on. A node leaves it
    when an entry does not pass it; its own row waits in its parent until the
    parent's least conversation is known.
    """
    out: list[list] = []
    path: list[_Node] = []
    head, at, parent, last = None, 0, None, b""

    def close(keep: int) -> None:
        while len(path) > keep:
            node = path.pop()
            depth = at + len(path)
            node.leaves = node.leaves or 1
            node.saved += (node.n - 1) * node.words
            for row in node.rows:
                row[2] = node.conv
            out.extend(node.rows)
            row = [node.conv, depth, parent, node.n, node.children, node.leaves, node.saved, node.ends, None]
            if not path:
                row[8] = head
                out.append(row)
                continue
            above = path[-1]
            above.rows.append(row)
            above.n += node.n
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved
            if above.conv is None or node.conv < above.conv:
                above.conv = node.conv

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[]] * 9
        types = [pa.int64()] * 7 + [pa.binary()] * 2
        names = [c.split()[0] for c in NODE_SCHEMA.split(", ")]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in batches:
        columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        for own, ids, conv, n, ends, words, first, over in zip(
            *(columns[c].to_pylist() for c in ("head", "ids", "conv", "n", "ends", "words", "at", "parent"))
        ):
            size = len(ids) // ID_BYTES
            if own != head:
                close(0)
                head, at, parent, shared = own, first, over, 0
            else:
                # turns after the head's that the last entry shares
                shared = 1
                most = min(len(path), size - at + 1)
                while shared < most:
                    a = (at + shared - 1) * ID_BYTES
                    if ids[a : a + ID_BYTES] != last[a : a + ID_BYTES]:
                        break
                    shared += 1
                close(shared)
            path.extend(_Node(w) for w in words[at - 1 + shared : size])
            node = path[-1]
            node.n += n
            node.ends = ends
            node.conv = conv if node.conv is None else min(conv, node.conv)
            last = ids
        if len(out) >= rows_out:
            yield flush()
    close(0)
    yield flush()


def _ordered_hex(column: str) -> Column:
    return F.lower(F.hex(F.coalesce(F.col(column), F.unhex(F.lit(NO_WORDS.hex())))))


def trie_nodes(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations."""
    sequences = store(distinct_sequences(rebuilt(turns_of(conversations))), "sequences")
    if sequences.isEmpty():
        schema = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
        return conversations.sparkSession.createDataFrame([], schema)
    entries, heads = burst(sequences, limit)
    ordered = entries.repartition("head").sortWithinPartitions("head", "ids")
    nodes = store(ordered.mapInArrow(swept, NODE_SCHEMA), "nodes")

    # what containers and chains of burst heads add to every burst head above them
    extra = F.aggregate(F.col("words"), F.lit(0).cast("long"), lambda a, w: a + w) * (F.col("n") - 1)
    above = entries.groupBy("head").agg(F.first("ups").alias("ups"))
    totals = nodes.where("head IS NOT NULL").join(above, "head").select("ups", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    chains = heads.where("at > 0").select("ups", F.lit(0).cast("long").alias("leaves"), extra.alias("saved"))
    sums = (
        totals.unionByName(chains)
        .select(F.explode("ups").alias("head"), "leaves", "saved")
        .groupBy("head")
        .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    )
    per = heads.join(sums, "head", "left").fillna({"leaves": 0, "saved": 0})
    # a burst head is the chain of the turns all its entries share, from `at` to `bottom`
    chain = per.select("*", F.posexplode("words").alias("step", "w"))
    rest = F.aggregate(
        F.slice("words", F.col("step") + 1, F.size("words")), F.lit(0).cast("long"), lambda a, w: a + w
    ) * (F.col("n") - 1)
    is_last = F.col("step") == F.size("words") - 1
    burst_nodes = chain.select(
        F.col("conv").alias("conv_id"),
        (F.col("at") + F.col("step")).cast("long").alias("depth"),
        F.when(F.col("step") > 0, F.col("conv")).otherwise(F.col("parent")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(is_last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
        # the root of conversations without turns is a leaf itself
        F.greatest(F.col("leaves"), F.lit(1)).cast("long").alias("n_leaves"),
        (F.col("saved") + rest).alias("saved_tokens"),
        F.when(is_last, F.col("ends")).alias("ends"),
    )
    every = nodes.drop("head").unionByName(burst_nodes)
    return every.select(*[c for c in every.columns if c != "ends"], _ordered_hex("ends").alias("ends_sha256"))
