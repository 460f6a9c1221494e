"""The burst trie against plain dictionaries of prefixes."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from loghelm.llm import burst_trie

SCHEMA = "conv_id long, turn long, role string, text string, head string, ids string, n long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def conversations(spark, rows):
    """Rows with columns whose names the operator uses inside."""
    return spark.createDataFrame([(*r, "h", "i", 7) for r in rows], SCHEMA)


def brute(rows):
    kept = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            named = f"{len((role or '').encode())}:{role or ''}{text or ''}"
            key = (turn is not None, turn or 0, role or "", hashlib.sha256(named.encode()).digest()[:16])
            kept.setdefault(conv, []).append((key, (role or "", text or "")))
    kept = {c: [t for _, t in sorted(turns)] for c, turns in kept.items()}
    made = {}
    for c, turns in kept.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = tuple(kept.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
    nodes = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = set()
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(nodes[p]) - 1) * len(WORD.findall(p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in sorted(members) if len(made[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        out.add((min(members), len(path), parent, len(members), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def sample(rng, n):
    """Conversations with common first turns, copies, nulls and one long one."""
    rows = []
    for c in range(n):
        opening = ["hello there", "what is\tthis", "ok"][min(2, rng.randint(0, 8))]
        texts = [opening] + [rng.choice(["a b", "c", "", None, "d e f", "né à"]) for _ in range(rng.randint(0, 6))]
        if c % 3 == 0:
            texts = ["copied", "reply one", "reply two"]
        rows += [(c, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]
    rows += [(n, i, "user", f"t{i % 5}") for i in range(300)]
    rows += [(n + 1, None, None, "no number"), (n + 1, 4, "user", "x"), (n + 1, 4, "user", "x"), (n + 1, None, "user", None)]
    rows += [(None, 1, "user", "of nobody"), (n + 45, 0, "system", "alone"), (-7, 0, "user", "below zero")]
    return rows


@pytest.mark.parametrize("limit", [1, 3, 256])
def test_trie_equals_brute_force(spark, limit):
    rows = sample(random.Random(8), 90)
    got = burst_trie.trie_nodes(conversations(spark, rows).repartition(5), limit).collect()
    assert len(got) == len({(r["conv_id"], r["depth"]) for r in got})
    assert {tuple(r) for r in got} == brute(rows)


def test_many_chunks_of_one_group(spark):
    rows = [(c, 0, "user", "same words") for c in range(0, 5000, 7)]
    assert {tuple(r) for r in burst_trie.trie_nodes(conversations(spark, rows)).collect()} == brute(rows)


def test_only_turnless_conversations(spark):
    """One turn, replaced by the lead of a conversation that is not there."""
    rows = [(c, 0, "user", "gone") for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4]
    got = burst_trie.trie_nodes(conversations(spark, rows)).collect()
    assert {tuple(r) for r in got} == brute(rows) and len(got) == 1


def test_containers_stay_within_the_limit(spark):
    rows = [(c, i, "user", "x" if i < 3 else f"{c % (i + 2)}") for c in range(400) for i in range(6)]
    sequences = burst_trie.distinct_sequences(burst_trie.rebuilt(burst_trie.turns_of(conversations(spark, rows))))
    entries, heads = burst_trie.burst(burst_trie.store(sequences, "s"), 8)
    sizes = [r["count"] for r in entries.groupBy("head").count().collect()]
    assert max(sizes) <= 8 and heads.where(F.col("bottom") > F.col("at")).count() > 0


def test_empty_table(spark):
    got = burst_trie.trie_nodes(conversations(spark, []).limit(0))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert got.count() == 0
