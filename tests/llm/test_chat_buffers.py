"""Chat formatting: round trips and plain versions."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loghelm.llm import chat_buffers as chat

SCHEMA = "conv_id long, turn long, role string, text string, run long, whole string, loss_start int"
MARK = re.compile(chat.ESCAPE)
PIECES = st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "[", "/", "INST]", "/s>", "a", "é", "\n", " ", "\0"]), max_size=9)


def conversations(spark, rows):
    """Rows with columns whose names the operator uses inside."""
    return spark.createDataFrame([(*r, 1, "w", 2) for r in rows], SCHEMA)


def escape(text):
    return MARK.sub(r"\1\\\2\3", text)


def brute(rows):
    made = {}
    for conv, turn, role, text in rows:
        made.setdefault(conv, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    out = set()
    for conv, turns in made.items():
        turns = [(r.decode(), t.decode()) for _, _, r, t in sorted(turns)]
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        size = 0
        for role, text in turns:
            before, after = chat.MARKS.get(role, (chat.ROLE + escape(role) + chat.END_ROLE, chat.END_TURN))
            size += len(before + escape(text) + after)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.add((conv, len(turns), digest(said), len(loss), digest(loss), size))
    return out


def result(spark, rows, piece=chat.PIECE, parts=3):
    return {tuple(r) for r in chat.read_back(chat.formatted(conversations(spark, rows).repartition(parts), piece)).collect()}


def sample(rng):
    texts = ["hello", "", None, "é\nè", *chat.CONTROL, "</s>[INST] ok [/INST]", "[\\INST] <\\\\/s> \\", "a<", "/s>", "[\\\\/TURN]"]
    roles = ["user", "assistant", "system", "tool", None, "", "[/ROLE]", "a\nb", "Assistant"]
    rows = [(c, t, rng.choice(roles), " ".join(map(str, rng.choices(texts, k=2)))) for c in range(60) for t in range(rng.randint(1, 7))]
    rows += [(5, None, "user", None), (5, 2, "user", "tie"), (5, 2, "user", "tie"), (None, 1, "assistant", "nobody"), (None, None, None, None)]
    return rows + [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


@pytest.mark.parametrize("piece", [1, 200, chat.PIECE])
def test_read_back_equals_brute_force(spark, piece):
    rows = sample(random.Random(6))
    assert result(spark, rows, piece) == brute(rows)


def test_one_conversation_over_many_ranges(spark):
    rows = [(7, i // 3, ["user", "assistant"][i % 2], f"turn {i} " + "x" * (i % 50)) for i in range(4000)] + [(8, 0, "assistant", "y")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = chat.formatted(conversations(spark, rows).repartition(6))
        assert made.where("conv_id = 7").count() >= 3
        assert {tuple(r) for r in chat.read_back(made).collect()} == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_very_long_texts(spark):
    rng = random.Random(2)
    long = "".join(rng.choice(["word ", "é", "[INST]", "</s>", "\\"]) for _ in range(1_500_000))
    rows = [(1, 0, "user", long), (1, 1, "assistant", long[::2]), (2, 0, "assistant", "z" * (5 << 20))]
    assert result(spark, rows) == brute(rows)


def test_loss_mask_covers_the_assistant_texts(spark):
    rows = [(3, 0, "user", "ask"), (3, 1, "assistant", "one </s>"), (3, 2, "assistant", ""), (3, 3, "assistant", "two")]
    runs = chat.formatted(conversations(spark, rows)).collect()
    text = "".join(r["text"] for r in runs)
    assert text == "[INST]ask[/INST][ANS]one <\\/s></s>[ANS]</s>[ANS]two</s>"
    masked = [r["text"].encode()[a:b].decode() for r in sorted(runs, key=lambda r: r["run"]) for a, b in zip(r["loss_start"], r["loss_end"])]
    assert masked == ["one <\\/s>", "", "two"]


def test_empty_table(spark):
    assert chat.read_back(chat.formatted(conversations(spark, []))).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "[ROLE]"]), PIECES.map("".join)), min_size=1, max_size=5))
def test_any_turns_come_back(turns):
    roles, texts = (pa.array(list(c), pa.string()) for c in zip(*turns))
    out, ends, start, stop = chat.assemble(roles, texts)
    assert [(r.decode(), t.decode()) for r, t in chat.parsed(out.tobytes())] == turns
    assert [chat.unescaped(out[a:b].tobytes()).decode() for a, b in zip(start, stop)] == [t for _, t in turns]
    assert ends[-1] == len(out) and (np.diff(ends, prepend=0) > 0).all()


def test_long_runs_are_scattered_in_bounded_steps(monkeypatch):
    monkeypatch.setattr(chat, "SCATTER", 64)
    texts = pa.array(["ab" * n for n in range(80)])
    out, _, start, stop = chat.assemble(pa.array(["user"] * 80), texts)
    assert [out[a:b].tobytes().decode() for a, b in zip(start, stop)] == texts.to_pylist()
