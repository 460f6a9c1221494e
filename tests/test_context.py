import random

import pytest
from pyspark.sql import functions as F

from loghelm.operators.context import context_of, recent_tail, with_context, with_root_index, with_trailing_context


def logs(sizes=(1, 2, 57)):
    return {f"f{i}": [f"f{i}-{p}" for p in range(n)] for i, n in enumerate(sizes)}


def table(spark, data):
    rows = [(f, p, t) for f, lines in data.items() for p, t in enumerate(lines)]
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, "file string, pos long, raw_text string")


@pytest.mark.parametrize("chunk", [5, 8, 1000])
def test_windows_of_every_row(spark, chunk):
    data = logs()
    got = with_context(table(spark, data).repartition(7), rows_per_chunk=chunk).collect()
    assert len(got) == sum(len(v) for v in data.values())
    for r in got:
        p = r["pos"]
        assert r["context_window"] == data[r["file"]][max(0, p - 2) : p + 3]


def test_lengths_at_the_edges(spark):
    rows = {r["pos"]: r for r in with_context(table(spark, logs((9,)))).collect()}
    assert [len(rows[p]["context_window"]) for p in (0, 1, 5, 8)] == [3, 4, 5, 3]


@pytest.mark.parametrize("chunk", [6, 1000])
def test_trailing_windows(spark, chunk):
    data = logs()
    for r in with_trailing_context(table(spark, data), rows_per_chunk=chunk).collect():
        p = r["pos"]
        assert r["context_window"] == data[r["file"]][max(0, p - 4) : p + 1]


def test_context_of_flagged_rows_only(spark):
    data = logs()
    lines = table(spark, data)
    flagged = lines.where(F.col("pos").isin(0, 1, 30, 31, 56)).select("file", "pos")
    got = context_of(flagged, lines).collect()
    assert len(got) == 1 + 2 + 5  # positions that exist in the three logs
    for r in got:
        p = r["pos"]
        assert r["context_window"] == data[r["file"]][max(0, p - 2) : p + 3]


def test_root_index(spark):
    rows = with_root_index(with_context(table(spark, logs((9,))))).collect()
    assert all(r["context_window"][r["root_index"]] == r["raw_text"] for r in rows)
    legacy = {r["pos"]: r["root_index"] for r in with_root_index(with_context(table(spark, logs((9,)))), legacy=True).collect()}
    assert (legacy[0], legacy[4], legacy[8]) == (1, 2, 1)


def test_recent_tail(spark):
    got = recent_tail(table(spark, logs((30,)))).collect()
    assert [r["pos"] for r in got] == list(range(22, 30))


def test_chunk_must_exceed_window(spark):
    with pytest.raises(ValueError):
        with_context(table(spark, logs((3,))), rows_per_chunk=4)


def test_plan_has_no_single_partition_window(spark):
    plan = with_context(table(spark, logs()))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_windows_take_the_tasks_that_their_rows_need(spark):
    lines = spark.range(900).select((F.col("id") % 1).alias("file"), F.col("id").alias("pos"), F.col("id").cast("string").alias("raw_text"))
    wide = with_context(lines, rows_per_chunk=30, rows_per_task=60)
    assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert wide.rdd.getNumPartitions() == 15
    plain = with_context(lines, rows_per_chunk=30)
    assert sorted(map(str, wide.collect())) == sorted(map(str, plain.collect()))
