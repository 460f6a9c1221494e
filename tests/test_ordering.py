import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loghelm.operators.lookup import lookup
from loghelm.operators.host_metrics import metrics_as_of
from loghelm.operators.ordering import dense_positions, running_totals, with_range
from loghelm.operators.selection import weighted_percentiles


def skewed(n=600, seed=1):
    """A third of the rows belong to one key."""
    rng = random.Random(seed)
    order = rng.sample(range(10 * n), n)
    return [(i, "hot" if rng.random() < 0.4 else f"k{rng.randint(0, 30)}", o, rng.randint(-5, 5)) for i, o in enumerate(order)]


@pytest.mark.parametrize("rows_per_range", [7, 50, 10_000])
def test_running_totals_equal_a_loop(spark, rows_per_range):
    rows = skewed()
    df = spark.createDataFrame(rows, "id long, k string, o long, v long").repartition(5)
    got = {r["id"]: r["t"] for r in running_totals(df, "o", {"t": F.col("v")}, ("k",), rows_per_range).collect()}
    sums, expected = {}, {}
    for i, k, _, v in sorted(rows, key=lambda r: r[2]):
        sums[k] = sums.get(k, 0) + v
        expected[i] = sums[k]
    assert got == expected


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_positions_are_dense(spark, keys):
    rows = skewed()
    df = spark.createDataFrame(rows, "id long, k string, o long, v long")
    got = {r["id"]: r["pos"] for r in dense_positions(df, "o", keys, rows_per_range=40).collect()}
    seen, expected = {}, {}
    for i, k, _, _ in sorted(rows, key=lambda r: r[2]):
        key = k if keys else None
        expected[i] = seen.get(key, 0)
        seen[key] = expected[i] + 1
    assert got == expected


def test_one_first_value_is_cut_into_many_ranges(spark):
    rows = spark.range(4000).select(F.lit("2025-01-01").cast("timestamp").alias("t"), "id").repartition(7)
    sizes = [r["count"] for r in with_range(rows, ("t", "id"), rows_per_range=100).groupBy("__range").count().collect()]
    assert 30 <= len(sizes) <= 60 and max(sizes) <= 300
    places = dense_positions(rows, ("t", "id"), rows_per_range=100)
    assert places.where("pos <> id").count() == 0


FIRST_VALUES = {
    "long": [None, -5, 2**60, 2**60 + 1, 7],
    "double": [None, float("-inf"), float("inf"), float("nan"), 0.5],
    "string": [None, "", "a", "b", "9"],
    "date": [None, datetime.date(1960, 1, 1), datetime.date(2025, 1, 1)],
}


@pytest.mark.parametrize("kind", FIRST_VALUES)
@pytest.mark.parametrize("rows_per_range", [5, 40])
def test_ties_of_every_kind_keep_the_order(spark, kind, rows_per_range):
    rng = random.Random(3)
    rows = [(rng.choice(FIRST_VALUES[kind]), rng.choice([None, "x", "y", "z"]), i) for i in range(400)]
    df = spark.createDataFrame(rows, f"a {kind}, b string, c long").repartition(3)
    expected = [r["c"] for r in df.coalesce(1).sortWithinPartitions("a", "b", "c").collect()]
    places = dense_positions(df, ("a", "b", "c"), rows_per_range=rows_per_range)
    assert [r["c"] for r in places.orderBy("pos").collect()] == expected
    assert sorted(r["pos"] for r in places.collect()) == list(range(400))


def test_many_incidents_and_samples_of_one_instant(spark):
    at = F.lit("2025-01-01 00:00:00").cast("timestamp")
    schema = "host string, ts timestamp, cpu_percent double, memory_percent double"
    metrics = spark.range(300).select(F.lit("h").alias("host"), at.alias("ts"), F.col("id").cast("double").alias("cpu_percent"), F.lit(1.0).alias("memory_percent"))
    incidents = spark.range(500).select(F.concat(F.lit("i"), "id").alias("log_id"), F.lit("h").alias("host"), at.alias("ts"))
    found = metrics_as_of(incidents, metrics, rows_per_range=20)
    assert found.count() == 500
    assert [r["cpu_percent"] for r in found.select("cpu_percent").distinct().collect()] == [299.0]
    assert metrics_as_of(incidents, spark.createDataFrame([], schema), rows_per_range=20).where("cpu_percent IS NULL").count() == 500


def test_no_window_runs_in_a_single_partition(spark):
    df = spark.createDataFrame(skewed(), "id long, k string, o long, v long")
    plan = dense_positions(df, "o", ("k",), rows_per_range=40)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_percentile_of_four(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1), (3.0, 1), (10.0, 1)], "v double, n long")
    assert weighted_percentiles(df, ("v",), "n", 95.0)["v"] == pytest.approx(8.95)


@pytest.mark.parametrize("percent", [0, 12.5, 50, 95, 100])
@pytest.mark.parametrize("rows_per_range", [30, 10_000])
def test_weighted_percentile_equals_expanded(spark, percent, rows_per_range):
    rng = random.Random(5)
    rows = [(round(rng.gauss(0, 1), 2), rng.randint(1, 9)) for _ in range(300)]
    df = spark.createDataFrame(rows, "v double, n long")
    expanded = np.repeat([v for v, _ in rows], [n for _, n in rows])
    got = weighted_percentiles(df, ("v",), "n", percent, rows_per_range)["v"]
    assert got == pytest.approx(np.percentile(expanded, percent), abs=1e-12)


def test_percentile_range_is_checked(spark):
    with pytest.raises(ValueError):
        weighted_percentiles(spark.range(1).withColumn("n", F.lit(1)), ("id",), "n", 101)


def test_salted_lookup_equals_broadcast(spark):
    rows = skewed(2000) + [(10_000 + i, None, i, 0) for i in range(700)]
    facts = spark.createDataFrame(rows, "id long, k string, o long, v long")
    table = spark.createDataFrame([("hot", 1), ("k3", 2), ("unused", 3)], "k string, w int")
    counts = spark.createDataFrame([("hot", 800), ("k3", 5)], "k string, n long")
    plain = {(r["id"], r["w"]) for r in lookup(facts, table, "k", ("id",)).collect()}
    salted = lookup(facts, table, "k", ("id",), counts=counts, broadcast_bytes=0, rows_per_salt=30)
    rows_out = salted.collect()
    assert len(rows_out) == len(rows)
    assert {(r["id"], r["w"]) for r in rows_out} == plain
    assert "__salt" in salted._jdf.queryExecution().executedPlan().toString()
    sampled = lookup(facts, table, "k", ("id",), broadcast_bytes=0)
    assert {(r["id"], r["w"]) for r in sampled.collect()} == plain


def test_every_key_hot(spark):
    facts = spark.range(9000).select("id", (F.col("id") % 300).cast("string").alias("k"))
    table = spark.range(300).select(F.col("id").cast("string").alias("k"), F.col("id").alias("w"))
    counts = facts.groupBy("k").agg(F.count("*").alias("n"))
    out = lookup(facts, table, "k", ("id",), counts=counts, broadcast_bytes=0, rows_per_salt=10)
    assert out.where(F.col("w") == F.col("id") % 300).count() == 9000


@pytest.mark.parametrize("percent", [0, 33.3, 50, 95, 100])
def test_percentile_has_the_same_bits_on_both_ways(spark, percent):
    df = spark.range(50).select((F.sin("id") / 7).alias("v"), (F.col("id") % 4 + 1).alias("n"))
    built_in = weighted_percentiles(df, ("v",), "n", percent, 50)["v"]
    assert weighted_percentiles(df, ("v",), "n", percent, 10)["v"] == built_in
