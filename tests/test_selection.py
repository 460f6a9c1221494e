import math
import random

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from loghelm.operators.selection import order_bits, value_of, weighted_percentiles, weighted_quantiles

HARD = [0.0, -0.0, 5e-324, -5e-324, 1.0, np.nextafter(1.0, 2), -1e308, 1e308, math.inf, -math.inf, 2.0**60, -0.1]


def test_bits_order_like_the_doubles():
    rng = random.Random(1)
    values = np.array(HARD + [rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(500)])
    keys = order_bits(values)
    order = np.argsort(keys, kind="stable")
    assert (np.diff(values[order]) >= 0).all() or np.isinf(values).any()
    assert list(values[order]) == sorted(values)
    assert [value_of(k) for k in keys] == list(values)
    assert order_bits(np.array([0.0]))[0] == order_bits(np.array([-0.0]))[0]
    assert order_bits(np.array([math.nan]))[0] > order_bits(np.array([math.inf]))[0]


def expanded(rows, percent):
    flat = sorted(v for v, n in rows if v is not None and n for _ in range(n))
    rank = (len(flat) - 1) * (percent / 100)
    a, b = flat[math.floor(rank)], flat[math.ceil(rank)]
    return a if a == b else (math.ceil(rank) - rank) * a + (rank - math.floor(rank)) * b


@pytest.mark.parametrize("finish_rows", [0, 5, 10_000])
def test_quantiles_equal_a_sorted_list(spark, finish_rows):
    rng = random.Random(2)
    near = [1.0 + i * 2.0**-52 for i in range(40)]
    pool = {"a": near, "b": [rng.gauss(0, 1e6) for _ in range(60)], "c": [7.5], "d": [None, -3.0, 0.0, 2.0]}
    rows = [(*[rng.choice(p) for p in pool.values()], rng.choice([0, 1, 2, 9, None])) for _ in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, n int").repartition(7)
    percents = (0, 12.5, 50, 95, 99.9, 100)
    got = weighted_quantiles(df, {c: percents for c in "abcd"}, "n", finish_rows)
    for i, c in enumerate("abcd"):
        assert got[c] == [expanded([(r[i], r[4] or 0) for r in rows], p) for p in percents]


def test_bits_are_those_of_the_built_in_aggregate(spark):
    df = spark.range(5000).select((F.sin("id") / 7).alias("v"), (F.col("id") % 4).alias("n")).repartition(5)
    for p in (0, 3.7, 33.3, 50, 95, 100):
        want = df.where("n > 0").agg(F.percentile("v", p / 100, F.col("n"))).first()[0]
        assert {weighted_percentiles(df, ("v",), "n", p, k)["v"] for k in (0, 100, 20_000)} == {want}


def test_one_value_with_a_third_of_all_rows(spark):
    df = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, 0.25).otherwise(F.col("id") / 90_000).alias("v"), F.lit(1).alias("n"))
    want = df.agg(F.percentile("v", 0.4), F.percentile("v", 0.9)).first()
    assert weighted_quantiles(df, {"v": (40, 90)}, "n", 50)["v"] == list(want)


def test_no_rows_no_values_no_weights(spark):
    schema = "v double, w double, n int"
    assert weighted_quantiles(spark.createDataFrame([], schema), {"v": (5, 50)}, "n") == {"v": [None, None]}
    df = spark.createDataFrame([(None, 1.0, 3), (None, 2.0, 0), (None, 3.0, None)], schema)
    assert weighted_quantiles(df, {"v": (50,), "w": (50, 100)}, "n") == {"v": [None], "w": [1.0, 1.0]}
    with pytest.raises(PythonException, match="negative"):
        weighted_quantiles(spark.createDataFrame([(1.0, 1.0, -1)], schema), {"v": (50,)}, "n")


def test_rows_are_not_sorted_or_shuffled(spark):
    """Only counts meet: one exchange per pass, on the digit."""
    seen = []
    df = spark.range(1000).select((F.col("id") / 7).alias("v"), F.lit(1).alias("n"))
    apply = type(df).mapInArrow

    def spied(self, fn, schema, *more):
        seen.append(self._jdf.queryExecution().executedPlan().toString())
        return apply(self, fn, schema, *more)

    type(df).mapInArrow = spied
    try:
        weighted_percentiles(df, ("v",), "n", 50, 5)
    finally:
        type(df).mapInArrow = apply
    assert 2 <= len(seen) <= 5 and not any("Exchange" in plan or "Sort" in plan for plan in seen)
