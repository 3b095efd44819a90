"""Exact quantiles, running sums and positions against brute force."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import values
from tillsight.functions import ordering as o

QS = {"a": 0.0, "b": 0.1, "c": 0.25, "d": 0.5, "e": 0.9, "f": 0.99, "g": 1.0}


def skewed_values(n=6000, seed=7):
    """A third of the rows share one value; the rest has outliers and both signs."""
    rnd = random.Random(seed)
    hot = [37.5] * (n // 3)
    rest = [rnd.choice([rnd.gauss(0, 1), rnd.lognormvariate(5, 4), -rnd.lognormvariate(3, 2), 0.0, 1e15 * rnd.random()]) for _ in range(n - len(hot))]
    return hot + rest


def test_quantiles_match_numpy_on_skewed_values(spark):
    xs = skewed_values()
    df = spark.createDataFrame([(x,) for x in xs] + [(None,)] * 5, "x double").repartition(7)
    got = o.exact_quantiles(df, "x", QS).first()
    for name, q in QS.items():
        assert got[name] == pytest.approx(np.quantile(xs, q), rel=1e-12)


def test_quantiles_by_group_with_a_hot_group(spark):
    rnd = random.Random(3)
    rows = [("hot", rnd.gauss(100, 30)) for _ in range(3000)] + [(f"g{i % 50}", rnd.random() * i) for i in range(3000)] + [("one", 4.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {r["g"]: r for r in o.exact_quantiles(df, "x", {"q": 0.3, "m": 0.5}, ["g"]).collect()}
    groups = {}
    for g, x in rows:
        if x is not None:
            groups.setdefault(g, []).append(x)
    assert set(got) == set(groups)
    for g, xs in groups.items():
        assert got[g]["q"] == pytest.approx(np.quantile(xs, 0.3)) and got[g]["m"] == pytest.approx(np.median(xs))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=40))
def test_quantiles_property(spark, xs):
    got = o.exact_quantiles(spark.createDataFrame([(x,) for x in xs], "x double"), "x", {"q": 0.25, "m": 0.5}).first()
    assert got["q"] == pytest.approx(np.quantile(xs, 0.25), rel=1e-9, abs=1e-300)
    assert got["m"] == pytest.approx(np.quantile(xs, 0.5), rel=1e-9, abs=1e-300)


def test_no_rows_gives_one_null_row(spark):
    got = o.exact_quantiles(spark.createDataFrame([], "x double"), "x", {"m": 0.5}).collect()
    assert len(got) == 1 and got[0]["m"] is None


def test_order_statistics_of_decimals_and_longs(spark):
    df = spark.range(1, 1001).select(F.col("id").alias("n"), (F.col("id") / 100).cast("decimal(18,2)").alias("d"))
    ranks = {"first": lambda n: F.lit(0), "last": lambda n: n - 1, "mid": lambda n: F.floor(n / 2), "out": lambda n: n}
    got = dict(values(o.order_statistics(df, o.numeric_levels("n"), ranks), "rank_name", "value"))
    assert got == {"first": 1, "last": 1000, "mid": 501}
    got = dict(values(o.order_statistics(df, o.numeric_levels("d"), ranks), "rank_name", "value"))
    assert float(got["mid"]) == 5.01


def test_running_sums_match_brute_force(spark):
    xs = skewed_values(1500)
    df = spark.createDataFrame([(x, i % 3) for i, x in enumerate(xs)], "x double, w int").repartition(6)
    got = {r["value"]: (r["s"], r["s_before"]) for r in o.running_sums(df, o.numeric_levels("x"), {"s": F.col("w").cast("long")}).collect()}
    own = {}
    for i, x in enumerate(xs):
        own[x] = own.get(x, 0) + i % 3
    before = 0
    for x in sorted(own):
        assert got[x] == (own[x], before)
        before += own[x]


def test_positions_are_a_permutation_in_order(spark):
    keys = [f"id-{i * 7919 % 5000:05d}" for i in range(5000)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(9)
    got = values(o.positions(df, ["k"]).orderBy("position"), "k", "position")
    assert got == [(k, i) for i, k in enumerate(sorted(keys))]


def test_attach_is_a_subquery_not_a_join(spark):
    df = spark.range(100)
    plan = o.attach(df, df.agg(F.max("id").alias("m")))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Subquery" in plan


def test_levels_separate_all_magnitudes(spark):
    """Tiny, huge and crowded values: exact ranks, and no bucket that holds them together."""
    found = [s * m * 10.0**e for e in range(-300, 301, 5) for m in (1.0, 1.5, 9.9) for s in (1, -1)]
    found += [k * 1e-12 for k in range(1, 1001)] + [0.0] * 50 + [float("inf"), float("-inf")]
    df = spark.createDataFrame([(x,) for x in found], "x double")
    ordered = sorted(found)
    ranks = {str(i): (lambda n, i=i: F.lit(i)) for i in range(0, len(found), 97)}
    got = {r["rank_name"]: r["value"] for r in o.order_statistics(df, o.numeric_levels("x"), ranks).collect()}
    assert got == {str(i): ordered[i] for i in range(0, len(found), 97)}
    coarse, fine, exact = o.numeric_levels("x")
    buckets = df.select(coarse.alias("a"), fine.alias("b"), exact.alias("c")).filter("c <> 0").distinct()
    assert buckets.groupBy("a").agg(F.countDistinct("b").alias("n")).agg(F.max("n")).first()[0] <= 2
    assert buckets.groupBy("a", "b").count().agg(F.max("count")).first()[0] <= 2
    pairs = df.select("x", coarse.alias("a"), fine.alias("b")).orderBy("x").collect()
    assert all(p["a"] <= q["a"] and p["b"] <= q["b"] for p, q in zip(pairs, pairs[1:]))
