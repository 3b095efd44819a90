"""Exact search against all products."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillsight.llm import topk


def literal(rows, queries, k):
    usable = lambda v: v is not None and all(x is not None and np.isfinite(x) for x in v)
    whole = {}
    table = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and usable(v)]
    for q, v in [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in queries if i is not None and usable(v)]:
        whole.setdefault(q, []).extend((-sum(a * b for a, b in zip(v, w)), i) for i, w in table if i != q)
    return sorted((q, n + 1, i, -s) for q, found in whole.items() for n, (s, i) in enumerate(sorted(found)[:k]))


def vectors(n, width, seed):
    rng = random.Random(seed)
    out = [(i, [float(np.float32(rng.gauss(0, 0.2))) for _ in range(width)]) for i in range(n)]
    same = [(n + i, out[i % 3][1]) for i in range(20)]  # ties
    odd = [(900, None), (901, []), (902, [None] * width), (903, [float("nan")] * width), (904, [float("inf")] + [0.0] * (width - 1)),
           (None, out[0][1]), (905, [0.5] * (width - 2)), (906, [0.0] * width), (907, [-3.25] * width), out[5]]
    return out + same + odd


@pytest.mark.parametrize("rows_per_block, group", [(8192, 512), (64, 7), (33, 3)])
def test_top_k(spark, monkeypatch, rows_per_block, group):
    monkeypatch.setattr(topk, "ROWS", rows_per_block)
    monkeypatch.setattr(topk, "GROUP", group)
    rows = vectors(300, 12, 1)
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "id long, vector array<float>, score int").repartition(3).select("id", "vector")
    queries = frame.filter(F.col("id") % 50 == 0)
    got = sorted(tuple(r) for r in topk.top_k(frame, queries).collect())
    # A repeated query id is one query of the contract; here no such id is asked.
    assert got == literal(rows, [r for r in rows if r[0] is not None and r[0] % 50 == 0], 5)


def test_large_and_empty_vectors(spark):
    rng = random.Random(5)
    big = [(1000 + i, [rng.choice([2.0**22, -(2.0**22), 4e6, 2.0**21, 0.5]) * rng.random() for _ in range(4)]) for i in range(60)]
    rows = [*vectors(80, 4, 6), *big, (2000, [2.0**21, 1.0, -3.0, 0.25]), (2050, []), (2100, [9_000_000.0, 0.0, 0.0, 0.0]), (2150, [1.0, 2.0]), (2200, [2.0**23, 0.0])]
    frame = spark.createDataFrame(rows, "id long, vector array<double>").repartition(3)
    got = sorted(tuple(r) for r in topk.top_k(frame, frame.filter(F.col("id") % 50 == 0).filter("id <> 2200")).collect())
    assert got == literal(rows, [r for r in rows if r[0] is not None and r[0] % 50 == 0 and r[0] != 2200], 5)


def test_scores_beyond_64_bits(spark):
    frame = spark.createDataFrame([(0, [1e30]), (50, [1e30])], "id long, vector array<double>")
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(frame, frame).collect()


def test_fewer_candidates_than_k(spark):
    rows = [(0, [1.0, 2.0]), (50, [0.5, -1.0])]
    frame = spark.createDataFrame(rows, "id long, vector array<double>")
    assert sorted(tuple(r) for r in topk.top_k(frame, frame).collect()) == literal(rows, rows, 5)


def test_nothing(spark):
    frame = spark.createDataFrame([], "id long, vector array<float>")
    assert topk.top_k(frame, frame).count() == 0


def test_adders_give_the_sum():
    rng = np.random.default_rng(2)
    values = rng.integers(-200, 200, (130, 9)).astype(np.int32)
    weights = rng.integers(-63, 64, (5, 9))
    slices = topk.Slices(values)
    sums = topk.added(slices, weights)
    high = (values.astype(np.int64) - values.min()) >> slices.shift
    top = (1 << topk.ROW_BITS) - 1
    want = np.where(weights[:, None, :] < 0, -weights[:, None, :] * (top - high[None]), weights[:, None, :] * high[None]).sum(axis=2)
    got = sum(np.unpackbits(s.view("u1"), axis=1, bitorder="little")[:, :130].astype(np.int64) << i for i, s in enumerate(sums))
    assert (got == want).all()
