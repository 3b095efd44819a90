"""Hard negatives, whitening and packing against literal versions."""

import random
import re
import zlib

import numpy as np
import pytest
from odd_rows import docs, empty, rows  # noqa: F401
from pyspark.sql import functions as F

from tillsight.llm import hard_negatives as mining
from tillsight.llm import packing, whitening

VECTORS = "id long, label int, vector array<double>"


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def mined(table, anchors, positives=5, negatives=10, least=30, most=90):
    """All products, sorted."""
    table = [(i, k, [int(np.floor(256 * x)) for x in v]) for i, k, v in table if i is not None and k is not None and usable(v)]
    out, seen = [], {}
    for i, k, v in table:
        if anchors(i):
            seen[i] = min(seen.get(i, (k, v)), (k, v))
    for a, (label, v) in seen.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, k) for i, k, w in table if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            inside = [(n, i) for n, i, k in scored if k != label and least * -s <= 100 * -n <= most * -s]
            out += [(a, p, r + 1, i, -s, -n) for r, (n, i) in enumerate(inside[:negatives])]
    return sorted(out)


def labelled(n, width, seed, size=0.2):
    rng = random.Random(seed)
    out = [(i, rng.choice([0, 0, 0, 1, 2]), [rng.gauss(0, size) for _ in range(width)]) for i in range(n)]
    for i in range(0, n - 1, 5):  # near copies under other labels
        out[i + 1] = (i + 1, out[i + 1][1], [x * 0.9 + rng.gauss(0, size / 20) for x in out[i][2]])
    ties = [(n + i, i % 3, out[i % 4][2]) for i in range(24)]
    odd = [(900, 0, None), (901, 1, []), (902, 0, [None] * width), (903, 1, [float("nan")] * width), (904, 1, [float("inf")] + [0.0] * (width - 1)),
           (None, 0, out[0][2]), (905, 0, [0.5] * (width - 2)), (906, 1, [0.0] * width), (1000, 1, [-3.25] * width), (907, None, [0.1] * width), out[5],
           (100, 2, out[7][2]), (1100, 0, []), (1200, 0, [-x for x in out[0][2]])]
    return out + ties + odd


@pytest.mark.parametrize("block, group, width", [(2048, 256, 12), (50, 2, 12), (31, 1, 7)])
def test_hard_negatives(spark, monkeypatch, block, group, width):
    monkeypatch.setattr(mining, "ROWS", block)
    monkeypatch.setattr(mining, "GROUP", group)
    table = labelled(400, width, 3)
    frame = spark.createDataFrame([(*r, "x", 1) for r in table], VECTORS + ", score string, shelf int").repartition(3).select("id", "label", "vector")
    got = mining.hard_negatives(frame, frame.filter(F.col("id") % 100 == 0))
    assert sorted(tuple(r) for r in got.collect()) == mined(table, lambda i: i % 100 == 0)


def test_hard_negatives_of_large_components(spark):
    table = labelled(60, 5, 4) + [(500, 0, [9e6, -(2.0**24), 3.0, 1e6, 0.5]), (501, 0, [2.0**22, 1.0, -5e6, 2.0**20, 7.0])]
    table += [(502 + i, 1, [2.0**21 + i, 5.0, 1.0, 1.5, 2.5]) for i in range(70)]
    frame = spark.createDataFrame(table, VECTORS)
    got = mining.hard_negatives(frame, frame.filter(F.col("id") % 100 == 0))
    assert sorted(tuple(r) for r in got.collect()) == mined(table, lambda i: i % 100 == 0)


def test_hard_negatives_beyond_64_bits(spark):
    frame = spark.createDataFrame([(0, 0, [1e30]), (1, 0, [1e30])], VECTORS)
    with pytest.raises(Exception, match="64 bits"):
        mining.hard_negatives(frame, frame.filter("id = 0")).collect()


def test_hard_negatives_of_few_rows(spark):
    frame = spark.createDataFrame([(0, 0, [1.0, 2.0]), (1, 0, [1.0, 1.0]), (2, 1, [1.0, 0.0])], VECTORS)
    for part in (frame, frame.limit(0), frame.filter("id > 0"), frame.filter("label = 0"), frame.filter("id <> 1")):
        table = [tuple(r) for r in part.collect()]
        got = mining.hard_negatives(part, part.filter(F.col("id") % 100 == 0)).collect()
        assert sorted(tuple(r) for r in got) == mined(table, lambda i: i % 100 == 0)


def test_triangles_bound_every_product():
    rng = np.random.default_rng(5)
    values = np.floor(rng.normal(0, 50, (200, 10)) * rng.choice([0, 0.01, 1, 1000], (200, 1)))
    values[:20, 2:] = 0
    part = mining.Part(mining.packed(0, [(i, 0, v, None) for i, v in enumerate(values)]))
    exact = values @ values.T
    share = []
    for i, found, low, high in mining.spread(part, part, np.arange(200), slice(0, 200)):
        assert (low <= exact[i][found]).all() and (exact[i][found] <= high).all()
        share.append(((high - exact[i][found]) / (part.norms[i] * part.norms[found] + 100)).mean())
    assert np.mean(share) < 0.1


def literal_whitening(vectors, k):
    width = max(map(len, vectors))
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    shift = n * x - s
    centred = shift.astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return (shift**2).sum(axis=1), values / np.trace(centred.T @ centred / n), centred @ axes / np.sqrt(values)


@pytest.mark.parametrize("blocks, large", [((2048, 1024), False), ((64, 16), False), ((64, 16), True)])
def test_whitening(spark, monkeypatch, blocks, large):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", blocks[1])
    monkeypatch.setattr(whitening, "SLAB", 2 if large else 4096)
    rng = np.random.default_rng(6)
    mixed = rng.normal(0, 0.3, (300, 40)) @ np.diag(np.linspace(2, 0.2, 40))
    table = [(i, v.tolist()) for i, v in enumerate(mixed)]
    table += [(7, table[7][1]), (None, table[8][1]), (500, []), (501, [0.5] * 12), (502, [1e4 if large else 10.0] * 40)]
    odd = [(600, None), (601, [None] * 40), (602, [float("nan")] * 40), (603, [float("-inf")] * 40)]
    frame = spark.createDataFrame([(i, v, 0, 1) for i, v in table + odd], "id long, vector array<double>, n int, index int").repartition(5).select("id", "vector")
    got = whitening.whiten(frame).collect()
    deviations, share, want = literal_whitening([v for _, v in table], 32)
    assert len(got) == 32 * len(table) and {r["n"] for r in got} == {len(table)}
    values = {}
    for r in got:
        values.setdefault((r["vec_id"], r["deviation"], r["component"]), []).append(r["whitened"])
    rows = [(i, d) for (i, _), d in zip(table, deviations)]
    out = np.array([[values[(*row, c + 1)].pop() for c in range(32)] for row in rows])
    assert not any(values.values())
    assert np.abs(out * np.sign((out * want).sum(axis=0)) - want).max() < (1e-6 if large else 1e-8)
    for r in got:
        assert abs(r["explained"] - share[r["component"] - 1]) < 1e-12 and r["identity_error"] < 1e-6


def test_whitening_of_large_deviations_is_exact(spark):
    table = [(i, [float(v)]) for i, v in enumerate([0, 2**22, -(2**22), 5])]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(spark.createDataFrame(table, "id long, vector array<float>")).collect()}
    assert got == {i: int(d) for i, d in enumerate(literal_whitening([v for _, v in table], 1)[0])}


def test_whitening_without_spread(spark):
    schema = "id long, vector array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [])], schema)).count() == 0
    for table in ([(1, [0.5, 0.25])], [(1, [0.5, 0.25])] * 3):
        got = whitening.whiten(spark.createDataFrame(table, schema)).collect()
        assert [(r["vec_id"], r["n"], r["deviation"], r["whitened"], r["identity_error"]) for r in got] == [(1, len(table), 0, None, None)] * (2 * len(table))
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], schema)
    got = whitening.whiten(line).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in got) and max(r["identity_error"] for r in got) < 1e-9


def test_scatter_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 10)
    rows = spark.range(1000).select(F.col("id").alias("index"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    table = whitening.blocks(rows, "v", 2)
    model = whitening.matrix_of(table, 1000, 2)._java_matrix_wrapper._java_model
    plan = model.transpose().multiply(model, 16).blocks().toDebugString()
    # The blocks of all rows are multiplied in as many tasks before they are added up.
    assert re.search(r"\((\d+)\) MapPartitionsRDD\[\d+\] at flatMap", plan)[1] == "16"
    assert whitening.scatter(table, 1000, 2).tolist() == [[sum(i * i for i in range(1000)), 499500], [499500, 1000]]


def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def check_places(got):
    used = {}
    for r in got:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert {(r["sequences"], r["lower_bound"] <= r["sequences"]) for r in got} <= {(len(used), True)}
    return len(used)


def test_pieces_are_the_library_ids(spark, docs, rows):  # noqa: F811
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    want = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want.append((doc, k, start, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())))
    got = packing.pack(packing.token_pieces(docs, vocabulary())).collect()
    order = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got], key=order) == sorted(want, key=order)
    check_places(got)


def lengths(spark, sizes):
    rows = [(i, 0, 0, int(x), i) for i, x in enumerate(sizes)]
    return spark.createDataFrame(rows, packing.PIECE).repartition(4)


@pytest.mark.parametrize("kind", ["short", "halves", "thirds", "mixed", "full", "one", "none"])
def test_packing_is_whole_and_near_its_bound(spark, monkeypatch, kind):
    monkeypatch.setattr(packing, "PIECES", 500)
    rng = np.random.default_rng(8)
    sizes = {
        "short": rng.integers(1, 300, 3000), "halves": rng.integers(1900, 2200, 1200), "thirds": rng.integers(1200, 1500, 1200),
        "mixed": np.minimum(rng.lognormal(6, 1.2, 3000).astype(int) + 1, 4096), "full": np.full(700, 4096), "one": np.array([1]), "none": np.array([]),
    }[kind]
    got = packing.pack(lengths(spark, sizes)).collect()
    assert sorted(r["length"] for r in got) == sorted(sizes.tolist()) and len({r["doc_id"] for r in got}) == len(sizes)
    used = check_places(got)
    single = len(packing.best_fit(np.sort(sizes.astype(int))[::-1])[2]) if len(sizes) else 0
    bound = got[0]["lower_bound"] if got else 0
    # Dealt to partitions and exchanged, it needs hardly more than one task with all pieces would.
    assert bound <= used <= single * 1.02 + 1
    if kind in ("short", "full", "one", "none"):
        assert used == bound


def fewest(sizes, capacity):
    """The optimum by trying everything."""
    best = len(sizes)

    def place(i, left):
        nonlocal best
        if len(left) >= best:
            return
        if i == len(sizes):
            best = len(left)
            return
        for j in range(len(left)):
            if left[j] >= sizes[i]:
                left[j] -= sizes[i]
                place(i + 1, left)
                left[j] += sizes[i]
        place(i + 1, [*left, capacity - sizes[i]])

    place(0, [])
    return best


def test_no_packing_beats_the_bound():
    rng = random.Random(9)
    reached = 0
    for _ in range(300):
        capacity = rng.choice([10, 17, 24])
        sizes = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 8))), reverse=True)
        bound = packing.lower_bound(np.bincount(sizes, minlength=capacity + 1), capacity)
        optimum = fewest(sizes, capacity)
        assert bound <= optimum <= len(packing.best_fit(np.array(sizes), capacity)[2])
        reached += bound == optimum
    assert reached > 270


def test_best_fit_takes_the_fullest_sequence():
    bins, offsets, left = packing.best_fit(np.array([7, 6, 3, 3, 1]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 7, 6, 9] and left.tolist() == [0, 0]


def test_packing_of_nothing(spark, empty):  # noqa: F811
    assert packing.pack(packing.token_pieces(empty, vocabulary())).count() == 0
