"""Boosted trees against a literal version that looks at every split of every node."""

import itertools
import math
import pickle

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillsight.models import boosting
from tillsight.models.boosting import BinnedMatrix, Boost, BoostedTrees, Fit, fit_all

FEATURES = ["a", "b", "c"]


def table(n=400, seed=3):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 12, n).astype(float), np.round(rng.normal(0, 2, n), 1)
    c = rng.integers(0, 2, n) * 5.0
    y = np.where(a > 5, 3.0, -1.0) * (1 + 0.3 * b) + c * (b > 0) + rng.normal(0, 0.2, n)
    kind = np.digitize(y, [-1.0, 1.0, 4.0])
    return [(i, *map(float, (a[i], b[i], c[i], y[i])), int(kind[i]), float(rng.integers(0, 3))) for i in range(n)]


@pytest.fixture(scope="module")
def rows():
    return table()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "customer_id long, a double, b double, c double, y double, kind int, w double").repartition(5)


@pytest.fixture(scope="module")
def matrix(frame):
    last = F.col("customer_id") >= 300
    columns = {"y": F.col("y"), "yes": (F.col("y") > 1).cast("int"), "kind": F.col("kind"), "w": F.col("w"), "last": last.cast("int")}
    return BinnedMatrix.build(frame, FEATURES, columns)


def literal(x, y, w, boost):
    """Margins of each round's model, and all leaf values."""
    x, y, w = np.array(x), np.array(y, dtype=float), np.array(w, dtype=float)
    cuts = [sorted(set(x[:, j]))[1:] for j in range(x.shape[1])]
    outputs = boost.classes if boost.objective == "softmax" else 1
    soft = lambda g: math.copysign(max(abs(g) - boost.l1, 0), g)
    rate = lambda g, h: soft(g) ** 2 / (h + boost.l2) / 2 if h + boost.l2 > 0 else 0
    if boost.objective == "squared":
        base = [np.average(y, weights=w)]
    elif boost.objective == "logistic":
        p = np.average(y, weights=w)
        base = [math.log(p / (1 - p))]
    else:
        base = [math.log(w[y == k].sum() / w.sum()) for k in range(outputs)]
    m = np.array([[b] * len(y) for b in base])
    leaves, seen = [], [m.copy()]
    for _ in range(boost.rounds):
        if boost.objective == "squared":
            g, h = m - y, np.ones_like(m)
        elif boost.objective == "logistic":
            p = 1 / (1 + np.exp(-m))
            g, h = p - y, p * (1 - p)
        else:
            p = np.exp(m) / np.exp(m).sum(axis=0)
            g, h = p - np.array([y == k for k in range(outputs)]), p * (1 - p)
        step = np.zeros_like(m)
        for k in range(outputs):

            def grow(rows, depth, k=k, g=g * w, h=h * w):
                total = (g[k, rows].sum(), h[k, rows].sum())
                best = (1e-12, None)
                if depth < boost.depth:
                    for j, cut in itertools.chain.from_iterable(zip(itertools.repeat(j), cuts[j]) for j in range(x.shape[1])):
                        left, right = [r for r in rows if x[r, j] < cut], [r for r in rows if x[r, j] >= cut]
                        if min(w[left].sum(), w[right].sum()) < max(boost.min_weight, 1e-6) or min(h[k, left].sum(), h[k, right].sum()) < boost.min_curvature:
                            continue
                        gain = rate(g[k, left].sum(), h[k, left].sum()) + rate(g[k, right].sum(), h[k, right].sum()) - rate(*total)
                        if gain > best[0] * (1 + 1e-10) and gain > boost.min_gain:
                            best = (gain, (left, right))
                if best[1]:
                    for side in best[1]:
                        grow(side, depth + 1, k)
                    return
                value = -boost.rate * soft(total[0]) / (total[1] + boost.l2) if total[1] + boost.l2 > 0 else 0.0
                step[k, rows] = value
                leaves.append(value)

            grow([r for r in range(len(y)) if w[r] > 0], 0)
        m = m + step
        seen.append(m.copy())
    return seen, leaves


def values(rows):
    return np.array([r[1:4] for r in rows])


@pytest.mark.parametrize("boost", [
    Boost(rounds=6, depth=3, rate=0.3),
    Boost(rounds=5, depth=3, rate=0.3, l1=4.0, l2=10.0, min_weight=15),
    Boost(rounds=4, depth=2, rate=0.5, min_gain=30.0),
    Boost(rounds=4, depth=3, rate=0.4, l2=1.0, min_curvature=3.0, objective="logistic"),
    Boost(rounds=4, depth=2, rate=0.4, l1=0.5, l2=1.0, objective="softmax", classes=4),
])
@pytest.mark.parametrize("weight", [None, "w"])
def test_trees_are_the_literal_ones(matrix, rows, boost, weight):
    label, column = {"squared": ("y", 4), "logistic": ("yes", None), "softmax": ("kind", 5)}[boost.objective]
    y = [float(r[4] > 1) if column is None else r[column] for r in rows]
    w = [1.0 if weight is None else r[6] for r in rows]
    model = fit_all(matrix, {"m": Fit(boost, label, weight)})["m"]
    seen, _ = literal(values(rows), y, w, boost)
    used = np.array(w) > 0
    assert np.abs(model.margins(values(rows)) - seen[-1])[:, used].max() < 1e-9


def test_softmax_probabilities_add_up(matrix, rows):
    model = fit_all(matrix, {"m": Fit(Boost(rounds=3, depth=2, objective="softmax", classes=4), "kind")})["m"]
    out = model.outputs(values(rows))
    assert out.shape == (400, 4) and np.abs(out.sum(axis=1) - 1).max() < 1e-12
    assert (out.argmax(axis=1) == [r[5] for r in rows]).mean() > 0.6


def test_larger_penalties_shrink_every_leaf(matrix):
    boosts = {f"{k}{v}": Boost(rounds=1, depth=2, min_weight=60, **{k: v}) for k in ("l1", "l2") for v in (0.0, 5.0, 50.0)}
    models = fit_all(matrix, {name: Fit(b, "y") for name, b in boosts.items()})
    for k in ("l1", "l2"):
        trees = [models[f"{k}{v}"].rounds[0][0] for v in (0.0, 5.0, 50.0)]
        roots = [abs(t.value[0]) for t in trees]
        assert roots[0] >= roots[1] >= roots[2]
        for small, large in zip(trees, trees[1:]):
            same = (small.feature[0] == large.feature[0]) and (small.bin[0] == large.bin[0])
            assert same
            assert all(abs(large.value[i]) < abs(small.value[i]) for i in (1, 2))


def test_fits_in_lockstep_are_those_alone(matrix, rows):
    fits = {
        "a": Fit(Boost(rounds=13, depth=2), "y"), "b": Fit(Boost(rounds=25, depth=3, row_share=0.7, column_share=0.67), "y", "w"),
        "c": Fit(Boost(rounds=4, depth=4, objective="softmax", classes=4), "kind"),
    }
    together = fit_all(matrix, fits)
    for name, f in fits.items():
        alone = fit_all(matrix, {"only": f})["only"]
        assert len(alone.rounds) == f.boost.rounds
        assert np.abs(alone.margins(values(rows)) - together[name].margins(values(rows))).max() < 1e-9


def test_masks_are_filters(matrix, frame, rows):
    some = frame.filter("w > 0")
    y = {"y": F.col("y")}
    own = BinnedMatrix.build(some, FEATURES, y, cuts=matrix.cuts)
    masked = BinnedMatrix.build(frame, FEATURES, {**y, "in": F.col("w") > 0}, cuts=matrix.cuts)
    boost = Boost(rounds=5, depth=3)
    a, b = fit_all(own, {"m": Fit(boost, "y")})["m"], fit_all(masked, {"m": Fit(boost, "y", "in")})["m"]
    assert np.abs(a.margins(values(rows)) - b.margins(values(rows))).max() < 1e-9


def test_patience_keeps_the_best_round(matrix, rows):
    boost = Boost(rounds=200, depth=4, rate=0.5, patience=5)
    model = fit_all(matrix, {"m": Fit(boost, "y", held="last")})["m"]
    first, last = rows[:300], rows[300:]
    seen, _ = literal(values(first), [r[4] for r in first], [1.0] * 300, Boost(rounds=len(model.history) - 1, depth=4, rate=0.5))
    truth = np.array([r[4] for r in last])
    assert len(model.rounds) == int(np.argmin(model.history)) and len(model.rounds) < 200
    assert len(model.history) == len(model.rounds) + 6
    assert abs(np.mean((model.margins(values(last))[0] - truth) ** 2) - min(model.history)) < 1e-9
    assert np.abs(model.margins(values(first))[0] - seen[len(model.rounds)]).max() < 1e-9


def test_samples_depend_on_the_key_alone():
    key = np.arange(100_000, dtype=np.uint64)
    boost = Boost(row_share=0.8)
    a, b = boosting.sampled(key, boost, 0), boosting.sampled(key, boost, 1)
    assert abs(a.mean() - 0.8) < 0.01 and abs((a & b).mean() - 0.64) < 0.01
    assert (boosting.sampled(key[5:9], boost, 0) == a[5:9]).all()


def test_few_values_are_all_cuts_and_many_are_quantiles(spark):
    df = spark.range(10_000).select(F.col("id").alias("customer_id"), (F.col("id") % 7).cast("double").alias("few"), (F.col("id") * 1.5).alias("many"), F.lit(2.0).alias("one"))
    few, many, one = boosting.cut_points(df, [F.col(c) for c in ("few", "many", "one")], 64)
    assert few == [1, 2, 3, 4, 5, 6] and one == []
    sizes = np.bincount(boosting.binned(np.arange(10_000)[:, None] * 1.5, [many])[:, 0])
    assert len(sizes) == 64 and sizes.max() < 2 * sizes.min()


def test_nulls_empty_tables_and_saved_models(spark, frame, tmp_path):
    odd = frame.union(spark.createDataFrame([(500, None, None, None, None, None, None), (501, float("nan"), 0.0, 0.0, 1.0, 1, 1.0)], frame.schema))
    m = BinnedMatrix.build(odd, FEATURES, {"y": F.col("y")}, bins=32)
    model = fit_all(m, {"m": Fit(Boost(rounds=12, depth=3), "y")})["m"]
    model.save(str(tmp_path / "m"))
    again = BoostedTrees.load(spark, str(tmp_path / "m"))
    scored = again.transform(odd).collect()
    x = np.array([[0.0 if v is None else v for v in r[1:4]] for r in scored])
    assert np.abs(model.outputs(x)[:, 0] - [r["prediction"] for r in scored]).max() < 1e-12
    classes = fit_all(BinnedMatrix.build(frame, FEATURES, {"k": F.col("kind")}), {"m": Fit(Boost(rounds=3, depth=2, objective="softmax", classes=4), "k")})["m"]
    for r in classes.transform(frame).collect():
        assert r["prediction"] == int(np.argmax(r["probability"])) and abs(sum(r["probability"]) - 1) < 1e-12
    with pytest.raises(ValueError):
        fit_all(BinnedMatrix.build(frame.limit(0), FEATURES, {"y": F.col("y")}), {"m": Fit(Boost(), "y")})


def test_one_job_for_each_level_of_all_fits(matrix, monkeypatch):
    jobs = []
    inner = boosting.summed
    monkeypatch.setattr(boosting, "summed", lambda *a: jobs.append(1) or inner(*a))
    fit_all(matrix, {f"m{i}": Fit(Boost(rounds=7, depth=3, min_weight=1 + i), "y") for i in range(5)})
    assert len(jobs) == 1 + 7 * 3


def test_segment_study_bins_once(spark, tables, monkeypatch):
    from tillsight.catalog.views import customer_table
    from tillsight.models import estimators, variants
    from tillsight.operators.splits import temporal_split
    from tillsight.session import cut_lineage

    for name in ("study_300x4", "study_300x4_spend", "study_200x3_spends", "buckets_200x4"):
        monkeypatch.setitem(estimators.REGULARISED, name, {**estimators.REGULARISED[name], "rounds": 3, "min_weight": 1})
    built, inner = [], BinnedMatrix.build
    monkeypatch.setattr(variants.BinnedMatrix, "build", lambda *a, **k: built.append(1) or inner(*a, **k))
    rows = cut_lineage(temporal_split(customer_table(tables)).withColumn("recency_days", F.col("recency_days") % 80))
    names = ["total_frequency", "total_monetary", "monetary_30d", "frequency_90d"]
    board = variants.segment_study(rows.filter("split = 'train'"), rows.filter("split = 'test'"), names).collect()
    assert len(built) == 1 and len({r["model"] for r in board}) == 6
    assert [r["accuracy"] is not None for r in board] == [r["model"] == "Bucket Classification" for r in board]
    assert all(r["mae"] >= 0 for r in board if r["mae"] is not None)


def test_only_splits_reach_the_driver(frame, matrix, rows, monkeypatch):
    """Sums of several partitions meet in tasks: what comes back does not grow with bins, and the trees are the same."""
    monkeypatch.setattr(boosting, "BLOCK", 100)
    parted = BinnedMatrix.build(frame, FEATURES, {"y": F.col("y"), "last": (F.col("customer_id") >= 300).cast("int")}, cuts=matrix.cuts)
    assert parted.table.rdd.getNumPartitions() > 1
    sizes, inner = [], boosting.summed

    def measured(*a):
        found = inner(*a)
        sizes.append(len(pickle.dumps(found)))
        return found

    fit = {"m": Fit(Boost(rounds=3, depth=2), "y", held="last")}
    one = fit_all(matrix, fit)["m"]
    monkeypatch.setattr(boosting, "summed", measured)
    many = fit_all(parted, fit)["m"]
    assert len(sizes) == 1 + 3 * 2 and max(sizes) < 2000
    assert np.abs(one.margins(values(rows)) - many.margins(values(rows))).max() < 1e-9
    assert np.allclose(one.history, many.history)


def test_few_tasks_send_one_small_record_each(frame, matrix, rows, monkeypatch):
    """Tasks follow cores and sums, not files of blocks; their records hold numbers, no classes with their code."""
    from pyspark import RDD

    monkeypatch.setattr(boosting, "BLOCK", 10)
    before, cores = frame.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"), frame.sparkSession.sparkContext.defaultParallelism
    frame.sparkSession.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        parted = BinnedMatrix.build(frame, FEATURES, {"y": F.col("y")}, cuts=matrix.cuts)
        assert parted.table.rdd.getNumPartitions() > cores
        assert 1 < parted.blocks().getNumPartitions() <= cores
        sizes, inner = [], RDD.collect

        def measured(rdd):
            frames = rdd._jrdd.collect()
            sizes.append([len(bytes(x)) for x in frames])
            return inner(rdd)

        fit = {"m": Fit(Boost(rounds=2, depth=2), "y")}
        one = fit_all(matrix, fit)["m"]
        monkeypatch.setattr(RDD, "collect", measured)
        many = fit_all(parted, fit)["m"]
    finally:
        frame.sparkSession.conf.set("spark.sql.files.maxPartitionBytes", before)
    # The sums of labels come first; sums this small are searched in one task.
    assert len(sizes) == 1 + 2 * 2 and all(len(s) == 1 and s[0] < 1500 for s in sizes[1:])
    assert np.abs(one.margins(values(rows)) - many.margins(values(rows))).max() < 1e-9


def test_a_stage_keeps_the_vectors_of_its_pipeline(frame):
    """Rows pass through Python with all their columns, vectors among them; an empty frame stays empty."""
    from pyspark.ml import Pipeline

    from tillsight.models.prep import vector_stages

    rows = frame.withColumn("label", F.col("kind"))
    for boost in (Boost(rounds=3, depth=2), Boost(rounds=2, depth=2, objective="softmax", classes=4)):
        model = Pipeline(stages=[*vector_stages(FEATURES), boosting.BoostedEstimator(boost)]).fit(rows)
        scored = model.transform(rows)
        assert dict(scored.dtypes)["features"] == "vector" and set(rows.columns) < set(scored.columns)
        found = scored.collect()
        outputs = model.stages[-1].trees.outputs(np.array([r["features"].toArray() for r in found]))
        if boost.objective == "squared":
            assert np.abs(outputs[:, 0] - [r["prediction"] for r in found]).max() < 1e-12
        else:
            assert [r["prediction"] for r in found] == [float(np.argmax(x)) for x in outputs]
        assert len(found) == rows.count() and model.transform(rows.limit(0)).collect() == []


def test_only_the_columns_of_a_tree_are_counted():
    """And the first feature, whose sums are those of the node; what is counted does not change."""
    rng = np.random.default_rng(2)
    block = {"key": np.arange(500, dtype=np.uint64), "bins": rng.integers(0, 9, (500, 4)).astype(np.uint8),
             "columns": {"y": rng.normal(size=500)}, "margins": [np.zeros((1, 500))]}
    tree = boosting.Tree.empty(3)
    tree.feature[0], tree.bin[0], tree.feature[2], tree.bin[2] = 1, 4, 3, 2
    ask = [(0, Fit(Boost(depth=3), "y"), [], [tree], 0, 9)]
    everything = boosting.histograms(block, ask, 2)[0]
    some = boosting.histograms(block, ask, 2, {(0, 0): np.array([False, False, True, True])})[0]
    assert not some[:, :, 1].any() and everything[:, :, 1].any()
    assert np.array_equal(some[:, :, [0, 2, 3]], everything[:, :, [0, 2, 3]])
    node = np.where(block["bins"][:, 1] <= 4, 1, np.where(block["bins"][:, 3] <= 2, 5, 6))
    assert np.array_equal(tree.leaves(block["bins"], 3), node)
    # Rows of the left leaf are finished.
    assert some[0, 2, 0].sum() == (node > 1).sum()
