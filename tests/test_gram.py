"""Sums of products: correlations, regressions and folds against plain versions."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tillsight.models import gram
from tillsight.models.boosting import Boost, BoostedEstimator
from tillsight.models.variants import cross_validate, ridge_grid
from tillsight.models.estimators import linear, ridge
from tillsight.operators.explore import correlations
from tillsight.operators.splits import time_series_folds

NAMES = [f"c{i}" for i in range(51)]


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 51)) @ rng.normal(size=(51, 51)) + 1e6
    x[:, 3], x[:, 4] = 7.0, x[:, 5]
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 6] = np.nan
    rows = [[None if np.isnan(v) else float(v) for v in r] for r in x]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in NAMES)).repartition(4), x


def test_correlations_of_51_columns(wide):
    df, x = wide
    got = {(r["x"], r["y"]): r["corr"] for r in correlations(df, NAMES).collect()}
    assert len(got) == 51 * 51
    for i, a in enumerate(NAMES):
        for j, b in enumerate(NAMES):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if i == j:
                assert got[a, b] == 1.0
            elif both.sum() < 2 or 3 in (i, j):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)


def test_the_plan_does_not_grow_with_pairs(wide):
    df, _ = wide

    def nodes(n):
        return correlations(df, NAMES[:n])._jdf.queryExecution().optimizedPlan().toString().count("\n")

    assert nodes(5) == nodes(50)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_correlations_of_few_rows(wide, n):
    df, _ = wide
    got = correlations(df.select("c0", "c1").filter("c0 IS NOT NULL AND c1 IS NOT NULL").limit(n), ["c0", "c1"]).collect()
    assert len(got) == (4 if n else 0)
    assert all(r["corr"] is None or abs(abs(r["corr"]) - 1) < 1e-9 for r in got)


def timed(spark, n=300, width=6):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, width)) * np.arange(1, width + 1) + 10
    x[:, width - 1] = x[:, 0] - 2 * x[:, 1]  # depends on the others
    y = np.maximum(np.exp(x[:, 0] * 0.1 + rng.normal(size=n)) * 100 - 200, 0)
    rows = [(i, f"2000-01-{1 + i * 28 // n:02d}", *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    names = [f"f{i}" for i in range(width)]
    df = spark.createDataFrame(rows, "customer_id long, last_purchase string, " + ", ".join(f"{f} double" for f in names) + ", future_spend_30d double")
    return df.withColumn("last_purchase", F.to_timestamp_ntz("last_purchase")).repartition(3), names


def literal_fold(x, y, x2, y2, alpha):
    spenders = y[y > 0]
    cap = np.quantile(spenders, 0.99)
    t = np.log1p(np.minimum(y, cap))
    m, s = x.mean(0), x.std(0, ddof=1)
    z = (x - m) / s
    w = np.linalg.lstsq(np.vstack([z, np.sqrt(alpha) * np.eye(z.shape[1])]), np.concatenate([t - t.mean(), np.zeros(z.shape[1])]), rcond=1e-9)[0]
    return np.abs(y2 - np.maximum(np.expm1((x2 - m) / s @ w + t.mean()), 0)).mean()


def test_all_folds_and_penalties_at_once(spark):
    df, names = timed(spark)
    alphas = [0.0, 0.1, 10.0, 1000.0]
    got = {r["alpha"]: r for r in ridge_grid(df, names, alphas).collect()}
    folded = time_series_folds(df).toPandas()
    for a in alphas:
        maes = []
        for i in range(5):
            own = folded[folded.fold == i]
            x, y = (own[own.role == "train"][c].to_numpy() for c in (names, "future_spend_30d"))
            x2, y2 = (own[own.role == "test"][c].to_numpy() for c in (names, "future_spend_30d"))
            maes.append(literal_fold(x, y, x2, y2, a))
        assert got[a]["cv_mae_mean"] == pytest.approx(np.mean(maes), rel=1e-9)
        assert got[a]["cv_mae_std"] == pytest.approx(np.std(maes), rel=1e-8)


def test_folds_agree_with_fits_one_by_one(spark):
    df, names = timed(spark)
    slow = {r["model"]: r for r in cross_validate(time_series_folds(df), names, {"0.0": lambda _: linear(), "1.0": lambda _: ridge(1.0)}).collect()}
    for r in ridge_grid(df, names, [0.0, 1.0]).collect():
        assert r["cv_mae_mean"] == pytest.approx(slow[str(r["alpha"])]["cv_mae_mean"], rel=1e-9)
        assert r["cv_mae_std"] == pytest.approx(slow[str(r["alpha"])]["cv_mae_std"], rel=1e-9)


def test_two_passes_for_any_number_of_folds(spark, monkeypatch):
    df, names = timed(spark)
    calls = []
    inner = gram.pair_sums
    monkeypatch.setattr(gram, "pair_sums", lambda *a: calls.append(1) or inner(*a))
    ridge_grid(df, names, [0.1, 1.0, 10.0]).collect()
    assert len(calls) == 1


def test_moments_of_slices_add_up(spark):
    df, names = timed(spark)
    columns = [F.col(c) + 1e7 for c in names]
    parts = gram.moments(df, columns, F.col("customer_id") % 4)
    whole = sum(list(parts.values())[1:], list(parts.values())[0])
    x = df.select(names).toPandas().to_numpy() + 1e7
    assert whole.n == 300 and np.allclose(whole.mean, x.mean(0), rtol=1e-12)
    assert np.allclose(whole.products, np.cov(x.T, bias=True) * 300, rtol=1e-6, atol=1e-4)


def test_dependent_and_constant_columns_get_nothing(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(100, 2))
    rows = [(float(a), float(b), float(a + b), 4.0, float(2 * a - b + 3)) for a, b in x]
    df = spark.createDataFrame(rows, "a double, b double, both double, same double, label double")
    ready = VectorAssembler(inputCols=["a", "b", "both", "same"], outputCol="features").transform(df)
    model = linear().fit(ready)
    assert model.coefficients.toArray() == pytest.approx([2, -1, 0, 0], abs=1e-9) and model.intercept == pytest.approx(3)
    assert all(abs(r["prediction"] - r["label"]) < 1e-9 for r in model.transform(ready).collect())


def test_stages_survive_saving(spark, tmp_path):
    df, names = timed(spark)
    rows = df.withColumn("label", F.col("future_spend_30d"))
    for name, stage in {"line": linear(), "trees": BoostedEstimator(Boost(rounds=3, depth=2))}.items():
        model = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), stage]).fit(rows)
        model.write().overwrite().save(str(tmp_path / name))
        again = PipelineModel.load(str(tmp_path / name))
        a, b = ([r["prediction"] for r in m.transform(df.orderBy("customer_id")).collect()] for m in (model, again))
        assert a == b
