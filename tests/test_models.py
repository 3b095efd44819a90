import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from conftest import values
from tillsight.catalog.views import customer_table
from tillsight.models import estimators as e
from tillsight.models import evaluate as ev
from tillsight.models.prep import as_doubles, label_encode, vector_pipeline
from tillsight.models.scoring import SpendPredictor
from tillsight.models.twostage import TwoStageModel, fit_two_stage
from tillsight.operators import derived as d
from tillsight.operators.splits import temporal_split
from tillsight.plans import cleaning_job, scoring_job, training_job
from tillsight.plans.training_job import coded_on_train
from tillsight.session import cut_lineage, owned_frames
from tillsight.sources import files as io
from tillsight.streaming.sales import route_header_stream, score_stream

Y = "future_spend_30d"
FEATURES = [
    "total_frequency", "total_monetary", "recency_days", "frequency_30d", "monetary_30d",
    "frequency_60d", "monetary_60d", "frequency_90d", "monetary_90d",
]


@pytest.fixture
def quick(monkeypatch):
    """Small presets of the tests' own."""
    monkeypatch.setitem(e.CLASSIFIERS, "quick", dict(maxIter=3, maxDepth=3))
    monkeypatch.setitem(e.BOOSTED, "quick", dict(maxIter=3, maxDepth=3))


@pytest.fixture(scope="module")
def split(tables):
    df = cut_lineage(temporal_split(customer_table(tables)))
    return df.filter("split = 'train'"), df.filter("split = 'test'")


@pytest.mark.parametrize("alpha", [0.1, 10.0])
def test_ridge_is_the_closed_form(spark, alpha):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3)) * [1, 5, 20]
    y = x @ [2.0, -1.0, 0.5] + 7 + rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, label double")
    vec = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    w = e.ridge(alpha).fit(vec).coefficients.toArray()
    xc, yc = x - x.mean(0), y - y.mean()
    assert w == pytest.approx(np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc), rel=1e-10)


def test_forest_of_all_features_sums_in_small_passes_and_grows_the_same_trees(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 6)).round(2)
    y = np.where(x[:, 0] > 0, x[:, 1] * 3, x[:, 2]) + rng.normal(size=3000)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, d double, e double, f double, label double")
    rows = VectorAssembler(inputCols=list("abcdef"), outputCol="features").transform(df).coalesce(1)
    forest = e.forest("forest_100x10").setNumTrees(10)
    assert forest.getMaxMemoryInMB() < 256 and e.forest("forest_200x8").getMaxMemoryInMB() == 256
    trees = [forest.setMaxMemoryInMB(mb).fit(rows).toDebugString.split("\n", 1)[1] for mb in (forest.getMaxMemoryInMB(), 256, 1)]
    assert trees[0] == trees[1] == trees[2]


def test_two_stage_ranges_and_round_trip(spark, split, tmp_path, quick):
    train, test = split
    model = fit_two_stage(train, FEATURES, classifier="quick", regressor="quick")
    rows = model.transform(test).collect()
    assert rows and all(0 <= r["spend_probability"] <= 1 for r in rows)
    assert all(0 <= r["expected_if_spend"] <= model.cap for r in rows)
    assert all(r["predicted_spend"] == pytest.approx(r["spend_probability"] * r["expected_if_spend"]) for r in rows)
    model.save(str(tmp_path / "m"))
    again = TwoStageModel.load(spark, str(tmp_path / "m"))
    a = sorted(values(again.transform(test), "customer_id", "predicted_spend"))
    assert a == sorted((r["customer_id"], r["predicted_spend"]) for r in rows)
    partial = again.transform_partial(test.select("customer_id", "monetary_30d").limit(1)).first()
    assert partial["predicted_spend"] >= 0


def test_predictor_details_and_round_trip(spark, split, tmp_path):
    train, test = split
    p = SpendPredictor.fit(train, e.linear(), FEATURES, target=Y)
    p.metrics = {"test_mae": 10.0}
    got = p.predict_with_details(test).collect()
    for r in got:
        assert r["predicted_spend_30d"] >= 0
        assert r["prediction_range_low"] == max(r["predicted_spend_30d"] - 10, 0) and r["prediction_range_high"] == r["predicted_spend_30d"] + 10
    p.save(str(tmp_path / "p"))
    again = scoring_job.load_predictor(spark, str(tmp_path / "p"))
    assert again.model_info() == p.model_info()
    assert sorted(again.predict_with_details(test).collect()) == sorted(got)
    with pytest.raises(ValueError, match="monetary_30d"):
        p.predict(test.drop("monetary_30d"))


def test_missing_features_score_as_zero(split):
    train, test = split
    p = SpendPredictor.fit(train, e.linear(), FEATURES, target=Y)
    null = test.withColumn("monetary_30d", F.lit(None).cast("double"))
    zero = test.withColumn("monetary_30d", F.lit(0.0))
    assert sorted(values(p.predict(null), "customer_id", "prediction")) == sorted(values(p.predict(zero), "customer_id", "prediction"))


def test_unknown_category_is_all_zero(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, x double")
    new = spark.createDataFrame([("zzz", 1.0)], "c string, x double")
    vec = vector_pipeline(["x"], ["c"]).fit(train).transform(new).first()["features"]
    assert list(vec.toArray()[1:]) == [0.0, 0.0]


def test_label_codes_are_alphabetical_and_per_column(spark):
    df = spark.createDataFrame([(1, "b", "z"), (2, "a", "y"), (3, None, "z")], "id int, u string, v string")
    assert sorted(values(label_encode(df, ["u", "v"]), "id", "u_encoded", "v_encoded")) == [(1, 1, 1), (2, 0, 0), (3, None, 1)]


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 2.0)], "y double, p double")
    got = ev.regression_metrics(df, "y", "p").first()
    assert got["mae"] == pytest.approx(4 / 3) and got["rmse"] == pytest.approx(np.sqrt(10 / 3)) and got["r2"] == pytest.approx(1 - 10 / 8)
    labels = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    one = ev.classification_metrics(labels, "y", "p").first()
    assert (one["precision"], one["recall"], one["f1"], one["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_auc_counts_ties_half(spark):
    rng = np.random.default_rng(4)
    s = np.round(rng.random(400), 1)
    y = (rng.random(400) < s).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert ev.roc_auc(df, "y", "s").first()["roc_auc"] == pytest.approx(want)


def test_threshold_grid_and_best(spark):
    df = spark.createDataFrame([(10.0, 0.9, 9.0), (0.0, 0.2, 9.0), (0.0, 0.4, 9.0)], "y double, p double, a double")
    best = ev.best_threshold(ev.threshold_grid(df, "y", "p", "a")).first()
    assert best["threshold"] == 0.45


def test_cap_uses_training_spenders_only(split):
    train, _ = split
    spend = [r[0] for r in train.filter(f"{Y} > 0").select(Y).collect()]
    assert d.target_cap(train).first()["cap"] == pytest.approx(np.quantile(spend, 0.99))


def test_as_doubles(spark):
    df = spark.sql("SELECT CAST(NULL AS DECIMAL(10,2)) AS a, 3 AS b")
    assert values(as_doubles(df, ["a", "b"]), "a", "b") == [(0.0, 3.0)]


def test_streams_give_the_batch_result(spark, tables, split, tmp_path):
    raw = tables.raw_header
    src = str(tmp_path / "raw")
    raw.repartition(3).write.parquet(src)
    out = str(tmp_path / "routed")
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(src)
    route_header_stream(stream, out, "route-test").awaitTermination()
    accepted, rejects = spark.read.parquet(f"{out}/accepted").count(), spark.read.parquet(f"{out}/rejected").count()
    assert accepted + rejects == raw.count() and rejects > 0

    train, test = split
    p = SpendPredictor.fit(train, e.linear(), FEATURES, target=Y)
    p.metrics = {"test_mae": 5.0}
    feats = str(tmp_path / "features")
    test.write.parquet(feats)
    score_stream(spark.readStream.schema(test.schema).parquet(feats), p, str(tmp_path / "scores"), "score-test").awaitTermination()
    got = sorted(spark.read.parquet(str(tmp_path / "scores")).collect())
    assert got == sorted(p.predict_with_details(test).collect())


def test_cleaning_job_writes_everything(spark, tables, tmp_path):
    t = tables
    raw = {
        "stores": t.raw_stores, "products": t.raw_products, "customer_details": t.raw_customers, "promotion_details": t.raw_promotions,
        "loyalty_rules": t.raw_rules, "store_sales_header": t.raw_header, "store_sales_line_items": t.raw_lines,
    }
    result = cleaning_job.clean_all(raw, materialise=True)
    result.write(str(tmp_path))
    for name, df in raw.items():
        n = spark.read.parquet(f"{tmp_path}/cleaned/{name}").count()
        path = tmp_path / "rejected" / name
        rejected = spark.read.parquet(str(path)).count() if name.startswith("store_sales") else 0
        assert n + rejected == df.count(), name
    lines = spark.read.parquet(f"{tmp_path}/cleaned/store_sales_line_items")
    headers = spark.read.parquet(f"{tmp_path}/cleaned/store_sales_header")
    assert lines.join(headers, "transaction_id", "left_anti").count() == 0
    assert lines.filter("line_item_amount IS NULL OR quantity <= 0").count() == 0


def test_csv_reader_applies_null_tokens(spark, tmp_path):
    (tmp_path / "products.csv").write_text("product_id,product_name,product_category,unit_price,current_stock_level\nP1,N/A,Toys,abc,5\nP2,x, null ,3.5,\n")
    got = sorted(io.read_raw(spark, str(tmp_path), "products").collect())
    assert got[0][1:] == (None, "Toys", None, 5.0) and got[1][1:] == ("x", None, 3.5, None)


def test_presets_are_built_in_full(split):
    for name, values_ in e.FORESTS.items():
        f = e.forest(name)
        assert (f.getNumTrees(), f.getMaxDepth(), f.getMinInstancesPerNode()) == (values_["numTrees"], values_["maxDepth"], values_["minInstancesPerNode"])
    for make, presets in ((e.boosted, e.BOOSTED), (e.spend_classifier, e.CLASSIFIERS)):
        for name, values_ in presets.items():
            g = make(name)
            assert all(g.getOrDefault(k) == v for k, v in values_.items()), name
            assert g.isSet("validationIndicatorCol") == (name in e.VALIDATION)
    vec = vector_pipeline(FEATURES).fit(as_doubles(split[0], FEATURES)).transform(as_doubles(split[0], FEATURES)).withColumn("label", F.col(Y))
    assert e.forest("forest_100x10").fit(vec).getNumTrees == 100


def test_early_stopping_holds_rows_back(spark):
    rows = spark.range(4000).withColumnRenamed("id", "customer_id")
    share = e.with_held_back(rows, e.boosted("boost_300x3")).agg(F.avg(F.col(e.HELD_BACK).cast("int"))).first()[0]
    assert share == pytest.approx(0.15, abs=0.02)
    assert e.with_held_back(rows, e.boosted("boost_100x5")).columns == ["customer_id"]


def test_codes_come_from_training_rows(spark):
    train = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "customer_id int, tier string")
    test = spark.createDataFrame([(4, "a"), (5, "zz")], "customer_id int, tier string")
    train, test = coded_on_train(train, test, ["tier_encoded"])
    assert sorted(values(train, "customer_id", "tier_encoded")) == [(1, 1), (2, 0), (3, -1)]
    assert sorted(values(test, "customer_id", "tier_encoded")) == [(4, 0), (5, -1)]


def test_threshold_is_tuned_on_training_rows(split, quick, monkeypatch):
    monkeypatch.setitem(e.CLASSIFIERS, "classify_300x3", e.CLASSIFIERS["quick"])
    monkeypatch.setitem(e.BOOSTED, "boost_300x3", e.BOOSTED["quick"])
    got = training_job.tuned_threshold(split[0], FEATURES)
    assert 0.05 <= got <= 0.9


def test_owned_frames_leave_nothing(spark, tables, tmp_path, monkeypatch):
    import os

    from tillsight import session

    monkeypatch.setattr(session, "checkpoint_dir", lambda spark: str(tmp_path / "shared"))
    with pytest.raises(RuntimeError), owned_frames(spark):
        assert cut_lineage(tables.stores).count() == 25
        assert os.listdir(tmp_path / "shared")
        raise RuntimeError
    assert not os.listdir(tmp_path / "shared")
