"""Raw CSV files to predictions, as a user would run it."""

import pytest
from pyspark.sql import functions as F

from tillsight.operators.periods import FeatureSpec
from tillsight.models import estimators
from tillsight.plans import feature_job, scoring_job
from tillsight.plans.cleaning_job import clean_all
from tillsight.plans.training_job import best_of, compare_models
from tillsight.sources import files as io
from tillsight.sources.bindings import ORDER_CUTOFF, Tables
from tillsight.sources.schemas import RAW, TARGETS

from conftest import MEDIUM


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """The dirtied tables as CSV files with the full raw schemas."""
    folder = str(tmp_path_factory.mktemp("raw"))
    t = Tables(spark, MEDIUM)
    frames = {
        "stores": t.raw_stores, "products": t.raw_products, "customer_details": t.raw_customers, "promotion_details": t.raw_promotions,
        "loyalty_rules": t.raw_rules, "store_sales_header": t.raw_header, "store_sales_line_items": t.raw_lines,
    }
    for name, df in frames.items():
        fields = spark.createDataFrame([], RAW[name]).schema.fields
        full = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
        io.write_table(full, folder, f"{name}.csv", "csv")
    return io.read_all(spark, folder)


def test_csv_to_predictions(raw, monkeypatch):
    # Small presets: the sizes of the named ones are tested elsewhere.
    monkeypatch.setitem(estimators.FORESTS, "forest_200x12", dict(numTrees=3, maxDepth=4))
    monkeypatch.setitem(estimators.REGULARISED, "boost_200x6", dict(rounds=2, depth=3))
    clean = clean_all(raw, materialise=True).clean
    categories = sorted(r[0] for r in clean["products"].select("product_category").distinct().collect())
    features = feature_job.full_features(
        clean["store_sales_header"], clean["store_sales_line_items"], clean["products"], clean["stores"],
        clean["customer_details"], FeatureSpec(ORDER_CUTOFF), categories,
    )
    catalogue = io.feature_catalogue(features, categories)
    assert catalogue.count() == len(features.columns) - 2 - len(TARGETS)
    numeric = [f"{m}_{d}d" for d in (30, 60, 90) for m in ("monetary", "frequency")] + ["recency_days", "tenure_days"]
    models, board = compare_models(features, numeric, ["loyalty_status"])
    assert {r["model"] for r in board.collect()} == set(models)
    top = scoring_job.score_top(best_of(models, board), features, 5).collect()
    assert len(top) == 5 and all(r["spend_category"] is not None for r in top)
    scores = [r["predicted_spend_30d"] for r in top]
    assert scores == sorted(scores, reverse=True)


def test_best_model_builds_the_feature_table_once(spark, tables, monkeypatch):
    from tillsight.catalog import models as m

    def scored(sides):
        return sorted(map(tuple, m.coded_on_train(*sides, m.FEATURES)[1].select("customer_id", *m.FEATURES).collect()))

    expected, calls, features = scored(m._raw_sides(tables)), [], m._features
    monkeypatch.setattr(m, "_features", lambda t: calls.append(1) or features(t))
    monkeypatch.setattr(m, "compare_on", lambda train, test, *_, **__: (None, None))
    monkeypatch.setattr(m, "best_of", lambda *_: None)
    monkeypatch.setattr(m.scoring_job, "score_top", lambda model, rows, n: rows)
    got = m.best_model(tables).select("customer_id", *m.FEATURES)
    assert len(calls) == 1 and sorted(map(tuple, got.collect())) == expected
