"""Model bundles: one commit, checked when read."""

import os

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml import Pipeline

from tillsight.models.estimators import linear
from tillsight.models.scoring import SpendPredictor
from tillsight.sources.bundle import load_bundle, save_bundle


def predictor(spark, factor):
    rows = spark.createDataFrame([(i, float(i), factor * i + 1.0) for i in range(20)], "customer_id long, a double, label double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a"], outputCol="features"), linear()]).fit(rows)
    return SpendPredictor(model, ["a"], [], {}, f"model {factor}"), rows


def test_a_stopped_writer_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "bundle")
    p, rows = predictor(spark, 2.0)
    p.save(path)

    def broken(to):
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        save_bundle(path, {"model": lambda to: p.model.write().save(to), "second": broken}, ["a"], {})
    again = SpendPredictor.load(spark, path, ["a"])
    assert again.name == "model 2.0"
    assert [round(r["prediction"], 6) for r in again.predict(rows.orderBy("customer_id")).collect()] == [2.0 * i + 1 for i in range(20)]
    other, _ = predictor(spark, 3.0)
    other.save(path)
    assert SpendPredictor.load(spark, path).name == "model 3.0"


def test_checks_when_read(spark, tmp_path):
    path = str(tmp_path / "bundle")
    with pytest.raises(FileNotFoundError):
        SpendPredictor.load(spark, path)
    p, _ = predictor(spark, 2.0)
    p.save(path)
    with pytest.raises(ValueError, match="features"):
        SpendPredictor.load(spark, path, ["b"])
    folder, _ = load_bundle(spark, path, ["a"])
    with open(os.path.join(folder.removeprefix("file:"), "part-of-another"), "w") as out:
        out.write("x")
    with pytest.raises(ValueError, match="changed"):
        SpendPredictor.load(spark, path)
