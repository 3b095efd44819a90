"""Feature table to evaluated models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tillsight.models import estimators as e
from tillsight.models.baselines import BASELINES, with_baselines
from tillsight.models.evaluate import best_threshold, evaluate_models, fit_quality, regression_metrics, threshold_grid
from tillsight.models.prep import label_codes, label_encode
from tillsight.models.scoring import SpendPredictor
from tillsight.models.twostage import fit_two_stage, hard_decision
from tillsight.models.variants import fit_and_score, ridge_grid
from tillsight.operators.splits import temporal_split, validation_tail
from tillsight.plans.feature_job import coded_columns
from tillsight.session import cut_lineage

TARGET = "future_spend_30d"


def split_features(features: DataFrame, ts: str = "last_purchase", share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Train and test rows. The split table is written once: a fit reads it often."""
    split = cut_lineage(temporal_split(features, ts, share=share))
    return split.filter("split = 'train'").drop("split"), split.filter("split = 'test'").drop("split")


def coded_on_train(train: DataFrame, test: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with codes that the training rows alone define for the ``_encoded``
    features; categories that only test rows have, and nulls, get the code -1."""
    columns = coded_columns(names)
    if not columns:
        return train, test
    codes = cut_lineage(label_codes(train, columns))
    return tuple(cut_lineage(label_encode(side, columns, codes, unknown=-1)) for side in (train, test))


def train_two_stage(features: DataFrame, names: Sequence[str]):
    """Baselines, single-stage boosting, and two-stage predictions: soft, hard at 0.5, and
    hard at the threshold with the best R2 on the latest training rows. Returns model and board."""
    train, test = coded_on_train(*split_features(features), names)
    model = fit_two_stage(train, names)
    scored = with_baselines(train, test)
    scored = hard_decision(model.transform(scored))
    scored = hard_decision(scored, tuned_threshold(train, names), "predicted_spend_tuned")
    single = fit_and_score(train, test, names, e.boosted("boost_300x4"), TARGET)
    scored = scored.join(single.select("customer_id", F.col("prediction").alias("predicted_single")), "customer_id")
    predictions = {
        **BASELINES, "Single-Stage": "predicted_single", "Two-Stage Soft": "predicted_spend",
        "Two-Stage Hard": "predicted_spend_hard", "Two-Stage Tuned": "predicted_spend_tuned",
    }
    return model, evaluate_models(scored, "target_capped", predictions)


def tuned_threshold(train: DataFrame, names: Sequence[str], share: float = 0.15) -> float:
    """The decision threshold that a model of the earlier training rows needs on the later
    ones; never tuned on test rows."""
    tail = cut_lineage(validation_tail(train, share=share).withColumnRenamed("is_validation", "_late"))
    scored = fit_two_stage(tail.filter("NOT _late").drop("_late"), names).transform(tail.filter("_late").drop("_late"))
    best = best_threshold(threshold_grid(scored, TARGET, "spend_probability", "expected_if_spend")).first()
    return float(best["threshold"]) if best else 0.5


def compare_models(
    features: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), ts: str = "first_purchase_date",
) -> tuple[dict[str, SpendPredictor], DataFrame]:
    """Linear, ridge with a penalty tuned on time folds, forest and boosted trees on one
    split: fitted models and a board with train and test metrics, best test MAE first."""
    return compare_on(*split_features(features, ts), numeric, categorical, ts)


def compare_on(
    train: DataFrame, test: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), ts: str = "first_purchase_date",
) -> tuple[dict[str, SpendPredictor], DataFrame]:
    """The same on sides that are split already; they may be read again, as they are written."""
    train, test = coded_on_train(train, test, numeric)
    choices = {
        "Linear Regression": e.linear(),
        "Ridge Regression": e.ridge(best_alpha(train, numeric, ts)),
        "Random Forest": e.forest("forest_200x12"),
        "Gradient Boosting": e.regularised("boost_200x6"),
    }
    models, board = {}, None
    for name, estimator in choices.items():
        p = SpendPredictor.fit(train, estimator, numeric, categorical, TARGET, name)
        part = lambda df, side, p=p: regression_metrics(p.predict(df), TARGET, "prediction").select(
            *[F.col(m).alias(f"{side}_{m}") for m in ("mae", "rmse", "r2")]
        )
        metrics = {**part(train, "train").first().asDict(), **part(test, "test").first().asDict()}
        p.metrics = {k: float(v) if v is not None else 0.0 for k, v in metrics.items()}
        models[name] = p
        row = train.sparkSession.createDataFrame([(name, *p.metrics.values())], "model string, " + ", ".join(f"{k} double" for k in p.metrics))
        board = row if board is None else board.unionByName(row)
    board = board.withColumns(fit_quality("train_rmse", "test_rmse")).orderBy("test_mae", "model")
    return models, board


def best_alpha(train: DataFrame, names: Sequence[str], ts: str) -> float:
    """The ridge penalty with the smallest mean error on time folds of the training rows."""
    return float(ridge_grid(train, names, e.RIDGE_ALPHAS, ts=ts).first()["alpha"])


def best_of(models: dict[str, SpendPredictor], board: DataFrame) -> SpendPredictor:
    """The model that the board ranks first is the one that is kept."""
    return models[board.first()["model"]]
