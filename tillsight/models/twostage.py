"""Zero-inflated spend: P(spends) x expected amount of a spender."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillsight.functions.columns import clip
from tillsight.models.estimators import boosted, spend_classifier, with_held_back
from tillsight.models.prep import as_doubles, vector_stages
from tillsight.operators.derived import target_cap
from tillsight.sources.bundle import load_bundle, save_bundle


@dataclass
class TwoStageModel:
    """Fitted classifier and regressor. Evaluation and scoring use the same
    ``transform``, so the amount is limited to the cap in both."""

    classifier: PipelineModel
    regressor: PipelineModel
    features: list[str]
    cap: float
    info: dict

    def transform(self, df: DataFrame) -> DataFrame:
        rows = as_doubles(df, self.features)
        scored = self.classifier.transform(rows).withColumn("spend_probability", vector_to_array("probability")[1])
        scored = scored.drop("features", "numeric_raw", "rawPrediction", "probability", "prediction")
        scored = self.regressor.transform(scored)
        amount = clip(F.expm1("prediction"), 0.0, self.cap)
        out = scored.withColumn("expected_if_spend", amount).drop("features", "prediction")
        return out.withColumn("predicted_spend", F.col("spend_probability") * F.col("expected_if_spend"))

    def transform_partial(self, df: DataFrame) -> DataFrame:
        """Like ``transform``, with absent feature columns taken as 0."""
        missing = {f: F.lit(0.0) for f in self.features if f not in df.columns}
        return self.transform(df.withColumns(missing) if missing else df)

    def save(self, path: str) -> None:
        """Both stages, cap and features as one commit."""
        parts = {name: (lambda to, m=m: m.write().overwrite().save(to)) for name, m in (("classifier", self.classifier), ("regressor", self.regressor))}
        save_bundle(path, parts, self.features, {"cap": self.cap, "info": self.info})

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: Sequence[str] | None = None) -> "TwoStageModel":
        folder, manifest = load_bundle(spark, path, features)
        stages = (PipelineModel.load(f"{folder}/{name}") for name in ("classifier", "regressor"))
        return cls(*stages, manifest["features"], manifest["meta"]["cap"], manifest["meta"]["info"])


def fit_two_stage(
    train: DataFrame,
    features: Sequence[str],
    target: str = "future_spend_30d",
    classifier: str = "classify_300x3",
    regressor: str = "boost_300x3",
) -> TwoStageModel:
    """Classifier on all rows (scaled), regressor on spenders (log of capped spend).
    Presets with a validation share stop early in both stages."""
    rows = as_doubles(train, features)
    spends = F.col(target) > 0
    cap = target_cap(rows, target).first()["cap"]
    if cap is None:
        raise ValueError("two-stage training needs at least one spender")
    cap = float(cap)
    first, second = spend_classifier(classifier), boosted(regressor)
    label = with_held_back(rows.withColumn("label", spends.cast("double")), first)
    stage1 = Pipeline(stages=[*vector_stages(features, scale=True), first]).fit(label)
    amounts = rows.filter(spends).withColumn("label", F.log1p(clip(F.col(target).cast("double"), high=cap)))
    stage2 = Pipeline(stages=[*vector_stages(features, scale=False), second]).fit(with_held_back(amounts, second))
    info = {
        "model_name": "Two-Stage",
        "trained_date": datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"),
        "num_features": len(features),
    }
    return TwoStageModel(stage1, stage2, list(features), cap, info)


def hard_decision(scored: DataFrame, threshold: float = 0.5, name: str = "predicted_spend_hard") -> DataFrame:
    """Full expected amount at or above the threshold, else 0."""
    yes = F.col("spend_probability") >= threshold
    return scored.withColumn(name, F.when(yes, F.col("expected_if_spend")).otherwise(0.0))


def soft_decision(scored: DataFrame, probability: str, amount: str, name: str = "predicted_spend") -> DataFrame:
    return scored.withColumn(name, F.greatest(F.col(probability) * F.col(amount), F.lit(0.0)))
