"""Batch scoring with tiers and error band; a single customer is a batch of one."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillsight.functions.columns import clip, round_even
from tillsight.models.estimators import with_held_back
from tillsight.models.prep import as_doubles, vector_stages
from tillsight.operators.derived import prediction_band, score_tier
from tillsight.operators.profiling import require_columns
from tillsight.sources.bundle import load_bundle, save_bundle


@dataclass
class SpendPredictor:
    model: PipelineModel
    numeric: list[str]
    categorical: list[str]
    metrics: dict[str, float]
    name: str = "model"
    log_target: bool = False
    trained_date: str = field(default_factory=lambda: datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"))

    @classmethod
    def fit(cls, train: DataFrame, estimator, numeric: Sequence[str], categorical: Sequence[str] = (),
            target: str = "future_spend_30d", name: str = "model", log_target: bool = False, scale: bool = True) -> "SpendPredictor":
        y = F.col(target).cast("double")
        rows = _texts(as_doubles(train, numeric), categorical).withColumn("label", F.log1p(y) if log_target else y)
        rows = with_held_back(rows, estimator)
        stages = vector_stages(numeric, categorical, scale)
        return cls(Pipeline(stages=[*stages, estimator]).fit(rows), list(numeric), list(categorical), {}, name, log_target)

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """The input rows plus a non-negative prediction. Works on streams too."""
        require_columns(df, self.features)
        scored = self.model.transform(_texts(as_doubles(df, self.numeric), self.categorical))
        value = F.expm1("prediction") if self.log_target else F.col("prediction")
        return scored.withColumn("_score", clip(value, low=0.0)).select(*df.columns, F.col("_score").alias(name))

    def predict_with_details(self, df: DataFrame, key: str = "customer_id") -> DataFrame:
        scored = self.predict(df, "_score").select(key, round_even("_score", 2).alias("predicted_spend_30d"))
        return describe_scores(scored, self.metrics.get("test_mae", 0.0))

    def model_info(self) -> dict:
        return {"model_name": self.name, "trained_date": self.trained_date, "num_features": len(self.features), **self.metrics}

    def save(self, path: str) -> None:
        """One commit: until all parts are written, readers get the former version."""
        meta = {
            "numeric": self.numeric, "categorical": self.categorical, "metrics": self.metrics, "name": self.name,
            "log_target": self.log_target, "trained_date": self.trained_date,
        }
        save_bundle(path, {"model": lambda to: self.model.write().overwrite().save(to)}, self.features, meta)

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: Sequence[str] | None = None) -> "SpendPredictor":
        folder, manifest = load_bundle(spark, path, features)
        return cls(model=PipelineModel.load(f"{folder}/model"), **manifest["meta"])


def describe_scores(scored: DataFrame, error, score: str = "predicted_spend_30d") -> DataFrame:
    """Tier and error band of a rounded, non-negative score."""
    return scored.withColumns({"spend_category": score_tier(score), **prediction_band(score, error)})


def _texts(df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    if not categorical:
        return df
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("Unknown")) for c in categorical})
