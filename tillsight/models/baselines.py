"""Predictions that need no model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillsight.functions.columns import clip, mean
from tillsight.functions.ordering import attach
from tillsight.operators.derived import target_cap


def with_baselines(train: DataFrame, test: DataFrame, target: str = "future_spend_30d") -> DataFrame:
    """Adds the capped target and four baseline predictions to the test rows.

    zero; mean of the capped training target; spender rate x mean of spenders;
    mean of the log target, transformed back. The cap is the 99th percentile of
    the training spenders.
    """
    y = clip(F.col(target).cast("double"), high=F.col("_k.cap"))
    spends = F.col(target) > 0
    constants = attach(train, target_cap(train, target)).agg(
        F.max("_k.cap").alias("cap"),
        mean(y).alias("mean"),
        mean(spends.cast("int")).alias("rate"),
        mean(F.when(spends, y)).alias("spender_mean"),
        mean(F.log1p(y)).alias("log_mean"),
    )
    predictions = {
        "target_capped": y,
        "pred_zero": F.lit(0.0),
        "pred_mean": F.col("_k.mean"),
        "pred_conditional": F.col("_k.rate") * F.col("_k.spender_mean"),
        "pred_log_mean": F.expm1("_k.log_mean"),
    }
    return attach(test, constants).withColumns(predictions).drop("_k")


BASELINES = {
    "Zero": "pred_zero",
    "Mean": "pred_mean",
    "Conditional Mean": "pred_conditional",
    "Log Mean": "pred_log_mean",
}
