"""Metrics as plain aggregates of scored rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillsight.functions.columns import clip, col
from tillsight.functions.ordering import attach, numeric_levels, running_sums


def regression_metrics(df: DataFrame, actual: Column | str, predicted: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R2 in one pass (R2 is null for a constant target)."""
    y, p = col(actual).cast("double"), col(predicted).cast("double")
    e = y - p
    n = F.count(e).cast("double")
    r2 = 1 - F.try_divide(F.sum(e * e), n * F.var_pop(y))
    measures = [F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), r2.alias("r2")]
    return df.groupBy(*by).agg(*measures) if by else df.agg(*measures)


def evaluate_models(df: DataFrame, actual: str, predictions: Mapping[str, str]) -> DataFrame:
    """Leaderboard of several prediction columns of one frame, best MAE first."""
    names = F.array(
        *[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("_p")) for m, c in predictions.items()]
    )
    y = F.col(actual).cast("double").alias("_y")
    rows = df.select(y, F.inline(names))
    return regression_metrics(rows, "_y", "_p", ["model"]).orderBy("mae", "model")


def best_model(board: DataFrame, metric: str = "mae") -> DataFrame:
    order = F.desc(metric) if metric == "r2" else F.asc(metric)
    return board.orderBy(order, "model").limit(1)


def classification_metrics(df: DataFrame, label: Column | str, predicted: Column | str) -> DataFrame:
    """Accuracy, precision, recall, F1; a metric without support is 0."""
    y, p = col(label) > 0, col(predicted) > 0
    c = df.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"),
    )
    part = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    out = c.withColumns(
        {"accuracy": part(tp + tn, tp + fp + fn + tn), "precision": part(tp, tp + fp), "recall": part(tp, tp + fn)}
    )
    return out.withColumn("f1", part(2 * tp, 2 * tp + fp + fn))


def roc_auc(df: DataFrame, label: Column | str, score: Column | str) -> DataFrame:
    """Exact area under the ROC curve, ties counted half.

    Rows are folded to distinct scores; the number of negatives below each score
    is a running sum over score levels, not a window over all rows.
    """
    pos = (col(label) > 0).cast("long")
    sums = running_sums(df, numeric_levels(col(score).cast("double")), {"pos": pos, "neg": 1 - pos})
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
    return sums.agg(F.try_divide(wins, F.sum("pos") * F.sum("neg").cast("double")).alias("roc_auc"))


def log_loss(df: DataFrame, label: Column | str, probability: Column | str, epsilon: float = 1e-15) -> DataFrame:
    y = (col(label) > 0).cast("double")
    p = clip(col(probability).cast("double"), epsilon, 1 - epsilon)
    return df.agg((-F.avg(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("log_loss"))


def improvements(board: DataFrame, baseline: str) -> DataFrame:
    """MAE gain in percent and R2 gain over one baseline row of the board."""
    base = board.filter(F.col("model") == baseline).agg(F.max("mae").alias("mae"), F.max("r2").alias("r2"))
    gains = {
        "mae_improvement_pct": F.try_divide((F.col("_k.mae") - F.col("mae")) * 100, F.col("_k.mae")),
        "r2_gain": F.col("r2") - F.col("_k.r2"),
    }
    return attach(board, base).withColumns(gains).drop("_k")


def fit_quality(train_rmse: Column | str, test_rmse: Column | str) -> dict[str, Column]:
    """Train/test RMSE ratio; a train error far below the test error is overfitting."""
    r = F.try_divide(col(train_rmse), col(test_rmse))
    label = F.when(r < 0.8, "overfitting").when(r > 1.2, "underfitting").when(r.isNotNull(), "balanced")
    return {"rmse_ratio": r, "fit_quality": label}


def residuals(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.withColumn("residual", F.col(actual).cast("double") - F.col(predicted).cast("double"))


# Thresholds tried for the hard two-stage decision -----------------------
THRESHOLDS = [round(0.05 * i, 2) for i in range(1, 19)]
# End of fixed values ----------------------------------------------------------------


def threshold_grid(
    df: DataFrame, actual: str, probability: str, amount: str, thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """R2 and MAE of ``amount if probability >= t else 0`` for every threshold.

    All thresholds are columns of one aggregate: rows are read once and not copied.
    """
    y, p, a = (F.col(c).cast("double") for c in (actual, probability, amount))
    out = [F.count(y).cast("double").alias("n"), F.var_pop(y).alias("v")]
    for i, t in enumerate(thresholds):
        e = y - F.when(p >= t, a).otherwise(0.0)
        out += [F.sum(e * e).alias(f"q{i}"), F.avg(F.abs(e)).alias(f"m{i}")]
    one = df.agg(*out)
    r2 = lambda i: 1 - F.try_divide(F.col(f"q{i}"), F.col("n") * F.col("v"))
    rows = F.array(
        *[
            F.struct(F.lit(float(t)).alias("threshold"), r2(i).alias("r2"), F.col(f"m{i}").alias("mae"))
            for i, t in enumerate(thresholds)
        ]
    )
    return one.select(F.inline(rows))


def best_threshold(grid: DataFrame) -> DataFrame:
    return grid.orderBy(F.desc("r2"), "threshold").limit(1)


def importance_table(spark: SparkSession, names: Sequence[str], values: Sequence[float]) -> DataFrame:
    """Feature importances or coefficients, largest magnitude first.

    The input is a model's own parameter vector: one number per feature.
    """
    rows = [(n, float(v)) for n, v in zip(names, values)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc(F.abs("importance")), "feature")
