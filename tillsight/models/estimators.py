"""Named model presets on MLlib's distributed estimators, on sums of products, and on boosted trees with penalties."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillsight.models.boosting import Boost, BoostedEstimator
from tillsight.models.gram import GramRegression
from tillsight.session import checkpoint_dir

# Tree counts, depths and rates of the presets -----------------------------
FORESTS = {
    "forest_100x10": dict(numTrees=100, maxDepth=10, minInstancesPerNode=1, featureSubsetStrategy="all"),
    "forest_200x12": dict(numTrees=200, maxDepth=12, minInstancesPerNode=10, featureSubsetStrategy="sqrt"),
    "forest_200x8": dict(numTrees=200, maxDepth=8, minInstancesPerNode=10, featureSubsetStrategy="sqrt"),
}
BOOSTED = {
    "boost_100x5": dict(maxIter=100, maxDepth=5, stepSize=0.1),
    "boost_500x4": dict(maxIter=500, maxDepth=4, stepSize=0.05, subsamplingRate=0.8, minInstancesPerNode=15),
    "boost_500x4_slow": dict(maxIter=500, maxDepth=4, stepSize=0.03, subsamplingRate=0.8, minInstancesPerNode=15, featureSubsetStrategy="sqrt"),
    "boost_300x4": dict(maxIter=300, maxDepth=4, stepSize=0.05, subsamplingRate=0.8, minInstancesPerNode=10),
    "boost_300x4_active": dict(maxIter=300, maxDepth=4, stepSize=0.05, subsamplingRate=0.8, minInstancesPerNode=5),
    "boost_300x3": dict(maxIter=300, maxDepth=3, stepSize=0.05, subsamplingRate=0.8, minInstancesPerNode=10, featureSubsetStrategy="sqrt"),
}
CLASSIFIERS = {
    "classify_300x3": dict(maxIter=300, maxDepth=3, stepSize=0.05, subsamplingRate=0.8, minInstancesPerNode=20, featureSubsetStrategy="sqrt"),
    "classify_200x4": dict(maxIter=200, maxDepth=4, stepSize=0.05, subsamplingRate=0.8, minInstancesPerNode=20),
    "classify_200x3": dict(maxIter=200, maxDepth=3, stepSize=0.05, subsamplingRate=0.8, minInstancesPerNode=15),
}
# Trees with penalties on their leaves, and buckets of spend with one tree per bucket and round.
REGULARISED = {
    "boost_200x6": dict(rounds=200, depth=6, rate=0.05, row_share=0.8, column_share=0.8, min_curvature=10, l1=0.1, l2=1.0),
    "boost_500x4_columns": dict(rounds=500, depth=4, rate=0.05, row_share=0.8, column_share=0.8, min_curvature=10, l1=0.1, l2=1.0, patience=20),
    "study_300x4": dict(rounds=300, depth=4, rate=0.05, row_share=0.8, min_weight=10, patience=20),
    "study_300x4_spend": dict(rounds=300, depth=4, rate=0.05, row_share=0.8, min_weight=5),
    "study_200x3_spends": dict(rounds=200, depth=3, rate=0.05, row_share=0.8, min_weight=15, objective="logistic"),
    "buckets_200x4": dict(rounds=200, depth=4, rate=0.05, min_weight=10, objective="softmax", classes=5),
}
# Share of the training rows that decides when a preset stops.
VALIDATION = {
    "study_300x4": 0.15,
    "boost_500x4": 0.1, "boost_500x4_columns": 0.1, "boost_300x4": 0.15, "boost_300x3": 0.15, "classify_300x3": 0.15,
}
# MB of sums in a pass over the rows, for forests whose trees look at all features: so many stay in a core's caches, and
# the trees are the same. Forests that draw features draw them by pass and keep MLlib's own limit.
PASS_MB = 16
RIDGE_ALPHAS = [0.01, 0.1, 1.0, 10.0, 100.0, 1000.0]
SEED = 42
HELD_BACK = "is_validation"
# End of fixed values --------------------------------------------------------------------


def linear(features: str = "features", label: str = "label") -> GramRegression:
    """Least squares from one pass; columns that depend on earlier ones get no weight."""
    return GramRegression(0.0, features, label)


def ridge(alpha: float = 1.0, features: str = "features", label: str = "label") -> GramRegression:
    """Penalty alpha * |w|^2 on the plain sum of squared errors."""
    return GramRegression(alpha, features, label)


def forest(preset: str = "forest_200x8", features: str = "features", label: str = "label") -> RandomForestRegressor:
    model = RandomForestRegressor(featuresCol=features, labelCol=label, seed=SEED, **FORESTS[preset])
    return model.setMaxMemoryInMB(PASS_MB) if model.getFeatureSubsetStrategy() == "all" else model


def boosted(preset: str = "boost_300x4", features: str = "features", label: str = "label") -> GBTRegressor:
    """Presets with a validation share stop when the held-back rows stop improving."""
    return _stopping(GBTRegressor(featuresCol=features, labelCol=label, seed=SEED, **BOOSTED[preset]), preset)


def spend_classifier(preset: str = "classify_300x3", features: str = "features", label: str = "label") -> GBTClassifier:
    return _stopping(GBTClassifier(featuresCol=features, labelCol=label, seed=SEED, **CLASSIFIERS[preset]), preset)


def preset(name: str) -> Boost:
    return Boost(**REGULARISED[name])


def regularised(name: str = "boost_200x6", features: str = "features", label: str = "label") -> BoostedEstimator:
    """Second-order trees with penalties. Presets with patience stop on held-back rows."""
    return BoostedEstimator(preset(name), features, label, validation_share=VALIDATION.get(name))


def _stopping(estimator, preset: str):
    if preset in VALIDATION:
        estimator.setValidationIndicatorCol(HELD_BACK)
        estimator.validation_share = VALIDATION[preset]
    return estimator


def with_held_back(rows: DataFrame, estimator, key: str = "customer_id") -> DataFrame:
    """Marks the rows that an early-stopping estimator validates on, drawn by a hash of the
    key; other estimators get the rows as they are, and rows that are marked already stay."""
    if isinstance(estimator, (GBTRegressor, GBTClassifier)):
        with_checkpoints(rows.sparkSession)
    share = getattr(estimator, "validation_share", None)
    if share is None or HELD_BACK in rows.columns:
        return rows
    return rows.withColumn(HELD_BACK, held_back(share, key))


def held_back(share: float, key: str = "customer_id") -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(SEED)), F.lit(10_000)) >= int((1 - share) * 10_000)


def with_checkpoints(spark: SparkSession) -> None:
    """Boosting keeps the errors of each round; without a shared folder for checkpoints a
    lost executor would replay every round."""
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))


def bucket_classifier(kind: str = "forest", features: str = "features", label: str = "label"):
    """Five spend buckets: a forest, or boosted trees with softmax, one for each bucket and round."""
    if kind == "forest":
        params = {"numTrees": 200, "maxDepth": 4, "minInstancesPerNode": 10}
        return RandomForestClassifier(featuresCol=features, labelCol=label, seed=SEED, **params)
    return regularised("buckets_200x4", features, label)
