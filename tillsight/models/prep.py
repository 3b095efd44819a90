"""Encoders and feature vectors, fitted on training rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from tillsight.functions.ordering import attach, positions


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values with their 0-based alphabetical code: ``field, value, code``.

    All columns are coded in one pass over the frame.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.inline(cells)).filter(F.col("value").isNotNull()).distinct()
    placed = positions(values, ["field", "value"])
    first = placed.groupBy("field").agg(F.min("position").alias("_first"))
    # One row per encoded column.
    return placed.join(F.broadcast(first), "field").select("field", "value", (F.col("position") - F.col("_first")).alias("code"))


def label_encode(df: DataFrame, columns: Sequence[str], codes: DataFrame | None = None, unknown: int | None = None) -> DataFrame:
    """Adds ``<column>_encoded``; values without a code become ``unknown``."""
    codes = label_codes(df, columns) if codes is None else codes
    for c in columns:
        own = codes.filter(F.col("field") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        code: Column = F.col("_code") if unknown is None else F.coalesce("_code", F.lit(unknown))
        df = df.join(own, F.col(c).cast("string") == F.col("_value"), "left").withColumn(f"{c}_encoded", code)
        df = df.drop("_value", "_code")
    return df


def scaling_constants(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: mean and population deviation of each column of the training rows."""
    x = {c: F.col(f"`{c}`").cast("double") for c in columns}
    return train.agg(
        *[F.avg(x[c]).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(x[c]).alias(f"{c}_std") for c in columns],
    )


def standard_scale(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns centred and scaled by constants of the training rows (a constant
    column is only centred)."""
    k = lambda name: F.col("_k").getField(name)
    scaled = {
        c: (F.col(f"`{c}`").cast("double") - k(f"{c}_mean"))
        / F.when(k(f"{c}_std") == 0, F.lit(1.0)).otherwise(k(f"{c}_std"))
        for c in columns
    }
    return attach(df, scaling_constants(train, columns)).withColumns(scaled).drop("_k")


def vector_stages(numeric: Sequence[str], categorical: Sequence[str] = (), scale: bool = True, output: str = "features") -> list:
    """Scaled numbers plus one-hot categories in a fixed order.

    An unseen category at scoring time is the dropped last slot of the encoder,
    so all its indicators are zero.
    """
    stages: list = []
    last = [f"{c}_onehot" for c in categorical]
    if categorical:
        index = [f"{c}_index" for c in categorical]
        stages.append(
            StringIndexer(inputCols=list(categorical), outputCols=index, stringOrderType="alphabetAsc", handleInvalid="keep")
        )
        stages.append(OneHotEncoder(inputCols=index, outputCols=last, dropLast=True, handleInvalid="error"))
    raw = "numeric_raw" if scale or categorical else output
    stages.append(VectorAssembler(inputCols=list(numeric), outputCol=raw, handleInvalid="error"))
    numbers = raw
    if scale:
        numbers = "numeric_scaled" if categorical else output
        stages.append(StandardScaler(inputCol=raw, outputCol=numbers, withMean=True, withStd=True))
    if categorical:
        stages.append(VectorAssembler(inputCols=[numbers, *last], outputCol=output))
    return stages


def vector_pipeline(numeric, categorical=(), scale=True, output="features") -> Pipeline:
    return Pipeline(stages=vector_stages(numeric, categorical, scale, output))


def as_doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Feature columns as doubles, null as 0 (the rule before fit and score)."""
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in columns})
