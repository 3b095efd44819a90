"""Histograms, box plots and 2-D densities as small frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillsight.functions.columns import col
from tillsight.functions.ordering import attach
from tillsight.operators.profiling import iqr_bounds


def bin_number(x: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width bin; the last bin is closed. A constant column gets a
    width of one around its value, so it falls in the middle bin."""
    flat = high == low
    start = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, F.lit(1.0)).otherwise(high - low) / bins
    return F.least(F.floor((x - start) / width), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, value: Column | str, bins: int = 50) -> DataFrame:
    """Non-empty bins: number, lower edge, upper edge, rows."""
    rows = df.select(col(value).cast("double").alias("x")).filter(F.col("x").isNotNull())
    edges = rows.agg(F.min("x").alias("low"), F.max("x").alias("high"))
    low, high = F.col("_k.low"), F.col("_k.high")
    placed = attach(rows, edges).select(bin_number(F.col("x"), low, high, bins).alias("bin"))
    counts = attach(placed.groupBy("bin").agg(F.count(F.lit(1)).alias("rows")), edges)
    flat = high == low
    start = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, F.lit(1.0)).otherwise(high - low) / bins
    return counts.select(
        "bin", (start + F.col("bin") * width).alias("bin_low"), (start + (F.col("bin") + 1) * width).alias("bin_high"), "rows"
    )


def count_histogram(df: DataFrame, value: str) -> DataFrame:
    """Rows per integer value (used for counts such as sales per customer)."""
    return df.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("long").alias("value")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def box_summary(df: DataFrame, value: str, multiplier: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the last value inside the fences, number of fliers."""
    x = F.col(value).cast("double")
    inside = (x >= F.col("_k.low")) & (x <= F.col("_k.high"))
    bounds = iqr_bounds(df, value, multiplier)
    out = attach(df, bounds).agg(
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("fliers"),
    )
    return attach(out, bounds).select("_k.q1", "_k.q3", "whisker_low", "whisker_high", "fliers")


def density(df: DataFrame, x: Column | str, y: Column | str, bins: int = 20) -> DataFrame:
    """Rows per cell of an equal-width grid: the table behind a scatter plot."""
    rows = df.select(col(x).cast("double").alias("x"), col(y).cast("double").alias("y")).dropna()
    edges = rows.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    cells = attach(rows, edges).select(
        bin_number(F.col("x"), F.col("_k.x0"), F.col("_k.x1"), bins).alias("x_bin"),
        bin_number(F.col("y"), F.col("_k.y0"), F.col("_k.y1"), bins).alias("y_bin"),
    )
    return cells.groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("rows"))
