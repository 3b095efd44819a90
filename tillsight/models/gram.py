"""Least squares and correlations from one pass over the data.

A task adds up the products of its rows' columns as matrices and hands on one number set per
pair of columns, so the shuffle and the plan do not grow with rows or with the square of the
columns. All penalties, and all folds made of slices, are then solved from the sums.

Columns are shifted by one of their first values before they are multiplied, which keeps digits
that a large mean would cost; results do not depend on the shift. Nulls are left out pair by pair.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, functions as F

# A column whose rest, after the columns before it, is less than this share of its own squares depends on them.
DEPENDENT = 1e-9
CHUNK = 8192  # rows that are multiplied at once
HEAD = 100  # rows among which the shift is looked for
SUMS = "slice long, i int, j int, n double, si double, sii double, sij double"


def pair_sums(df: DataFrame, columns: Sequence[Column], by: Column | None = None) -> DataFrame:
    """For each slice and ordered pair of columns, over the rows that have both: count, sum of i,
    sum of squares of i, sum of products; shifted by ``shift_i`` and ``shift_j``."""
    values = F.array(*[c.cast("double") for c in columns]).alias("x")
    rows = df.select((F.lit(0) if by is None else by).cast("long").alias("slice"), values)
    some = [[x for x in column if x is not None and np.isfinite(x)] for column in zip(*(r["x"] for r in rows.select("x").head(HEAD)))]
    shift = [float(x[0]) if x else 0.0 for x in some] or [0.0] * len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1).astype(float) - shift
                slices = part.column(0).to_numpy()
                for s in np.unique(slices):
                    own = x[slices == s]
                    there = np.isfinite(own).astype(float)
                    own = np.where(there > 0, own, 0.0)
                    found = np.stack([there.T @ there, own.T @ there, (own**2).T @ there, own.T @ own])
                    sums[int(s)] = sums.get(int(s), 0) + found
        for s, found in sums.items():
            i, j = np.indices(found.shape[1:]).reshape(2, -1)
            cells = [pa.array(np.full(len(i), s)), pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(x.ravel()) for x in found)]
            yield pa.RecordBatch.from_arrays(cells, ["slice", "i", "j", "n", "si", "sii", "sij"])

    total = rows.mapInArrow(run, SUMS).groupBy("slice", "i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "si", "sii", "sij")])
    at = lambda c: F.get(F.lit(shift), F.col(c))
    return total.withColumns({"shift_i": at("i"), "shift_j": at("j")})


def correlation_cells(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """(x, y, corr) of all ordered pairs, null where a side is constant or there are no common rows."""
    names = list(columns)
    sums = pair_sums(df, list(columns.values())).drop("shift_i", "shift_j")
    other = sums.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("si").alias("sj"), F.col("sii").alias("sjj"))
    n, si, sj = F.col("n"), F.col("si"), F.col("sj")
    spread = lambda squares, s: F.greatest(F.col(squares) - s * s / n, F.lit(0.0))
    vi, vj = spread("sii", si), spread("sjj", sj)
    # What rounding leaves of a constant column is no spread.
    clear = (vi > 1e-14 * F.col("sii")) & (vj > 1e-14 * F.col("sjj"))
    found = F.when(clear, (F.col("sij") - si * sj / n) / F.sqrt(vi * vj))
    corr = F.when(F.col("i") == F.col("j"), F.lit(1.0)).when(n > 1, F.when(F.abs(found) > 1, F.signum(found)).otherwise(found))
    name = lambda c: F.get(F.lit(names), F.col(c))
    return sums.join(other, ["i", "j"]).select(name("i").alias("x"), name("j").alias("y"), corr.alias("corr"))


@dataclass(frozen=True)
class Moments:
    """Count, means and centred products of complete rows; adds up."""

    n: float
    mean: np.ndarray
    products: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        gap = other.mean - self.mean
        products = self.products + other.products + np.outer(gap, gap) * (self.n * other.n / n)
        return Moments(n, self.mean + gap * (other.n / n), products)


def moments(df: DataFrame, columns: Sequence[Column], by: Column | None = None) -> dict[int, Moments]:
    """Moments of each slice, from one pass; what reaches the driver is one row per pair of columns and slice."""
    width, out = len(columns), {}
    cells: dict[int, list] = {}
    for r in pair_sums(df, columns, by).collect():
        cells.setdefault(r["slice"], []).append(r)
    for s, rows in cells.items():
        sums, squares, shift, n = np.zeros(width), np.zeros((width, width)), np.zeros(width), 0.0
        for r in rows:
            squares[r["i"], r["j"]] = r["sij"]
            if r["i"] == r["j"]:
                sums[r["i"]], shift[r["i"]], n = r["si"], r["shift_i"], r["n"]
        out[s] = Moments(n, shift + sums / n, squares - np.outer(sums, sums) / n)
    return out


def solved(products: np.ndarray, label: np.ndarray, alpha: float = 0.0) -> np.ndarray:
    """Coefficients by elimination, one column after the other. A column that depends on those before it gets 0."""
    width = len(label)
    m = np.column_stack([products + alpha * np.eye(width), label])
    own = m.diagonal().copy()
    for k in range(width):
        if not m[k, k] > DEPENDENT * own[k]:
            m[k], m[:, k] = 0.0, 0.0
            continue
        m[k] /= m[k, k]
        rest = np.arange(width) != k
        m[rest] -= np.outer(m[rest, k], m[k])
    return m[:, -1]


@dataclass(frozen=True)
class Line:
    """A linear model on raw columns, fitted on scaled ones: ``scaled`` are its coefficients there."""

    coefficients: np.ndarray
    intercept: float
    scaled: np.ndarray


def fit_line(of: Moments, features: Sequence[int], label: int, alpha: float = 0.0, scale: bool = True) -> Line:
    """Penalty alpha * |w|^2 on the squared errors, with columns scaled by their sample deviation."""
    f = np.asarray(features)
    deviation = np.sqrt(np.maximum(of.products[f, f], 0) / max(of.n - 1, 1)) if scale else np.ones(len(f))
    # What rounding leaves of a constant column is no deviation.
    deviation = np.where(deviation > 1e-12 * np.abs(of.mean[f]), deviation, 0.0)
    inverse = np.divide(1.0, deviation, out=np.zeros(len(f)), where=deviation > 0)
    scaled = solved(of.products[np.ix_(f, f)] * np.outer(inverse, inverse), of.products[f, label] * inverse, alpha)
    raw = scaled * inverse
    return Line(raw, float(of.mean[label] - raw @ of.mean[f]), scaled)


def dot(values: Column, weights: Column) -> Column:
    return F.aggregate(F.zip_with(values, weights, lambda x, w: x * w), F.lit(0.0), lambda total, x: total + x)


def grid_errors(sliced: DataFrame, features: Sequence[str], labels: Sequence[Column], actual: str, alphas: Sequence[float], log: bool = True) -> DataFrame:
    """(fold, alpha, mae): fold i learns from the slices up to i with its own label and predicts slice i + 1.

    Two passes whatever the number of folds and penalties: one for the sums, one for the errors.
    """
    columns = [F.col(f"`{f}`") for f in features]
    by_slice = moments(sliced, [*columns, *labels], F.col("slice"))
    width = len(features)
    lines, seen = [], None
    for i, _ in enumerate(labels):
        if i in by_slice:
            seen = by_slice[i] if seen is None else seen + by_slice[i]
        lines.append([fit_line(seen, range(width), width + i, a) if seen else None for a in alphas])
    # Folds without training rows predict nothing.
    weights = F.lit([[x.coefficients.tolist() if x else [0.0] * width for x in fold] for fold in lines])
    starts = F.lit([[float(x.intercept) if x else 0.0 for x in fold] for fold in lines])
    x, fold = F.array(*[c.cast("double") for c in columns]), F.col("slice") - 1
    value = F.zip_with(F.get(weights, fold), F.get(starts, fold), lambda w, b: dot(x, w) + b)
    value = F.transform(value, lambda v: F.greatest(F.expm1(v) if log else v, F.lit(0.0)))
    tested = sliced.filter(F.col("slice") > 0).select(fold.alias("fold"), F.col(actual).cast("double").alias("y"), F.posexplode(value).alias("at", "p"))
    return tested.groupBy("fold", F.get(F.lit([float(a) for a in alphas]), F.col("at")).alias("alpha")).agg(F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"))


class GramRegression(Estimator):
    """Linear or ridge regression as a stage of a pipeline, on vectors that are scaled already."""

    def __init__(self, alpha: float = 0.0, features: str = "features", label: str = "label"):
        super().__init__()
        self.alpha, self.features, self.label = float(alpha), features, label

    def _fit(self, dataset: DataFrame) -> "LineModel":
        width = len(dataset.select(self.features).first()[0])
        rows = dataset.select(vector_to_array(self.features).alias("x"), F.col(self.label).cast("double").alias("y")).filter("y IS NOT NULL")
        found = moments(rows, [*[F.get("x", F.lit(i)) for i in range(width)], F.col("y")])[0]
        line = fit_line(found, range(width), width, self.alpha, scale=False)
        return LineModel(line.coefficients.tolist(), line.intercept, self.features)


class LineModel(Model, MLWritable, MLReadable):
    def __init__(self, coefficients: Sequence[float] = (), intercept: float = 0.0, features: str = "features"):
        super().__init__()
        self.coefficients, self.intercept, self.features = DenseVector(coefficients), float(intercept), features

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value = dot(vector_to_array(self.features), F.lit(self.coefficients.toArray().tolist())) + self.intercept
        return dataset.withColumn("prediction", value)

    def write(self) -> MLWriter:
        return LineWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return LineReader()


class LineWriter(MLWriter):
    def __init__(self, model: LineModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        more = {"coefficients": m.coefficients.toArray().tolist(), "intercept": m.intercept, "features": m.features}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata=more)


class LineReader(MLReader):
    def load(self, path: str) -> LineModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        return LineModel(meta["coefficients"], meta["intercept"], meta["features"])


# Its functions travel to the executors by value, so a cluster needs no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
