"""Whitened embeddings by distributed block matrices.

Method: each entry c becomes the integer floor(64 * c) + 1000000. Counts and sums per dimension
are exact; rows are centred as (n * x - S) / n, from exact integers with one rounding, numbered
and laid out as a BlockMatrix of MLlib, blocks of rows spread over the cluster. Transpose times matrix
gives the scatter, with the rows' blocks dealt to many partial products; the square matrix of
the dimensions is all that reaches the driver, where its eigenvectors are found. The blocks
times the whitening matrix (eigenvectors over the roots of the eigenvalues) give the whitened
rows, and the scatter of these, read back as written, is held against the identity.

Rows whose vector is null or holds null or non-finite entries are dropped. Equal rows, and rows that
repeat an id or have none, count each. Where lengths differ, missing entries are 0; the dimensions
are those of the longest vector. Components whose eigenvalue is no more than rounding have
no whitened values (null): with one row or equal rows these are all. No rows, or vectors
without entries, give no rows. An entry beyond 2**56 or a deviation beyond 64 bits is an error.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructField, StructType

from tillsight.session import cut_lineage

SCALE, OFFSET = 64, 1_000_000
LARGEST = 2.0**56  # of an entry, so that 64 times it is a long
BLOCK_ROWS, BLOCK_COLUMNS = 2048, 1024
BLOCKS_PER_TASK = 64  # held in memory at once
SLAB = 4096  # blocks of rows that are projected as one matrix
COMPONENTS = 32

# The place of a block, and a dense matrix as MLlib stores it.
PLACE = "struct<_1: bigint, _2: bigint>"
DENSE = "struct<type: tinyint, numRows: int, numCols: int, colPtrs: array<int>, rowIndices: array<int>, values: array<double>, isTransposed: boolean>"


def whole(vector: Column) -> Column:
    """The integers of a vector; null if it takes no part."""
    fits = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    too_large = F.raise_error(F.lit("an entry is too large to become a long")).cast("long")
    entry = lambda c: F.when(F.abs(c) < LARGEST, F.floor(F.lit(SCALE) * c) + OFFSET).otherwise(too_large)
    return F.when(fits, F.transform(F.transform(vector, lambda c: c.cast("double")), entry))


def numbered(rows: DataFrame) -> DataFrame:
    """The rows with ``index``, counted from 0 without gaps."""
    marked = cut_lineage(rows.withColumn("mark", F.monotonically_increasing_id()))
    task, place = F.shiftright("mark", 33), F.col("mark").bitwiseAND((1 << 33) - 1)
    sizes = marked.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    # One short row per task.
    starts = sizes.select("task", F.coalesce(before, F.lit(0)).alias("start"))
    marked = marked.withColumns({"task": task, "place": place}).join(F.broadcast(starts), "task")
    return marked.withColumn("index", F.col("start") + F.col("place")).drop("task", "place", "start", "mark")


@dataclass(frozen=True)
class Totals:
    rows: int
    sums: list[int]  # per dimension
    span: int  # the largest difference between two integers of a dimension


def totals(rows: DataFrame) -> Totals:
    """Exact figures of the column x; one row per dimension reaches the driver."""
    entries = rows.select(F.posexplode("x").alias("at", "entry"))
    per = entries.groupBy("at").agg(F.count("*").alias("n"), F.sum("entry").alias("sum"), F.min("entry").alias("low"), F.max("entry").alias("high"))
    found = per.orderBy("at").collect()
    rows_ = rows.count()
    # Where vectors are shorter, the entries left out are zeros.
    sums = [r["sum"] + (rows_ - r["n"]) * OFFSET for r in found]
    wide = [max(r["high"], OFFSET if r["n"] < rows_ else r["high"]) - min(r["low"], OFFSET if r["n"] < rows_ else r["low"]) for r in found]
    return Totals(rows_, sums, max(wide, default=0))


def blocks(rows: DataFrame, values: str, width: int) -> DataFrame:
    """The rows (index, array) as a written table of blocks (place, matrix) that MLlib reads."""
    height, span = BLOCK_ROWS, min(width, BLOCK_COLUMNS)

    def block(table: pa.Table) -> pa.Table:
        order = np.argsort(table["index"].to_numpy())
        whole = table[values].combine_chunks().flatten().to_numpy().reshape(-1, width)[order]
        parts = [whole[:, start : start + span] for start in range(0, width, span)]
        number = len(parts)
        key = [pa.array([table["block"][0].as_py()] * number, pa.int64()), pa.array(range(number), pa.int64())]
        none = pa.array([None] * number, pa.list_(pa.int32()))
        matrix = [
            pa.array([1] * number, pa.int8()), pa.array([len(x) for x in parts], pa.int32()), pa.array([x.shape[1] for x in parts], pa.int32()),
            none, none, pa.array([np.ascontiguousarray(x).ravel() for x in parts], pa.list_(pa.float64())), pa.array([True] * number),
        ]
        fields = MatrixUDT.sqlType().names
        return pa.Table.from_arrays([pa.StructArray.from_arrays(key, ["_1", "_2"]), pa.StructArray.from_arrays(matrix, fields)], ["_1", "_2"])

    made = rows.select(F.floor(F.col("index") / height).alias("block"), "index", values).groupBy("block")
    made = made.applyInArrow(block, f"_1 {PLACE}, _2 {DENSE}")
    return cut_lineage(made, StructType([made.schema["_1"], StructField("_2", MatrixUDT())]))


def matrix_of(table: DataFrame, n: int, width: int) -> BlockMatrix:
    height, span = BLOCK_ROWS, min(width, BLOCK_COLUMNS)
    return BlockMatrix(callMLlibFunc("createBlockMatrix", table, height, span, n, width), height, span, n, width)


def tasks_for(table: DataFrame, tall: int) -> int:
    """Tasks for so many blocks of rows, each of which a task holds in memory."""
    return max(min(tall, table.sparkSession.sparkContext.defaultParallelism), -(-tall // BLOCKS_PER_TASK))


def scatter(table: DataFrame, n: int, width: int) -> np.ndarray:
    """Transpose times matrix. The rows' blocks are dealt to many partial products, where
    the default would bring all of them into one task."""
    matrix = matrix_of(table, n, width)
    model = matrix._java_matrix_wrapper._java_model  # the wrapper has no argument for the splits
    product = model.transpose().multiply(model, tasks_for(table, -(-n // BLOCK_ROWS)))
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def projected(table: DataFrame, n: int, weights: np.ndarray) -> DataFrame:
    """(index, w) of each row times the weights.

    MLlib lays a product out on a grid of as many tasks as the square root of the matrix's
    partitions, so there are the square of the wanted tasks. Slabs of rows keep that square small.
    """
    width, count = weights.shape
    right = table.sparkSession.createDataFrame([(i, r.tolist()) for i, r in enumerate(weights)], "index long, r array<double>")
    right = array_to_vector_rows(right, "r")
    parts = []
    for first in range(0, -(-n // BLOCK_ROWS), SLAB):
        rows = min(n - first * BLOCK_ROWS, SLAB * BLOCK_ROWS)
        tall = -(-rows // BLOCK_ROWS)
        slab = table.filter(F.col("_1._1").between(first, first + tall - 1))
        slab = slab.select(F.struct((F.col("_1._1") - first).alias("_1"), F.col("_1._2").alias("_2")).alias("_1"), "_2")
        left = matrix_of(slab.repartition(tasks_for(table, tall) ** 2), rows, width)
        found = left.multiply(IndexedRowMatrix(right, width, count).toBlockMatrix(left.colsPerBlock, count))
        parts.append(rows_of(found).withColumn("index", F.col("index") + first * BLOCK_ROWS))
    return reduce(DataFrame.union, parts)


def array_to_vector_rows(rows: DataFrame, values: str) -> DataFrame:
    """(index, vector) for MLlib's row matrix."""
    return MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(values).alias("vector")), "vector")


def rows_of(matrix: BlockMatrix) -> DataFrame:
    """(index, w: array) of each row, without passing through Python."""
    rows = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("w"))


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """For each row (id, vector) that takes part and each component: vec_id, component, n,
    deviation, whitened, explained, identity_error."""
    spark = rows.sparkSession
    key, vector = (F.col(f"`{c}`") for c in rows.columns)
    kept = numbered(rows.select(key.cast("long").alias("vec_id"), whole(vector).alias("x")).filter("x IS NOT NULL"))
    known = totals(kept)
    n, width = known.rows, len(known.sums)
    if not n or not width:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    x = F.concat("x", F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(width) - F.size("x")))
    sums = F.array(*[F.lit(s).cast("long") for s in known.sums])
    # Longs where no sum of squares can leave them, decimals beyond: exact both ways.
    number = "long" if width * (n * known.span) ** 2 < 1 << 62 else "decimal(38,0)"
    shifts = F.zip_with(x, sums, lambda a, s: F.lit(n).cast("long") * a - s)
    square = lambda total, y: (total + y.cast(number) * y.cast(number)).cast(number)
    centred = kept.withColumn("shift", shifts).select(
        "index", "vec_id",
        F.aggregate("shift", F.lit(0).cast(number), square).cast("long").alias("deviation"),
        F.transform("shift", lambda y: y / F.lit(float(n))).alias("centred"),
    )
    centred = cut_lineage(centred)
    table = blocks(centred, "centred", width)
    values, vectors = np.linalg.eigh(scatter(table, n, width) / n)
    trace, count = float(values.sum()), min(components, width)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    clear = values > width * np.finfo(float).eps * max(values[0], 0)
    weights = np.where(clear, vectors / np.sqrt(np.where(clear, values, 1)), 0)
    whitened = cut_lineage(projected(table, n, weights))
    error = identity_error(whitened, clear, n)
    share = [float(v) / trace if trace > 0 else None for v in values]
    out = whitened.join(centred.select("index", "vec_id", "deviation"), "index")
    constants = [F.array(*[F.lit(x) for x in xs]) for xs in (share, clear.tolist())]
    out = out.select("vec_id", "deviation", F.posexplode("w").alias("at", "value"))
    return out.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.when(F.get(constants[1], F.col("at")), F.col("value")).alias("whitened"),
        F.get(constants[0], F.col("at")).cast("double").alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )


def identity_error(whitened: DataFrame, clear: np.ndarray, n: int) -> float | None:
    """The largest difference between the written rows' covariance and the identity."""
    if not clear.any():
        return None
    means = whitened.select(F.posexplode("w").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("s"))
    mean = np.array([r["s"] for r in means.orderBy("at").collect()]) / n
    covariance = scatter(blocks(whitened, "w", len(clear)), n, len(clear)) / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(len(clear)))[clear][:, clear].max())


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding"))
