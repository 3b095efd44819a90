"""Blocks of rows that meet groups of queries: the frame around exact searches over all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

SCALE = 256.0
SHELF = 16  # blocks, at most, for which a group travels once


def whole(column: pa.Array) -> list[np.ndarray]:
    """floor(256 * x) of each vector; doubles hold these integers exactly."""
    values, at = column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * values)
    if not np.isfinite(scaled).all():
        raise ValueError("a component is too large to be multiplied by 256")
    return [scaled[a:b] for a, b in zip(at, at[1:])]


def exact_products(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products of integers held by doubles, however large; an error beyond 64 bits."""
    own = [int(x) for x in vector]
    found = [sum(int(x) * y for x, y in zip(row, own)) for row in rows]
    if any(not -(1 << 63) <= x < 1 << 63 for x in found):
        raise ValueError("a score does not fit into 64 bits")
    return np.array(found, dtype=np.int64)


def blocks_of(rows: DataFrame, size: int, read: Callable[[pa.RecordBatch], Iterable[tuple[int, tuple]]], pack: Callable[[int, list[tuple]], bytes]) -> DataFrame:
    """(task, number, data): the rows of a task, by their kind, in blocks of up to so many as bytes.

    ``read`` yields kind and row, ``pack`` makes the bytes of a block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, waiting = TaskContext.get().partitionId(), 0, {}

        def full(kind: int) -> pa.RecordBatch:
            data = pack(kind, waiting.pop(kind))
            return pa.RecordBatch.from_arrays([pa.array([task]), pa.array([number]), pa.array([data], pa.binary())], ["task", "number", "data"])

        for batch in batches:
            for start in range(0, batch.num_rows, size):
                for kind, row in read(batch.slice(start, size)):
                    waiting.setdefault(kind, []).append(row)
                    if len(waiting[kind]) == size:
                        yield full(kind)
                        number += 1
        for kind in list(waiting):
            yield full(kind)
            number += 1

    return rows.mapInArrow(run, "task long, number long, data binary")


def numbered(blocks: DataFrame) -> DataFrame:
    """(place, data): the blocks of all tasks counted from 0."""
    sizes = blocks.groupBy("task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    # One short row per task.
    starts = sizes.select("task", F.coalesce(before, F.lit(0)).alias("start"))
    return blocks.join(F.broadcast(starts), "task").select((F.col("start") + F.col("number")).alias("place"), "data")


def meet(index: DataFrame, groups: DataFrame, visit: Callable[[bytes, bytes], Iterable[tuple]], names: list[str]) -> DataFrame:
    """What ``visit(group, block)`` yields for every group with every block, as long columns."""
    count, cores = index.count(), index.sparkSession.sparkContext.defaultParallelism
    shelf = max(1, min(SHELF, count // (4 * cores)))
    shelves = -(-count // shelf)
    tasks = max(1, min(shelves, 4 * cores))
    right = numbered(index).select(F.floor(F.col("place") / shelf).alias("shelf"), F.col("data").alias("block"))
    all_shelves = F.sequence(F.lit(0).cast("long"), F.lit(max(shelves - 1, 0)).cast("long"))
    left = groups.select(F.explode(all_shelves).alias("shelf"), F.col("data").alias("group"))
    # Merged: the groups of a shelf stream past its blocks.
    pairs = left.repartition(tasks, "shelf").join(right.repartition(tasks, "shelf").hint("merge"), "shelf").select("group", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, block in zip(batch.column(0), batch.column(1)):
                found = list(visit(group.as_py(), block.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*found) if found else [[]] * len(names))], names)

    return pairs.mapInArrow(run, ", ".join(f"{x} long" for x in names))
