"""Small helpers around mapInArrow."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Texts may be long: so many rows at most reach Python at once.
BATCH_ROWS = 256


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """Maps each Arrow batch; ``make`` runs once for each task and returns the function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        for batch in batches:
            fn = fn or make()
            for piece in split(batch):
                yield fn(piece)

    return df.mapInArrow(run, schema)


def split(batch: pa.RecordBatch, rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def texts(column: pa.Array) -> list[str]:
    """Python strings of a text column; null is the empty text."""
    return [x or "" for x in column.to_pylist()]


def remembered(key: tuple, make: Callable[[], object]) -> object:
    """An object that a worker process keeps for its later tasks, such as a vocabulary.

    The package travels by value, so its own globals are new in each task. A worker keeps
    one object: what an earlier stage left is dropped when another stage begins.
    """
    memory = sys.modules.setdefault("tillsight_worker_memory", types.ModuleType("tillsight_worker_memory"))
    if getattr(memory, "key", None) != key:
        memory.key = memory.value = None
        memory.value, memory.key = make(), key
    return memory.value


def partitions_for(df: DataFrame, rows: int, per_task: int) -> int:
    """Tasks for rows that stand for much more data than they hold themselves."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_task))
