"""Joins whose small side is broadcast only behind a check of its size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A broadcast side holds at most so many entries: rows of ids, short words and numbers, or
# the elements of its arrays.
BROADCAST_ENTRIES = 200_000
# Written frames of so many rows at most are left to Spark, which goes by the size of their files.
LEFT_ROWS = 20_000


def small(df: DataFrame, weight: Column | None = None, entries: int = BROADCAST_ENTRIES) -> DataFrame:
    """The (written) frame, marked for broadcast if its counted entries are within the bound;
    beyond it Spark shuffles both sides and splits skewed partitions."""
    counted = df.agg(F.sum(weight) if weight is not None else F.count("*")).first()[0] or 0
    return F.broadcast(df) if counted <= entries else df


def merged(df: DataFrame, rows: int) -> DataFrame:
    """One side of a join, of so many rows before any explosion; where these are many, both sides are shuffled and merged.

    Columns of few values make small files of many rows, and exploded rows look as small as what they come
    from: Spark would send them through the driver's memory.
    """
    return df.hint("merge") if rows > LEFT_ROWS else df


def bounded(df: DataFrame) -> DataFrame:
    """The (written) frame as a side of a join, see ``merged``."""
    return merged(df, df.count())
