"""Exact top-k inner products over a bit-sliced index.

Method: vectors become integers, floor(256 * x). The index stores blocks of rows; of each
component's offset from the block's smallest value it stores the high bits as bitmaps over
the rows (the slices), next to the integers themselves. For a query, the slices of all
components are added with bitmap arithmetic (carry-save adders, 64 rows per machine word
and many queries at once), weighted by the high bits of the query; negative weights take
the complemented slices. That gives each row a coarse score in binary slices. The k-th
coarse score is found from the most significant slice downward, and the rows that can
still belong to the top k, given a bound of what the low bits may add, are the boundary rows:
they are resolved by exact integer products.

Queries meet all rows in blocks: one row of the joined table is a block of rows with a
group of queries, and only k rows of a query leave it. Nothing is sampled or dropped. Vectors with
an integer beyond 31 bits have blocks and groups of their own, without slices: all their rows
are boundary rows, and their products are exact at any size.

Vectors that are null or hold null or non-finite components take no part, as rows or as
queries; neither do rows with a null id. An empty vector has the score 0 with all. Rows that repeat an id are
candidates each, but never of a query with their own id; a query id that repeats is asked
once for each of its rows' vectors and answered by the best of them. Where lengths differ, missing
components are 0. A score beyond 64 bits, or a component that 256 times overflows, is an
error. With fewer than k candidates there are fewer rows, and none for an empty table.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillsight.llm.blocks import blocks_of, exact_products, meet, whole
from tillsight.session import cut_lineage

ROW_BITS, QUERY_BITS = 6, 6  # high bits in the index, and of a query's components
ROWS = 8192  # of a block
GROUP = 512  # queries that meet a block in one row
QUERIES = 64  # queries that are added up at once

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


WIDE = 2**30  # integers from here on are not sliced


def usable(vector: Column) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple[int, tuple]]:
    """Rows (id, vector), of kind 1 if they hold a large integer."""
    for row, vector in zip(batch.column(0).to_pylist(), whole(batch.column(1))):
        yield int(np.abs(vector).max(initial=0) >= WIDE), (row, vector)


def matrix(rows: list[tuple], kind: int) -> tuple[np.ndarray, np.ndarray]:
    values = np.zeros((len(rows), max((len(v) for _, v in rows), default=0)))
    for out, (_, v) in zip(values, rows):
        out[: len(v)] = v
    return np.array([i for i, _ in rows], dtype="i8"), values if kind else values.astype("i4")


def packed_rows(kind: int, rows: list[tuple]) -> bytes:
    ids, values = matrix(rows, kind)
    return pickle.dumps((ids, values, None if kind or not values.shape[1] else vars(Slices(values))))


def packed_queries(kind: int, rows: list[tuple]) -> bytes:
    return pickle.dumps(matrix(rows, kind))


class Slices:
    """The bit slices of a block of rows."""

    def __init__(self, values: np.ndarray):
        self.rows, self.width = values.shape
        self.words = -(-self.rows // 64)
        low = int(values.min())
        self.shift = max(0, (int(values.max()) - low).bit_length() - ROW_BITS)
        high = (values.astype(np.int64) - low) >> self.shift
        rest = values.astype(np.int64) - low - (high << self.shift) - ((1 << self.shift) - 1) / 2
        self.size, self.rest = (float(np.sqrt((x.astype(float) ** 2).sum(axis=1)).max()) for x in (values, rest))
        self.maps = np.zeros((self.width, ROW_BITS, self.words), dtype=np.uint64)
        for bit in range(ROW_BITS):
            self.maps[:, bit] = bitmaps(((high >> bit) & 1).T.astype(bool), self.words)
        self.inside = bitmaps(np.ones((1, self.rows), dtype=bool), self.words)[0]


def bitmaps(flags: np.ndarray, words: int) -> np.ndarray:
    """Each row of flags as 64-bit words."""
    out = np.zeros((len(flags), words * 8), dtype="u1")
    data = np.packbits(flags, axis=1, bitorder="little")
    out[:, : data.shape[1]] = data
    return out.view(np.uint64)


def full_adder(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and carry of three bitmaps."""
    ab = a ^ b
    total = ab ^ c
    ab &= c
    ab |= a & b
    return total, ab


def added(slices: Slices, weights: np.ndarray) -> list[np.ndarray]:
    """The binary slices, lowest first, of the weighted sum of all components, a row for each query."""
    waiting: list[list[np.ndarray]] = [[]]

    def put(place: int, bitmap: np.ndarray) -> None:
        while True:
            while place >= len(waiting):
                waiting.append([])
            here = waiting[place]
            here.append(bitmap)
            if len(here) < 3:
                return
            total, bitmap = full_adder(*here)
            here[:] = [total]
            place += 1

    flips = np.where(weights < 0, ALL, np.uint64(0))
    sizes = np.abs(weights)
    for k in range(slices.width):
        if not sizes[:, k].any():
            continue
        for bit in range(ROW_BITS):
            turned = slices.maps[k, bit][None, :] ^ flips[:, k, None]
            for power in range(QUERY_BITS):
                chosen = np.where((sizes[:, k] >> power) & 1, ALL, np.uint64(0))
                if chosen.any():
                    put(bit + power, turned & chosen[:, None])
    out = []
    carry = None
    place = 0
    while place < len(waiting) or carry is not None:
        here = [*(waiting[place] if place < len(waiting) else []), *([carry] if carry is not None else [])]
        if len(here) == 3:
            total, carry = full_adder(*here)
        elif len(here) == 2:
            total, carry = here[0] ^ here[1], here[0] & here[1]
        else:
            total, carry = (here[0] if here else np.zeros((len(weights), slices.words), np.uint64)), None
        out.append(total)
        place += 1
    return out


def boundary(sums: list[np.ndarray], allowed: np.ndarray, k: int, margin: np.ndarray) -> np.ndarray:
    """Bitmaps of the rows whose sum is at least the k-th largest one less the margin."""
    sure, tied = np.zeros_like(allowed), allowed.copy()
    kth = np.zeros(len(allowed), dtype=np.int64)
    for place in range(len(sums) - 1, -1, -1):
        with_one = tied & sums[place]
        enough = np.bitwise_count(sure | with_one).sum(axis=1) >= k
        kth |= np.where(enough, 1 << place, 0)
        sure = np.where(enough[:, None], sure, sure | with_one)
        tied = np.where(enough[:, None], with_one, tied & ~sums[place])
    least = np.maximum(kth - margin, 0)
    above, equal = np.zeros_like(allowed), allowed.copy()
    for place in range(len(sums) - 1, -1, -1):
        one = ((least >> place) & 1).astype(bool)[:, None]
        above = np.where(one, above, above | (equal & sums[place]))
        equal = np.where(one, equal & sums[place], equal & ~sums[place])
    return above | equal


def boundary_rows(slices: Slices, ids: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each query the rows of the block that may be among its k best."""
    width = slices.width
    fitted = np.zeros((len(queries), width), dtype=np.int64)
    fitted[:, : min(width, queries.shape[1])] = queries[:, :width]
    for start in range(0, len(fitted), QUERIES):
        part, own = fitted[start : start + QUERIES], query_ids[start : start + QUERIES]
        shift = max(0, int(np.abs(part).max(initial=0)).bit_length() - QUERY_BITS)
        # Rounded to the nearest, within the bits.
        weights = np.sign(part) * np.minimum((np.abs(part) + ((1 << shift) >> 1)) >> shift, (1 << QUERY_BITS) - 1)
        rest = part - (weights << shift)
        norm = lambda x: np.sqrt((x.astype(float) ** 2).sum(axis=1))
        unknown = norm(weights << shift) * slices.rest + norm(rest) * slices.size
        margin = np.floor(2 * unknown / float(1 << (slices.shift + shift)) * (1 + 1e-9)).astype(np.int64) + 1
        allowed = slices.inside[None, :] & ~bitmaps(own[:, None] == ids[None, :], slices.words)
        kept = boundary(added(slices, weights), allowed, k, margin)
        kept = np.unpackbits(kept.view("u1"), axis=1, bitorder="little")[:, : slices.rows]
        yield from (np.flatnonzero(flags) for flags in kept)


def best_rows(group: bytes, block: bytes, k: int) -> Iterator[tuple]:
    """(query, row id, score) of the k best rows of the block for each query of the group."""
    (query_ids, queries), (ids, values, slices) = pickle.loads(group), pickle.loads(block)
    if slices is not None and queries.dtype == np.int32 and queries.shape[1]:
        stored = Slices.__new__(Slices)
        stored.__dict__.update(slices)
        found = boundary_rows(stored, ids, query_ids, queries, k)
    else:
        found = (np.flatnonzero(ids != q) for q in query_ids)
    width = min(values.shape[1], queries.shape[1])
    for query, vector, rows in zip(query_ids, queries, found):
        some, own = values[rows, :width], vector[:width]
        # Below this bound no sum leaves 64 bits.
        if width * float(np.abs(own).max(initial=0)) * float(np.abs(some).max(initial=0)) < 2.0**62 and values.dtype == queries.dtype == np.int32:
            scores = some.astype(np.int64) @ own.astype(np.int64)
        else:
            scores = exact_products(some, own)
        for j in np.lexsort((ids[rows], -scores))[:k]:
            yield int(query), int(ids[rows[j]]), int(scores[j])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) for rows (id, vector) against rows (id, vector)."""

    def prepared(df: DataFrame) -> DataFrame:
        key, vector = (F.col(f"`{c}`") for c in df.columns)
        rows = df.select(key.cast("long").alias("id"), vector.cast("array<double>").alias("v"), usable(vector).alias("fits"))
        return rows.filter("id IS NOT NULL AND fits").drop("fits")

    index = cut_lineage(blocks_of(prepared(vectors), ROWS, rows_of, packed_rows))
    spread = max(1, queries.sparkSession.sparkContext.defaultParallelism)
    asked = cut_lineage(blocks_of(prepared(queries).repartition(spread, "id"), GROUP, rows_of, packed_queries))
    found = meet(index, asked, lambda group, block: best_rows(group, block, k), ["query_id", "vec_id", "score"])
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(rows, rows.filter(F.col("vec_id") % 50 == 0))


OP10_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id,
             coalesce(list_sum(list_transform(list_zip(q.e, v.e), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))), 0)::BIGINT AS score
      FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
