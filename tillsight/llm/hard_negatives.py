"""Hard negatives by angular triangle filtering.

Method: vectors become integers, floor(256 * x). Consecutive components form planes. In each
plane three reference directions, 60 degrees apart, are fixed; the index stores every row's
angle to each of them, the share of its norm that lies in the plane, and the norm. For an anchor at
angle s and a row at angle t to one direction the angle between both lies within
[|s - t|, min(s + t, 360 degrees - s - t)], so its cosine within
[cos s cos t - sin s sin t, cos s cos t + sin s sin t]. The three directions of a plane
intersect their intervals; times the norms and added over the planes they bound the
inner product. The bounds are computed with 32-bit numbers and widened by more than all
rounding may amount to. Only rows whose bounds overlap the wanted scores are multiplied
as integers.

1. Positives: the first rows of the anchor's label. The rows with the highest bounds are scored
   first; others only if their upper bound reaches the last score that counts.
2. Negatives: for each positive, rows of other labels whose score lies within given
   percentages of the positive's score. The window bounds the rows from both sides, and so does
   the last score that counts once enough rows are known to be inside.

Anchors meet all rows in blocks: one joined row is a block of rows with a group of anchors, and
a group travels once per shelf of blocks. Only the counted rows of each anchor leave it.
Nothing is sampled or dropped.

Rows with a null id, label, vector or component, or a non-finite component, take no part. Rows
that repeat an id are candidates each, but never of an anchor with their own id; an anchor id
on several rows stands for the one with the smallest label and vector. Where lengths differ, missing
components are 0; an empty vector has the score 0 with all. Scores are exact at any size of the
components; one beyond 64 bits, or a component that 256 times overflows, is an error.
With no rows, anchors or positives there are no results.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillsight.llm.blocks import blocks_of, exact_products, meet, whole
from tillsight.session import cut_lineage

ROWS = 2048  # of a block
GROUP = 256  # anchors that meet a block in one row
CHUNK = 16  # anchors whose bounds are computed at once
SEEDS = 64  # rows that are scored first
DIRECTIONS = np.pi / 3 * np.arange(3)  # in each plane
EXACT = 2.0**53  # doubles below hold every integer


def usable(rows: DataFrame) -> DataFrame:
    """(id, label, vector) of the rows that take part."""
    key, label, vector = (F.col(f"`{c}`") for c in rows.columns)
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.select(key.cast("long").alias("id"), label.cast("long").alias("label"), vector.cast("array<double>").alias("vector"), fits.alias("fits"))
    return rows.filter("id IS NOT NULL AND label IS NOT NULL AND fits").drop("fits")


def matrix(vectors: list[np.ndarray]) -> np.ndarray:
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width + width % 2))
    for row, x in zip(out, vectors):
        row[: len(x)] = x
    return out


def angles(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Norm of each row, share of it in each plane, angle to each direction of each plane."""
    largest = np.maximum(np.abs(values).max(axis=1, initial=0), 1)
    scaled = (values / largest[:, None]).reshape(len(values), -1, 2)
    total = np.sqrt((scaled**2).sum(axis=(1, 2)))
    share = np.hypot(scaled[..., 0], scaled[..., 1]) / np.where(total > 0, total, 1)[:, None]
    turn = np.abs(np.arctan2(scaled[..., 1], scaled[..., 0])[..., None] - DIRECTIONS)
    return total * largest, share.astype("f4"), np.minimum(turn, 2 * np.pi - turn).astype("f4")


class Part:
    """Rows of a block or a group: their integers, and the sides of the triangles, weighted by plane."""

    def __init__(self, data: bytes):
        stored = pickle.loads(data)
        self.ids, self.labels, self.values, self.norms = (stored[k] for k in ("ids", "labels", "values", "norms"))
        self.more = stored["more"]
        share, angle = stored["share"][:, :, None], stored["angle"]
        self.cos, self.sin = (np.ascontiguousarray((f(angle) * share).transpose(1, 2, 0)) for f in (np.cos, np.sin))


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple[int, tuple]]:
    """Rows (id, label, vector, more), all of one kind."""
    columns = (batch.column(0).to_pylist(), batch.column(1).to_pylist(), whole(batch.column(2)), batch.column(3).to_pylist())
    return ((0, row) for row in zip(*columns))


def packed(_: int, rows: list[tuple]) -> bytes:
    """Rows of one part, ordered by label, as bytes."""
    ids, labels, vectors, more = zip(*rows)
    order = np.argsort(labels, kind="stable")
    values = matrix([vectors[i] for i in order])
    norms, share, angle = angles(values)
    return pickle.dumps({
        "ids": np.array(ids, dtype="i8")[order], "labels": np.array(labels, dtype="i8")[order], "values": values,
        "norms": norms, "share": share, "angle": angle, "more": [more[i] for i in order],
    })


def parts(rows: DataFrame, size: int) -> DataFrame:
    """Up to so many rows (id, label, vector, more) of a task as one row of bytes."""
    return blocks_of(rows, size, rows_of, packed)


def bounds(left: Part, right: Part, some: np.ndarray, span: slice) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the cosines between some rows of the left part and a span of the right one."""
    shape = (len(some), span.stop - span.start)
    low, high, lo, hi, c, s, t = (np.zeros(shape, "f4") for _ in range(7))
    for plane in range(min(left.cos.shape[0], right.cos.shape[0])):
        for k in range(len(DIRECTIONS)):
            np.multiply(left.cos[plane, k, some][:, None], right.cos[plane, k, span], out=c)
            np.multiply(left.sin[plane, k, some][:, None], right.sin[plane, k, span], out=s)
            if k == 0:
                np.subtract(c, s, out=lo)
                np.add(c, s, out=hi)
            else:
                np.maximum(lo, np.subtract(c, s, out=t), out=lo)
                np.minimum(hi, np.add(c, s, out=t), out=hi)
        low += lo
        high += hi
    return low, high


def slack(planes: int) -> float:
    """More than the rounding of angles, sines and sums can move a cosine."""
    return (planes + 16) * 2.0**-22


def products(block: Part, rows: np.ndarray, anchor: np.ndarray, norm: float) -> np.ndarray:
    """Exact integer scores of some rows."""
    width = min(block.values.shape[1], len(anchor))
    some = block.values[rows, :width]
    if norm * block.norms[rows].max(initial=0) * 2 < EXACT:
        return (some @ anchor[:width]).astype(np.int64)
    return exact_products(some, anchor[:width])


def within(block: Part, rows: np.ndarray, low: np.ndarray, high: np.ndarray, anchor: np.ndarray, norm: float, windows: list[tuple], k: int) -> list[tuple]:
    """For each window (least, most) the first k (score, row) inside; low and high bound the rows' scores."""
    overlap = (high >= min(w[0] for w in windows)) & (low <= max(w[1] for w in windows))
    rows, low, high = rows[overlap], low[overlap], high[overlap]
    chosen = np.ones(len(rows), dtype=bool)
    if len(rows) > SEEDS:
        middle = low + high
        middle[middle > 2 * max(w[1] for w in windows)] = -np.inf
        first = np.argpartition(-middle, SEEDS)[:SEEDS]
        scores = products(block, rows[first], anchor, norm)
        chosen[:] = False
        for least, most in windows:
            inside = np.sort(scores[(scores >= least) & (scores <= most)])[-k:]
            last = inside[0] if len(inside) == k else least
            chosen |= (high >= last) & (low <= most)
    rows = rows[chosen]
    scores = products(block, rows, anchor, norm)
    out = []
    for least, most in windows:
        inside = np.flatnonzero((scores >= least) & (scores <= most))
        order = inside[np.lexsort((block.ids[rows[inside]], -scores[inside]))[:k]]
        out.append((scores[order], rows[order]))
    return out


def spread(group: Part, block: Part, some: np.ndarray, span: slice) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For some anchors of a group: the place, and rows of the span with lower and upper bounds of their scores."""
    rows = np.arange(span.start, span.stop)
    margin = slack(block.cos.shape[0])
    for start in range(0, len(some), CHUNK):
        chunk = some[start : start + CHUNK]
        low, high = bounds(group, block, chunk, span)
        for i, lo, hi in zip(chunk, low, high):
            size = group.norms[i] * block.norms[span]
            other = block.ids[span] != group.ids[i]
            yield i, rows[other], ((lo - margin) * size - 1)[other], ((hi + margin) * size + 1)[other]


def stretch(labels: np.ndarray, label: int) -> slice:
    """The rows of one label in a part ordered by label."""
    return slice(int(np.searchsorted(labels, label)), int(np.searchsorted(labels, label, side="right")))


def positives_of(group: Part, block: Part, k: int) -> Iterator[tuple]:
    """(anchor, row id, score) of the first k rows of each anchor's label in the block."""
    for label in np.intersect1d(group.labels, block.labels):
        own = stretch(group.labels, label)
        for i, rows, low, high in spread(group, block, np.arange(own.start, own.stop), stretch(block.labels, label)):
            for scores, found in within(block, rows, low, high, group.values[i], group.norms[i], [(-np.inf, np.inf)], k):
                for score, row in zip(scores, found):
                    yield int(group.ids[i]), int(block.ids[row]), int(score)


def negatives_of(group: Part, block: Part, k: int, least: int, most: int) -> Iterator[tuple]:
    """(anchor, positive, place, row id, positive score, score) of the first k rows of other labels in each positive's window."""
    for i, rows, low, high in spread(group, block, np.arange(len(group.ids)), slice(0, len(block.ids))):
        other = block.labels[rows] != group.labels[i]
        # Integer ends of the windows; those of negative scores are empty.
        ends = [(p, (-(-least * p["score"] // 100), most * p["score"] // 100)) for p in group.more[i]]
        ends = [(p, (float(a), float(b)) if max(abs(a), abs(b)) < EXACT else (a, b)) for p, (a, b) in ends if a <= b]
        if not ends or not other.any():
            continue
        found = within(block, rows[other], low[other], high[other], group.values[i], group.norms[i], [w for _, w in ends], k)
        for (p, _), (scores, best) in zip(ends, found):
            for score, row in zip(scores, best):
                yield int(group.ids[i]), p["id"], p["place"], int(block.ids[row]), p["score"], int(score)


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows and
    anchors (id, label, vector): for each anchor and each of its first positives the first rows of
    other labels whose score lies within least and most percent of the positive's score."""
    nothing = F.lit(None).cast("int").alias("more")
    index = cut_lineage(parts(usable(rows).select("id", "label", "vector", nothing), ROWS))
    asked = usable(anchors).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.label", "row.vector")
    asked = cut_lineage(asked)
    first = cut_lineage(parts(asked.select("*", nothing), GROUP))
    found = meet(index, first, lambda group, block: positives_of(Part(group), Part(block), positives), ["anchor", "id", "score"])
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id"))
    found = found.withColumn("place", place).filter(F.col("place") <= positives)
    found = found.groupBy("anchor").agg(F.collect_list(F.struct("id", "score", "place")).alias("more"))  # so many at most
    known = asked.join(found, F.col("id") == F.col("anchor")).select("id", "label", "vector", "more")
    names = ["anchor_id", "positive_id", "place", "negative_id", "positive_score", "negative_score"]
    groups = cut_lineage(parts(known, GROUP))
    found = meet(index, groups, lambda group, block: negatives_of(Part(group), Part(block), negatives, least, most), names)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id"))
    found = found.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = rows.select("vec_id", label.alias("label"), "embedding")
    return hard_negatives(rows, rows.filter(F.col("vec_id") % 100 == 0))


OP11_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
             coalesce(list_sum(list_transform(list_zip(a.e, v.e), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))), 0)::BIGINT AS score
      FROM v a JOIN v ON a.vec_id % 100 = 0 AND v.vec_id <> a.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
