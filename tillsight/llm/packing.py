"""Documents packed into sequences: best fit decreasing, certified by lower bounds, with exchange.

Method: texts become token ids with an end id; a document longer than a sequence is cut into
pieces of a sequence's length. The pieces are dealt evenly to partitions of a bounded
number of pieces, and each partition places its own, longest first, into the fullest sequence that
still takes them. A lower bound on the sequences of a partition comes from dual feasible
functions: weights of lengths that no full sequence can exceed 1 in sum, whatever it holds. A
partition that meets its bound is certified: no order of its pieces does better.

Partitions that miss their bound have gaps. They release their emptiest sequences, at most half of all; certified ones release only the last
unfilled one, because bounds are rounded up in each partition. What was released is dealt anew to
fewer partitions and packed again, which is kept if it takes fewer sequences. This ends when
the whole meets the bound of the whole corpus, when one partition has seen all that
was released, or when a round saves nothing.

Pieces carry their place, length and checksum, not their ids; a histogram of lengths is all that reaches
the driver. Nulls and empty texts have the end id alone. Rows that repeat an id are packed each. An
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillsight.llm.arrowio import remembered, split, texts
from tillsight.llm.token_frames import TEXTS, WordEncoder
from tillsight.session import cut_lineage

CAPACITY = 4096  # tokens of a sequence
PIECES = 1 << 14  # of a partition
FAMILY = 64  # members of the second family of dual feasible functions
END_ID = 1

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECE}, task int, bin long, offset long, bins long, bound long, released boolean"


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of the documents (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = remembered(("words", vocabulary, end_id), lambda: WordEncoder(vocabulary, end_id))
        for batch in batches:
            for rows in split(batch, TEXTS):
                out: tuple[list, ...] = ([], [], [], [], [])
                for doc, ids in zip(rows.column(0).to_pylist(), encoder.encode(texts(rows.column(1)))):
                    for number, start in enumerate(range(0, len(ids) // 4, capacity)):
                        part = ids[4 * start : 4 * (start + capacity)]
                        for column, value in zip(out, (doc, number, start, len(part) // 4, zlib.crc32(part))):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, KINDS)], NAMES)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, PIECE)


KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
NAMES = [x.split()[0] for x in PIECE.split(", ")]


def lower_bound(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """No packing needs fewer sequences; ``counts`` holds the number of pieces of each length from 0 on.

    The first family counts lengths over capacity - t whole and drops those below t; the
    second rounds lengths down to parts of k where k + 1 times the length is not a multiple
    of the capacity. Integers only.
    """
    counts = [int(x) for x in counts[: capacity + 1]]
    lengths = range(len(counts))
    pieces = [0]
    tokens = [0]
    for length in lengths:
        pieces.append(pieces[-1] + counts[length])
        tokens.append(tokens[-1] + counts[length] * length)
    best = -(-tokens[-1] // capacity)
    for t in range(1, capacity // 2 + 1):
        whole = pieces[-1] - pieces[min(capacity - t + 1, len(counts))]
        middle = tokens[min(capacity - t + 1, len(counts))] - tokens[min(t, len(counts))]
        best = max(best, -(-(whole * capacity + middle) // capacity))
    present = [(length, c) for length, c in zip(lengths, counts) if c]
    for k in range(1, FAMILY + 1):
        total = sum(c * (k * x if (k + 1) * x % capacity == 0 else capacity * ((k + 1) * x // capacity)) for x, c in present)
        best = max(best, -(-total // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For lengths in falling order: the sequence of each and its offset there; and the room left in each sequence."""
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # a bit for each room that a sequence has
    left: list[int] = []
    bins, offsets = [], []
    for length in lengths.tolist():
        fitting = some >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = rooms[room].pop()
            if not rooms[room]:
                some ^= 1 << room
        else:
            room, number = capacity, len(left)
            left.append(capacity)
        bins.append(number)
        offsets.append(capacity - room)
        room -= length
        left[number] = room
        if room:
            rooms[room].append(number)
            some |= 1 << room
    return np.array(bins, dtype=np.int64), np.array(offsets, dtype=np.int64), np.array(left, dtype=np.int64)


def to_release(left: np.ndarray, bound: int) -> np.ndarray:
    """Marks the sequences that a partition gives up: its emptiest ones, if they have room."""
    most = 1 if len(left) == bound else max(1, len(left) // 2)
    out = np.zeros(len(left), dtype=bool)
    out[np.argsort(-left, kind="stable")[:most]] = True
    return out & (left > 0)


def packed(pieces: DataFrame, tasks: int, capacity: int) -> DataFrame:
    """The pieces, dealt to so many partitions, with their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if rows is None or not rows.num_rows:
            return
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        lengths = rows["length"].to_numpy()
        bins, offsets, left = best_fit(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        n = rows.num_rows
        columns = [
            pa.array([TaskContext.get().partitionId()] * n, pa.int32()), pa.array(bins), pa.array(offsets),
            pa.array([len(left)] * n, pa.int64()), pa.array([bound] * n, pa.int64()), pa.array(to_release(left, bound)[bins]),
        ]
        out = pa.table([*(rows[c] for c in NAMES), *columns], [x.split()[0] for x in PLACED.split(", ")])
        yield from out.combine_chunks().to_batches(max_chunksize=10_000)

    return pieces.select(*NAMES).repartition(tasks).mapInArrow(run, PLACED)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id, offset, and for the whole: sequences (their number) and lower_bound."""
    pool = cut_lineage(pieces)
    by_length = pool.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most one row per length
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in by_length:
        counts[r["length"]] = r["n"]
    bound, size = lower_bound(counts, capacity), int(counts.sum())
    done: list[DataFrame] = []
    closed, released, before = 0, None, None
    while size:
        tasks = -(-size // PIECES)
        number = F.lit(len(done)).cast("long")
        placed = cut_lineage(packed(pool, tasks, capacity).withColumn(
            "sequence_id", (F.shiftleft(number, 56) + F.shiftleft(F.col("task").cast("long"), 32) + F.col("bin"))
        ))
        first = placed.filter("offset = 0").agg(F.count("*").alias("all"), F.count_if("released").alias("open")).first()
        if released is not None and first["all"] >= released:
            # Nothing was saved: what the last round released stays as it was.
            done.append(before.filter("released"))
            closed += released
            break
        if tasks == 1 or closed + first["all"] == bound:
            done.append(placed)
            closed += first["all"]
            break
        done.append(placed.filter("NOT released"))
        closed += first["all"] - first["open"]
        before, released, pool = placed, first["open"], placed.filter("released")
        size = pool.count()
    if not done:
        done = [packed(pool, 1, capacity).withColumn("sequence_id", F.lit(0).cast("long"))]
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.select(*NAMES, "sequence_id", "offset", F.lit(closed).cast("long").alias("sequences"), F.lit(bound).cast("long").alias("lower_bound"))


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return pack(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))
