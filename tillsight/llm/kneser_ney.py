"""Perplexity under an interpolated modified Kneser-Ney model of word pairs.

Method: tasks hash the words of their texts and count pairs (previous word, word) in
sorted arrays before anything is shuffled. Pairs are dealt to shards by the previous word's
hash plus a few bits of the word's, so that the followers of a very frequent word spread
over many shards. A shard sums its pairs, writes them as a sorted array of hashes with
counts, and passes on what the unigram level needs of them: for each word its count, the
number of different words before it, and how many of its followers were seen once, twice
or more. These are summed in a second shuffle and written as sorted arrays as well.
All files lie in the shared folder; a manifest table lists them. The three discounts
of each level follow from the counts of counts in the manifest.

Workers map the files into memory and look up a batch of texts in one vectorised search
per shard: p(w|v) = max(c(vw) - D, 0) / c(v) + g(v) p(w), where g(v) is the mass that the
discounts left, and p(w) is the same formula over the numbers of different left neighbours,
interpolated with 1 / (V + 1). Probabilities of a context add up to one over all words
and one unknown word.

The number of shards is the session's shuffle partitions. Every text starts after a start
mark and ends in an end token. Null is the empty text, which is the end token alone; texts without words
likewise. Without training rows every probability is 1 / (V + 1) = 1. Repeated rows
count as often as they occur.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillsight.llm.arrowio import map_batches, remembered, split, texts
from tillsight.llm.hashing import WordHasher, mix
from tillsight.llm.language import rest
from tillsight.llm.storage import locate, make_folder, unique
from tillsight.session import cut_lineage, shared_folder

START, END = np.uint64(0x5354415254), np.uint64(0x454E44)  # no hash of a word but by chance
SPREAD = 64  # shards that the followers of one word lie in
HOLD = 4_000_000  # pairs that a task sorts at once
HOLD_SUMS = 12_000_000  # different pairs that a task holds before it passes them on
TOP = 255  # larger counts are kept apart

ROW = "kind string, part int, path string, stats array<long>, blob binary"
ARROW_ROW = pa.schema([
    ("kind", pa.string()), ("part", pa.int32()), ("path", pa.string()), ("stats", pa.list_(pa.int64())), ("blob", pa.binary()),
])


def row(kind: str, part: int, path: str | None = None, stats: list[int] | None = None, blob: bytes | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"kind": kind, "part": part, "path": path, "stats": stats, "blob": blob}], schema=ARROW_ROW)


def pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(mix(before + np.uint64(1)) + word)


def pair_shard(before: np.ndarray, word: np.ndarray, shards: int) -> np.ndarray:
    near = mix(word) % np.uint64(min(SPREAD, shards))
    return ((mix(before) + near) % np.uint64(shards)).astype(np.int64)


def word_shard(word: np.ndarray, shards: int) -> np.ndarray:
    return (mix(word + np.uint64(7)) % np.uint64(shards)).astype(np.int64)


def pairs_of(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Previous word and word of each token of the texts, the end token included."""
    after = np.concatenate([np.append(w, END) for w in words]) if words else np.zeros(0, np.uint64)
    before = np.concatenate([np.concatenate([[START], w]) for w in words]) if words else after
    return before.astype(np.uint64), after.astype(np.uint64)


def summed(before: np.ndarray, word: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs, sorted, with the sums of their counts."""
    order = np.lexsort((word, before))
    before, word, count = before[order], word[order], count[order]
    first = np.ones(len(word), dtype=bool)
    first[1:] = (before[1:] != before[:-1]) | (word[1:] != word[:-1])
    at = np.flatnonzero(first)
    return before[at], word[at], np.add.reduceat(count, at) if len(at) else count


def small_numbers(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.astype("<i8").tobytes() for x in arrays))


def large_numbers(data: bytes, *sizes: int) -> list[np.ndarray]:
    values = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i8")
    return np.split(values, np.cumsum(sizes)[:-1])


def pack_pairs(before: np.ndarray, word: np.ndarray, count: np.ndarray) -> bytes:
    """Pairs sorted by the previous word, which is stored once for all its followers."""
    at = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
    runs = np.diff(np.append(at, len(word)))
    return struct.pack("<II", len(at), len(word)) + before[at].tobytes() + word.tobytes() + small_numbers(runs, count)


def unpack_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    heads, size = struct.unpack_from("<II", data)
    before = np.frombuffer(data, "<u8", heads, 8)
    word = np.frombuffer(data, "<u8", size, 8 + 8 * heads)
    runs, count = large_numbers(data[8 + 8 * (heads + size) :], heads, size)
    return np.repeat(before, runs), word, count


def dealt(parts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part with the places of its rows, in their order."""
    order = np.argsort(parts, kind="stable")
    cuts = np.flatnonzero(np.diff(parts[order])) + 1
    for at in np.split(order, cuts):
        if len(at):
            yield int(parts[at[0]]), at


def count_pairs(docs: DataFrame, shards: int) -> DataFrame:
    """Rows (pairs, shard, blob) of sums over as many texts as a task holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, waiting, size = WordHasher(), [], 0
        empty = np.zeros(0, np.uint64)
        held = (empty, empty, np.zeros(0, np.int64))

        def fold() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            before, word = pairs_of(waiting)
            one = np.ones(len(word), np.int64)
            new = summed(before, word, one)
            waiting.clear()
            return summed(*(np.concatenate([a, b]) for a, b in zip(held, new))) if len(held[0]) else new

        def out() -> Iterator[pa.RecordBatch]:
            for part, at in dealt(pair_shard(held[0], held[1], shards)):
                yield row("pairs", part, blob=pack_pairs(*(x[at] for x in held)))

        for batch in batches:
            for piece in split(batch):
                for words in hasher.texts(texts(piece.column(0))):
                    waiting.append(words)
                    size += len(words) + 1
                if size >= HOLD:
                    held, size = fold(), 0
                    if len(held[0]) >= HOLD_SUMS:
                        yield from out()
                        held = (empty, empty, np.zeros(0, np.int64))
        held = fold()
        yield from out()

    return docs.select(F.col("text").cast("string")).mapInArrow(run, ROW)


def counts_of_counts(count: np.ndarray) -> list[int]:
    """How many are 1, 2, 3, 4 and more than two; their number and sum."""
    return [*(int((count == k).sum()) for k in (1, 2, 3, 4)), int((count > 2).sum()), len(count), int(count.sum())]


def write(path: str, *arrays: np.ndarray) -> None:
    fs, place = locate(path)
    with fs.open_output_stream(place, compression=None) as out:
        out.write(np.array([len(x) for x in arrays], "<u8").tobytes())
        for x in arrays:
            out.write(np.ascontiguousarray(x).tobytes())


def mapped(path: str, *kinds: str) -> list[np.ndarray]:
    """The arrays of a file, mapped into memory; read where the folder is no mounted one."""
    import pyarrow.fs as pafs

    fs, place = locate(path)
    if isinstance(fs, pafs.LocalFileSystem):
        data = np.memmap(place, dtype="u1", mode="r")
    else:
        with fs.open_input_file(place) as source:
            data = np.frombuffer(source.read(), dtype="u1")
    sizes = data[: 8 * len(kinds)].view("<u8")
    out, at = [], 8 * len(kinds)
    for size, kind in zip(sizes, kinds):
        length = int(size) * np.dtype(kind).itemsize
        out.append(data[at : at + length].view(kind))
        at += length
    return out


def merge_pairs(folder: str, shards: int) -> Callable[[pa.Table], pa.Table]:
    """A shard's pairs: written as sorted arrays; its share of the word counts is passed on."""

    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        before, word, count = summed(*(np.concatenate(x) for x in zip(*(unpack_pairs(b.as_py()) for b in table["blob"]))))
        keys = pair_hash(before, word)
        order = np.argsort(keys)
        sorted_count = count[order]
        large = np.flatnonzero(sorted_count >= TOP)
        path = unique(folder, f"pairs-{part:06d}", ".bin")
        write(path, keys[order].astype("<u8"), large.astype("<u8"), sorted_count[large].astype("<u8"), np.minimum(sorted_count, TOP).astype("u1"))
        out = [row("pairs", part, path, counts_of_counts(count))]
        zero = np.zeros(len(word), np.int64)
        # As a follower: its count and one left neighbour. As a previous word: the class of the pair's count.
        both = np.concatenate([word, before])
        columns = [
            np.concatenate([a, b])
            for a, b in ((count, zero), (zero + 1, zero), (zero, count == 1), (zero, count == 2), (zero, count > 2))
        ]
        names, sums = by_word(both, columns)
        for to, at in dealt(word_shard(names, shards)):
            out.append(row("words", to, blob=pack_words(names[at], [x[at] for x in sums])))
        return pa.Table.from_batches(out)

    return run


def by_word(words: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    order = np.argsort(words, kind="stable")
    words = words[order]
    at = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else np.zeros(0, np.intp)
    return words[at], [np.add.reduceat(x[order].astype(np.int64), at) if len(at) else x for x in columns]


def pack_words(words: np.ndarray, columns: list[np.ndarray]) -> bytes:
    return struct.pack("<I", len(words)) + words.tobytes() + small_numbers(*columns)


def unpack_words(data: bytes) -> list[np.ndarray]:
    (size,) = struct.unpack_from("<I", data)
    return [np.frombuffer(data, "<u8", size, 4), *large_numbers(data[4 + 8 * size :], *[size] * 5)]


def merge_words(folder: str) -> Callable[[pa.Table], pa.Table]:
    """A shard's words: written as sorted arrays; rows about files are handed on."""

    def run(table: pa.Table) -> pa.Table:
        out = [b for b in table.filter(pa.compute.equal(table["kind"], "pairs")).combine_chunks().to_batches()]
        found = table.filter(pa.compute.equal(table["kind"], "words"))
        if found.num_rows:
            part = found["part"][0].as_py()
            words, *columns = (np.concatenate(x) for x in zip(*(unpack_words(b.as_py()) for b in found["blob"])))
            words, (count, left, once, twice, more) = by_word(words, columns)
            path = unique(folder, f"words-{part:06d}", ".bin")
            write(path, words.astype("<u8"), count.astype("<u8"), *(x.astype("<u4") for x in (left, once, twice, more)))
            token = left > 0  # the start mark is none
            end = count[words == END]
            stats = [*counts_of_counts(left[token]), int(count[token].sum()), int(end.sum())]
            out.append(row("words", part, path, stats))
        return pa.Table.from_batches(out, schema=ARROW_ROW)

    return run


@dataclass
class Level:
    """Discounts for counts of one, two and more, and the interpolation constants of a level."""

    discounts: np.ndarray
    counts: list[int]

    @classmethod
    def of(cls, stats: list[int]) -> Level:
        n = [max(x, 0) for x in stats[:4]]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
        # Where a count of counts is zero, the plain value of absolute discounting.
        found = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] and n[k + 1] else 0.5 + 0.25 * k for k in range(3)]
        return cls(np.array([0.0, *np.clip(found, 0.05, [0.95, 1.9, 2.85])]), stats)

    def kept(self, count: np.ndarray) -> np.ndarray:
        return count - self.discounts[np.minimum(count, 3).astype(np.int64)]


@dataclass
class Model:
    """Where the arrays are, and the totals of the training rows."""

    shards: int
    pairs: dict[int, str]
    words: dict[int, str]
    upper: Level
    lower: Level
    tokens: int
    texts: int

    @property
    def distinct(self) -> int:
        return self.lower.counts[5]


def train(docs: DataFrame) -> Model:
    """Counts all given rows. The driver sees one row per file."""
    spark = docs.sparkSession
    shards = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    folder = shared_folder(spark, unique("", "ngrams", "").lstrip("/"))
    make_folder(folder)
    pairs = count_pairs(docs, shards).groupBy("part").applyInArrow(merge_pairs(folder, shards), ROW)
    manifest = cut_lineage(pairs.groupBy("part").applyInArrow(merge_words(folder), ROW).drop("blob"))
    files = manifest.collect()
    total = lambda kind, size: [sum(f["stats"][i] for f in files if f["kind"] == kind) for i in range(size)]
    upper, lower = total("pairs", 7), total("words", 9)
    paths = {k: {f["part"]: f["path"] for f in files if f["kind"] == k} for k in ("pairs", "words")}
    return Model(shards, paths["pairs"], paths["words"], Level.of(upper), Level.of(lower), lower[7], lower[8])


class Lookup:
    """The arrays of a model, opened where they are needed."""

    def __init__(self, model: Model):
        self.model, self.open = model, {}

    def arrays(self, kind: str, part: int) -> list[np.ndarray] | None:
        path = getattr(self.model, kind).get(part)
        if path is not None and path not in self.open:
            self.open[path] = mapped(path, *(("<u8", "<u8", "<u8", "u1") if kind == "pairs" else ("<u8", "<u8", *["<u4"] * 4)))
        return self.open.get(path)

    def pair_counts(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.zeros(len(word), np.int64)
        keys = pair_hash(before, word)
        for part, at in dealt(pair_shard(before, word, self.model.shards)):
            if arrays := self.arrays("pairs", part):
                table, large, counts, small = arrays
                place, there = find(table, keys[at])
                got = small[place].astype(np.int64)
                top = got == TOP
                if top.any():
                    got[top] = counts[np.minimum(np.searchsorted(large, place[top]), len(large) - 1)].astype(np.int64)
                out[at] = np.where(there, got, 0)
        return out

    def word_counts(self, words: np.ndarray) -> np.ndarray:
        """Count, left neighbours, and followers seen once, twice and more, a row for each word."""
        out = np.zeros((len(words), 5), np.int64)
        for part, at in dealt(word_shard(words, self.model.shards)):
            if arrays := self.arrays("words", part):
                place, there = find(arrays[0], words[at])
                out[at] = np.where(there[:, None], np.stack([x[place].astype(np.int64) for x in arrays[1:]], axis=1), 0)
        return out


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return place, table[place] == keys


def scored(lookup: Lookup, words: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Of each text: tokens, tokens with a count, base score, score."""
    model = lookup.model
    before, word = pairs_of(words)
    sizes = np.array([len(w) + 1 for w in words])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    names, at = np.unique(np.concatenate([word, before]), return_inverse=True)
    facts = lookup.word_counts(names)
    own, context = facts[at[: len(word)]], facts[at[len(word) :]]
    different, same = np.unique(np.stack([at[: len(word)], at[len(word) :]], axis=1) @ [len(names), 1], return_inverse=True)
    count = lookup.pair_counts(names[different % len(names)], names[different // len(names)])[same]
    outcomes = model.distinct + 1
    mass = lambda level, once, twice, more: level.discounts[1] * once + level.discounts[2] * twice + level.discounts[3] * more
    lefts = model.lower.counts[6]
    if lefts:
        share = mass(model.lower, model.lower.counts[0], model.lower.counts[1], model.lower.counts[4]) / lefts
        low = model.lower.kept(own[:, 1]) / lefts + share / outcomes
    else:
        low = np.full(len(word), 1.0 / outcomes)
    total = np.where(before == START, model.texts, context[:, 0])
    with np.errstate(divide="ignore", invalid="ignore"):
        high = model.upper.kept(count) / total + mass(model.upper, *context[:, 2:].T) / total * low
    base = np.log10((own[:, 0] + 0.5) / (model.tokens + 0.5 * outcomes))
    add = lambda x: np.add.reduceat(x, starts)
    return sizes, add((own[:, 0] > 0).astype(np.int64)), add(base), add(np.log10(np.where(total > 0, high, low)))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score: log10 probability, perplexity)."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        lookup = remembered(("ngrams", *model.words.values()), lambda: Lookup(model))
        hasher = WordHasher()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, known, base, total = scored(lookup, hasher.texts(texts(batch.column(1)))) if batch.num_rows else [np.zeros(0)] * 4
            columns = [sizes.astype("i8"), known.astype("i8"), np.full(len(sizes), model.tokens, "i8"), base, total]
            with np.errstate(over="ignore"):
                columns.append(10 ** (-total / np.maximum(sizes, 1)))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns)], [id_column, "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
            )

        return run

    rows = docs.select(F.col(id_column), F.col("text").cast("string").alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    return map_batches(rows, make, f"`{id_column}` {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def op2_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = train(docs.filter(rest("doc_id", 5) != 1))
    out = score(docs, model)
    return out.select("doc_id", (rest("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
