"""Language identification by prediction by partial matching.

Method: each language has a variable-order context tree of bytes, up to three bytes of
context. In a context seen n times with q different next bytes, a byte seen c times costs
-log2(c / (n + q)) bits, and an unseen one costs the escape -log2(q / (n + q)) plus its
cost in the context that is one byte shorter; below the empty context all bytes cost 8
bits. The statistics are frozen after training, so the exact cost of every byte string
that any language has seen is looked up in one table per order that holds all languages;
other strings pay escapes down to an order that knows them. A text's code length is the
sum over all its bytes, and the language with the shortest one is predicted; ``score`` is
its probability under equal priors.

The trees are fitted on a sample of labelled rows, ``TRAIN_ROWS`` for each language,
drawn by hash; this bound is a parameter. The n-grams of the sample are counted in Spark.

Null texts and texts without a letter are ``und`` with score 0, and so is everything
if no language was learned. Rows with null language are no training rows, a null id
counts as the empty one in the fold rule; equal code lengths give the language that sorts
first. Repeated rows are predicted as often as they occur.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillsight.llm.arrowio import map_batches, split
from tillsight.llm.sized import small
from tillsight.session import cut_lineage

CONTEXT = 3  # bytes of context of the longest order
TRAIN_ROWS = 1500  # sampled rows for each language
UNKNOWN = "und"
STEP = 1 << 19  # bytes that are scored at once
LETTER = re.compile(r"[^\W\d_]")  # letters, and some numerals such as fractions


def has_letter(text: str) -> bool:
    return any(found[0].isalpha() for found in LETTER.finditer(text))


@dataclass
class Trees:
    """Costs in bits. Of order k: sorted grams of k + 1 bytes with a cost for each language,
    and sorted contexts of k bytes with the cost of escaping from them."""

    languages: list[str]
    grams: list[np.ndarray]
    costs: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]


def grams_of(text: bytes, order: int) -> np.ndarray:
    """The last order + 1 bytes at each position, as one number; line ends stand in front."""
    data = np.frombuffer(b"\n" * order + text, dtype="u1").astype(np.uint32)
    size = len(data) - order
    key = np.zeros(size, dtype=np.uint32)
    for i in range(order + 1):
        key = (key << np.uint32(8)) | data[i : i + size]
    return key


def fold(text: str) -> bytes:
    return text.encode().lower()


def rest(id_column: str, folds: int) -> F.Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % folds


def count_grams(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) of the longest grams, summed in each batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in split(batch):
                found: dict[str, list[np.ndarray]] = {}
                for text, lang in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    found.setdefault(lang, []).append(grams_of(fold(text), CONTEXT))
                for lang, keys in found.items():
                    grams, n = np.unique(np.concatenate(keys), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype("i8")), pa.array(n.astype("i8"))],
                        ["lang", "gram", "n"],
                    )

    return labelled.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def sample(docs: DataFrame, per_language: int) -> DataFrame:
    """About so many rows of each language, drawn by a hash of the row."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # One row per language: texts are never shuffled to meet it.
    sizes = small(cut_lineage(rows.groupBy("lang").count()))
    share = F.xxhash64("text", "key").bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))
    return rows.join(sizes, "lang").filter(share * F.col("count") < per_language).select("text", "lang")


def train(docs: DataFrame, per_language: int = TRAIN_ROWS) -> Trees:
    """Fits the trees on rows (key, text, lang). The counts that reach the driver are those
    of the bounded sample."""
    table = count_grams(sample(docs, per_language)).toArrow()
    names = np.array(table["lang"].to_pylist(), dtype=object)
    languages = sorted(set(names))
    keys, at = np.unique(table["gram"].to_numpy().astype(np.uint32), return_inverse=True)
    counts = np.zeros((len(keys), len(languages)))
    counts[at, [languages.index(x) for x in names]] = table["n"].to_numpy()
    levels = []
    for order in range(CONTEXT, -1, -1):
        levels.append((keys, counts))
        keys, counts = grouped(keys & np.uint32((1 << (8 * order)) - 1), counts)
    trees = Trees(languages, [], [], [], [])
    for order, (keys, counts) in enumerate(reversed(levels)):
        contexts, totals = grouped(keys >> np.uint32(8), counts)
        _, kinds = grouped(keys >> np.uint32(8), (counts > 0).astype(float))
        place = np.searchsorted(contexts, keys >> np.uint32(8))
        with np.errstate(divide="ignore", invalid="ignore"):
            escapes = np.where(totals > 0, np.log2((totals + kinds) / kinds), 0.0)
            seen = np.log2((totals + kinds)[place] / counts)
        if order:
            below = trees.costs[-1][np.searchsorted(trees.grams[-1], keys & np.uint32((1 << (8 * order)) - 1))]
        else:
            below = np.full(counts.shape, 8.0)
        trees.grams.append(keys)
        trees.costs.append(np.where(counts > 0, seen, escapes[place] + below))
        trees.contexts.append(contexts)
        trees.escapes.append(escapes)
    return trees


def grouped(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    sums = np.zeros((len(found), values.shape[1]))
    np.add.at(sums, at, values)
    return found, sums


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys in a sorted table, and which of them are there."""
    if not len(table):
        return np.zeros(len(keys), np.intp), np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return place, table[place] == keys


def costs(trees: Trees, keys: np.ndarray, order: int = CONTEXT) -> np.ndarray:
    """Bits of each gram's last byte in each language."""
    place, known = find(trees.grams[order], keys)
    out = trees.costs[order][place]
    missing = ~known
    if missing.any():
        lost = keys[missing]
        if order:
            below = costs(trees, lost & np.uint32((1 << (8 * order)) - 1), order - 1)
        else:
            below = np.full((len(lost), len(trees.languages)), 8.0)
        place, known = find(trees.contexts[order], lost >> np.uint32(8))
        out[missing] = below + np.where(known[:, None], trees.escapes[order][place], 0.0)
    return out


def code_lengths(trees: Trees, texts: list[bytes]) -> np.ndarray:
    """Bits of each text in each language; long texts are scored piece by piece."""
    out = np.zeros((len(texts), len(trees.languages)))
    waiting: list[np.ndarray] = []
    owners: list[int] = []

    def settle() -> None:
        sizes = [len(x) for x in waiting]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.intp)
        out_rows = np.add.reduceat(costs(trees, np.concatenate(waiting)), starts, axis=0)
        np.add.at(out, owners, out_rows)
        waiting.clear()
        owners.clear()

    size = 0
    for i, text in enumerate(texts):
        for start in range(0, len(text), STEP):
            before = text[max(0, start - CONTEXT) : start]
            keys = grams_of(before + text[start : start + STEP], CONTEXT)[len(before) :]
            waiting.append(keys)
            owners.append(i)
            size += len(keys)
            if size >= STEP:
                settle()
                size = 0
    if waiting:
        settle()
    return out


def predict(docs: DataFrame, trees: Trees, id_column: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score, bits: code length in the predicted language)."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)  # bounded by the training sample

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        model = shared.value

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t if t and model.languages and has_letter(t) else "" for t in batch.column(1).to_pylist()]
            bits = code_lengths(model, [fold(t) for t in texts])
            best = bits.argmin(axis=1) if model.languages else [0] * len(texts)
            names, scores, lengths = [], [], []
            for text, row, k in zip(texts, bits, best):
                names.append(model.languages[k] if text else UNKNOWN)
                scores.append(float(1 / np.exp2(np.maximum(row[k] - row, -1000)).sum()) if text else 0.0)
                lengths.append(float(row[k]) if text else 0.0)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(lengths, pa.float64())],
                [id_column, "lang_pred", "score", "bits"],
            )

        return run

    rows = docs.select(F.col(id_column), F.col("text").cast("string").alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    return map_batches(rows, make, f"`{id_column}` {kind}, lang_pred string, score double, bits double")


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    learn = docs.filter(rest("doc_id", 5) != 0).select(F.col("doc_id").alias("key"), "text", "lang")
    out = predict(docs, train(learn))
    return out.select("doc_id", (rest("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
