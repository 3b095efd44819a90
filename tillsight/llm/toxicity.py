"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Method: a lexicon of words and of word beginnings is learned from labelled training
rows by smoothed log odds. Every token is looked up once per worker and turned into flags
(strong or mild entry, second person, capitals, obfuscated spelling); a text's features
are densities of these flags, the share of entries near a second person, and rates of
capitals, digits and punctuation. MLlib's boosted trees score them, and an isotonic
regression turns the trees' margin into a probability.

The training rows are a sample of the labelled rows outside the held-out fold,
``TRAIN_ROWS`` of them, drawn by hash; this bound is a parameter. Lexicons are learned
crosswise on halves of the sample, so no row's features know its own label, and the
calibration uses a quarter of the sample that the trees have not seen. Everything else
works on all rows and whole texts.

Only the text enters a score. Null and empty texts are scored as texts without words.
Rows without a label, or with a null one, teach nothing; if a document has several
labels, each is a training row. Without rows of both labels the score is the share of
toxic rows among the labelled ones, 0 if there are none.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillsight.llm.arrowio import map_batches, remembered, split, texts
from tillsight.llm.language import rest
from tillsight.session import cut_lineage

TRAIN_ROWS = 12_000  # sampled labelled rows
LEXICON = 4_000  # entries with the largest log odds
SUPPORT = 4  # toxic rows that an entry needs
STRONG, MILD = 3.5, 1.5  # log odds of the two kinds of entries
NEAR = 5  # tokens between an entry and a second person
THRESHOLD = 0.7
TREES, DEPTH = 30, 3

# Second persons of English, German, French and Spanish; look-alike characters.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer sie ihnen tu te toi ton ta tes vous votre vos "
    "tú ti tuyo usted ustedes vosotros vuestro".split()
)
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})

EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "@$") + "¿¡«»“”„‘’…"
MARKS = re.compile(r"[\W_]+")
RUNS = re.compile(r"(.)\1{2,}")
IS_STRONG, IS_MILD, IS_PERSON, IS_CAPITAL, IS_HIDDEN, IS_LETTER = 1, 2, 4, 8, 16, 32
STEMS = (4, 5, 6)


def spellings(token: str) -> tuple[str, str]:
    """A token as it is written and as it may be meant: without look-alikes, inner marks and drawn-out letters."""
    low = meant = token.strip(EDGES).lower()
    if not low.isalpha() and any(c.isalpha() for c in low):
        meant = MARKS.sub("", low.translate(LOOKALIKES))
    return low, RUNS.sub(r"\1", meant)


def entries(word: str) -> list[str]:
    """The lexicon keys of a spelling: the word, and its beginnings marked by a star."""
    return [word, *[word[:n] + "*" for n in STEMS if len(word) > n]] if word else []


class Tokens:
    """Flags of tokens under a lexicon {key: log odds}; remembers them."""

    def __init__(self, lexicon: dict[str, float], limit: int = 200_000):
        self.lexicon, self.limit, self.known = lexicon, limit, {}

    def flags(self, words: list[str]) -> np.ndarray:
        found = list(map(self.known.get, words))
        if None in found:
            if len(self.known) > self.limit:
                self.known.clear()
            for i, flag in enumerate(found):
                if flag is None:
                    found[i] = self.known[words[i]] = self.judge(words[i])
        return np.array(found, "u1")

    def judge(self, token: str) -> int:
        low, meant = spellings(token)
        odds = max([self.lexicon.get(k, 0.0) for k in entries(low)], default=0.0)
        if low != meant:
            odds = max([odds, *[self.lexicon.get(k, 0.0) for k in entries(meant)]])
        flags = IS_STRONG if odds >= STRONG else IS_MILD if odds >= MILD else 0
        flags |= IS_PERSON * (low in SECOND_PERSON) | IS_HIDDEN * (low != meant) | IS_LETTER * (len(low) == 1)
        return flags | IS_CAPITAL * (len(low) > 1 and token.isupper())


def spaced(words: list[str], flags: np.ndarray, tokens: Tokens) -> int:
    """Entries whose letters stand apart."""
    single = np.flatnonzero(flags & IS_LETTER)
    if len(single) < 4:
        return 0
    found = 0
    for run in np.split(single, np.flatnonzero(np.diff(single) > 1) + 1):
        if len(run) >= 4:
            found += bool(tokens.judge("".join(words[i] for i in run)) & (IS_STRONG | IS_MILD))
    return found


def features(text: str, tokens: Tokens) -> list[float]:
    words = text.split()
    flags = tokens.flags(words)
    total = len(words) + 1.0
    strong, mild, person, capital, hidden = ((flags & x) > 0 for x in (IS_STRONG, IS_MILD, IS_PERSON, IS_CAPITAL, IS_HIDDEN))
    hits = strong | mild
    apart = spaced(words, flags, tokens)
    near = 0.0
    if hits.any() and person.any():
        around = np.convolve(person.astype(np.int32), np.ones(2 * NEAR + 1, np.int32))[NEAR : NEAR + len(words)]
        near = float((hits & (around > 0)).sum())
    data = np.frombuffer(text.encode(), "u1")
    count = np.bincount(data, minlength=256)
    size = len(data) + 1.0
    digits, capitals, small = count[48:58].sum(), count[65:91].sum(), count[97:123].sum()
    marks = count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum()
    return [
        math.log1p(len(words)),
        (strong.sum() + apart) / total, math.log1p(strong.sum() + apart), mild.sum() / total, math.log1p(mild.sum()),
        near / total, near / (hits.sum() + 1.0), person.sum() / total,
        capitals / (capitals + small + 1.0), capital.sum() / total, (hits & capital).sum() / total,
        count[33] / size, count[63] / size, marks / size, digits / size,
        hidden.sum() / total, ((hits & hidden).sum() + apart) / total,
    ]


def with_features(rows: DataFrame, lexicons: list[dict[str, float]]) -> DataFrame:
    """Adds ``features``; column ``half`` says which of the lexicons a row is measured by."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicons)  # at most LEXICON entries each
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        key = ("toxicity", *(tuple(sorted(x.items())) for x in shared.value))
        judges = remembered(key, lambda: [Tokens(x) for x in shared.value])

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            halves = batch.column("half").to_pylist()
            found = [features(t, judges[h]) for t, h in zip(texts(batch.column("text")), halves)]
            kept = [n for n in batch.schema.names if n != "text"]
            columns = [batch.column(n) for n in kept] + [pa.array(found, pa.list_(pa.float64()))]
            return pa.RecordBatch.from_arrays(columns, [*kept, "features"])

        return run

    out = map_batches(rows, make, f"{kinds}, features array<double>")
    return out.withColumn("features", array_to_vector("features"))


def learn_lexicon(rows: DataFrame) -> dict[str, dict[str, float]]:
    """Log odds of the entries, learned on half 0, on half 1 and on both ("all")."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in split(batch):
                seen: dict[tuple, Counter] = {}
                for half, label, text in zip(*(piece.column(n).to_pylist() for n in ("half", "label", "text"))):
                    keys = {k for w in set(text.split()) for x in set(spellings(w)) for k in entries(x)}
                    seen.setdefault((half, label), Counter()).update(keys)
                for (half, label), found in seen.items():
                    n = len(found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([half] * n, pa.int32()), pa.array([label] * n, pa.int32()), pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                        ["half", "label", "key", "n"],
                    )

    counts = rows.mapInArrow(run, "half int, label int, key string, n long").groupBy("key").agg(
        *[F.sum(F.when((F.col("half") == h) & (F.col("label") == y), F.col("n")).otherwise(0)).alias(f"n{h}{y}") for h in (0, 1) for y in (0, 1)]
    )
    counts = cut_lineage(counts.filter(F.col("n01") + F.col("n11") >= SUPPORT))
    sizes = {(r["half"], r["label"]): r["count"] for r in rows.groupBy("half", "label").count().collect()}
    out = {}
    for name, halves in (("0", [0]), ("1", [1]), ("all", [0, 1])):
        clean, toxic = (sum(sizes.get((h, y), 0) for h in halves) for y in (0, 1))
        a, b = (sum((F.col(f"n{h}{y}") for h in halves), F.lit(0)) for y in (1, 0))
        odds = F.log((a + 0.5) / (toxic + 1.0)) - F.log((b + 0.5) / (clean + 1.0))
        best = counts.select("key", odds.alias("odds"), a.alias("n")).filter((F.col("n") >= SUPPORT) & (F.col("odds") >= MILD))
        best = best.orderBy(F.desc("odds"), "key").limit(LEXICON)
        out[name] = {r["key"]: r["odds"] for r in best.collect()}
    return out


class ToxicityModel:
    """Fitted parts; ``score`` adds a column score."""

    def __init__(self, lexicon: dict[str, float], trees: GBTClassificationModel | None, curve: IsotonicRegressionModel | None, share: float):
        self.lexicon, self.trees, self.curve, self.share = lexicon, trees, curve, share

    def score(self, docs: DataFrame) -> DataFrame:
        """(row: all columns of the document but the text, score: a probability)."""
        kept = [c for c in docs.columns if c != "text"]
        rows = docs.select(F.struct(*kept).alias("row"), F.col("text").cast("string").alias("text"), F.lit(0).alias("half"))
        if self.trees is None:
            return rows.select("row", F.lit(float(self.share)).alias("score"))
        scored = self.curve.transform(margin(self.trees, with_features(rows, [self.lexicon])))
        return scored.select("row", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def margin(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    out = trees.transform(rows)
    return out.withColumn("margin", vector_to_array("rawPrediction")[1]).drop("rawPrediction", "probability", "prediction")


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Fits on labelled rows (doc_id, toxic); the caller leaves the held-out fold out."""
    labelled = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    share = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 30) - 1)) / F.lit(float(1 << 30))
    total = labelled.count()
    chosen = labelled.filter(share * total < rows).select("doc_id", F.col("toxic").cast("int").alias("label"))
    # About TRAIN_ROWS rows of two numbers.
    found = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = found.join(F.broadcast(chosen), "doc_id").withColumn("fold", F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(4)).cast("int"))
    found = cut_lineage(found.withColumn("half", (F.col("fold") >= 2).cast("int")))
    sizes = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
    mean = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return ToxicityModel({}, None, None, mean)
    lexicon = learn_lexicon(found)
    # Each half is measured by the lexicon of the other one.
    measured = cut_lineage(with_features(found, [lexicon["1"], lexicon["0"]]))
    use = measured.filter("fold < 3")
    if use.select("label").distinct().count() < 2 or measured.filter("fold = 3").isEmpty():
        use = measured
    gbt = GBTClassifier(labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7, cacheNodeIds=True, maxMemoryInMB=64)
    trees = gbt.fit(use)
    rest_rows = measured.filter("fold = 3") if use is not measured else measured
    curve = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(
        margin(trees, rest_rows).withColumn("label", F.col("label").cast("double"))
    )
    return ToxicityModel(lexicon["all"], trees, curve, mean)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter(rest("doc_id", 3) != 1)
    model = train(docs, labels)
    return model.score(docs).select("row.doc_id", "score").select(
        "doc_id", (rest("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
