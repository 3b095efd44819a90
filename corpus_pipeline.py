"""A corpus made ready for training, in five stages over the whole table of documents.

Each stage gets what its predecessor kept, as a table, and returns the columns of
documents (the last one returns the encoded documents):

1. toxicity: rows scored 0.7 or more go;
2. near duplicates: of each component the row with the smallest id stays;
3. decontamination: rows that hold a window of a benchmark item go;
4. personal data: every span is replaced by its kind in brackets, n_chars follows;
5. pieces: the ids of each text and the text that they decode to, as digests.

Rows that repeat id and text are one row after stage 2. Nulls, empty texts and empty
tables are handled as the operators say; rows without words pass stages 1 to 4.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillsight.llm.contamination import contamination
from tillsight.llm.near_duplicates import near_duplicates
from tillsight.llm.pieces import digests, encode_decode
from tillsight.llm.private_data import FOUND, KINDS, find_private
from tillsight.llm.toxicity import THRESHOLD, train
from tillsight.session import cut_lineage, owned_frames

# The stages learn, so no SQL gives these rows; tests hold near duplicates and personal data against
# brute force, and the numbers of rows of the others.
ORACLE_SQL = None


def version() -> Column:
    """Tells the texts under one id apart; the operators use the same hash."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def matching(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of docs with (or without) their (doc_id, version) among the keys."""
    keys = keys.select(F.col("doc_id").alias("__id"), F.col("version").alias("__version"))
    same = F.col("__doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__version"))
    rows = docs.withColumns({"__doc_id": F.col("doc_id").cast("long"), "__text": version()})
    return rows.join(keys, same, how)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # The whole row travels in one column, so that its names meet no others.
    scored = model.score(docs.select(F.struct(*docs.columns).alias("document"), "text"))
    return scored.filter(F.col("score") < THRESHOLD).select("row.document.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = cut_lineage(near_duplicates(docs))
    # Among rows of one id the smallest version stands for the component; rows without words stand alone.
    named = found.filter("kept AND n_shingles > 0").groupBy("component_id").agg(F.min("version").alias("version"))
    named = named.select(F.col("component_id").alias("doc_id"), "version")
    keys = named.union(found.filter("n_shingles = 0").select("doc_id", "version").distinct())
    kept = matching(docs, keys, "left_semi").dropDuplicates(["__doc_id", "__text"])
    return kept.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    keys = cut_lineage(found.filter("n_hit > 0").select("doc_id", "version").distinct())
    return matching(docs, keys, "left_anti").select(*docs.columns)


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind; of overlapping spans the first one counts."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["at"]
        before = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.concat(acc["out"], before, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.when(new, out).otherwise(acc["out"]).alias("out"), F.greatest(F.when(new, s["end"]).otherwise(acc["at"]), acc["at"]).alias("at"))

    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def redact_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = find_private(docs)

    def tagged(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    spans = F.array_sort(F.concat(*map(tagged, (*KINDS, FOUND))))
    found = found.select(F.col("doc_id").alias("__id"), F.col("version").alias("__version"), spans.alias("__spans"))
    found = cut_lineage(found.filter(F.size("__spans") > 0).dropDuplicates(["__id", "__version"]))
    rows = docs.withColumns({"__doc_id": F.col("doc_id"), "__text": version()})
    same = F.col("__doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__version"))
    rows = rows.join(found, same, "left")
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(redacted(F.col("text"), F.col("__spans")))
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(size))
    return rows.select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("private_data", redact_private),
    ("pieces", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        # Only the stage's result outlives it.
        with owned_frames(spark):
            docs = cut_lineage(stage(spark, docs, sf_dir), kept=True)
    return docs
