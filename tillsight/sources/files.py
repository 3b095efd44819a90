"""Reading raw files and writing results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillsight.functions.columns import null_tokens_to_null
from tillsight.operators.routing import REASON, rejected
from tillsight.sources.schemas import RAW, feature_groups


def read_raw(spark: SparkSession, folder: str, table: str, fmt: str = "csv") -> DataFrame:
    """One raw table with its fixed schema; no inference pass over the files.

    Numbers are read as text first: placeholder texts become null and only then
    is the column cast, leniently, so one bad cell cannot fail the job.
    """
    target = spark.createDataFrame([], RAW[table]).schema
    if fmt == "parquet":
        return spark.read.parquet(f"{folder}/{table}.parquet")
    text = ", ".join(f"`{f.name}` STRING" for f in target.fields)
    path = f"{folder}/{table}.csv"
    # Quotes inside a field are doubled, and column names must match the schema.
    reader = spark.read.schema(text).options(header=True, escape='"', enforceSchema=False)
    raw = null_tokens_to_null(reader.csv(path))
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in target.fields])


def read_all(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    return {t: read_raw(spark, folder, t, fmt) for t in RAW}


def write_table(df: DataFrame, folder: str, name: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Write (replace) one table; as many files as the plan has partitions."""
    path = f"{folder}/{name}"
    writer = df.write.mode("overwrite").format(fmt).partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.options(header=True, escape='"')
    writer.save(path)
    return path


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Save as a table bucketed and sorted by a key.

    Two tables with the same bucket count, such as sales headers and lines by
    transaction id, are then joined and grouped on the key without a shuffle.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def write_clean(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    return {name: write_table(df, f"{folder}/cleaned", name, fmt) for name, df in tables.items()}


def write_rejects(tagged: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Rejected rows, one folder per reason; a table without rejects has none."""
    return {
        name: write_table(rejected(df), f"{folder}/rejected", name, fmt, [REASON]) for name, df in tagged.items()
    }


def feature_catalogue(df: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """(group, feature, filled) of the features that the frame really has; filled counts
    the rows that hold a value, in one pass over the frame."""
    groups = feature_groups(categories) if categories is not None else feature_groups()
    present = set(df.columns)
    names = [(g, f) for g, features in groups.items() for f in features if f in present]
    cells = [F.struct(F.lit(g).alias("feature_group"), F.lit(f).alias("feature"), F.count(f"`{f}`").alias("filled")) for g, f in names]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
