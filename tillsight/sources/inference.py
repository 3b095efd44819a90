"""Raw text tables without a schema: broken rows set aside, types found in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillsight.functions.columns import null_tokens_to_null, strip

RECORD, PROBLEM = "_record", "problem"
SHORT, LONG, QUOTES, OTHER = "too few fields", "too many fields", "unbalanced quotes", "unreadable"


def header_of(spark: SparkSession, path: str) -> list[str]:
    """The column names of a file's first line."""
    return spark.read.options(header=True, escape='"', inferSchema=False).csv(path).columns


def read_checked(spark: SparkSession, path: str, columns: Sequence[str] | None = None, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, broken): all columns as text, placeholders as null; and the lines that do not have
    just these fields, whole, with their problem. Both are plain scans of the same files."""
    columns = list(columns or header_of(spark, path))
    schema = ", ".join(f"`{c}` STRING" for c in [*columns, RECORD])
    lines = spark.read.text(path).filter(F.col("value") != "")
    if header:
        # The first line of every file.
        lines = lines.filter(F.replace("value", F.lit('"'), F.lit("")) != ",".join(columns))
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
    scan = lines.select("value", F.from_csv("value", schema, options).alias("row"))
    bad = F.col(f"row.{RECORD}").isNotNull()
    rows = null_tokens_to_null(scan.filter(~bad).select(*[F.col(f"row.`{c}`") for c in columns]))
    broken = scan.filter(bad)
    return rows, broken.select(F.col("value").alias("record"), problem_of(F.col("value"), len(columns)).alias(PROBLEM))


def problem_of(record: Column, width: int) -> Column:
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))
    # Separators inside quotes are text.
    fields = F.size(F.split(F.regexp_replace(record, '"[^"]*"', ""), ",", -1))
    return F.when(quotes % 2 == 1, QUOTES).when(fields < width, SHORT).when(fields > width, LONG).otherwise(OTHER)


def infer_types(rows: DataFrame) -> dict[str, str]:
    """The narrowest type that holds every value of each text column: int, bigint, double or string.

    Whole numbers with gaps are doubles, and numbers with leading zeros are names, as is a column without values.
    One pass for all columns; one row reaches the driver.
    """
    out = []
    for i, c in enumerate(rows.columns):
        text = strip(F.col(f"`{c}`"))
        number = text.try_cast("double")
        whole = text.rlike(r"^[+-]?(0|[1-9][0-9]{0,17})$")
        plain = number.isNotNull() & text.rlike(r"^[+-]?(0|[1-9][0-9]*)?(\.[0-9]*)?([eE][+-]?[0-9]+)?$")
        out += [
            F.count(text).alias(f"n{i}"), F.count_if(text.isNull()).alias(f"null{i}"), F.count_if(whole).alias(f"whole{i}"),
            F.count_if(plain).alias(f"number{i}"), F.max(F.when(whole, F.abs(text.try_cast("bigint")))).alias(f"most{i}"),
        ]
    found = rows.agg(*out).first()

    def kind(i: int) -> str:
        n = found[f"n{i}"]
        if not n or found[f"number{i}"] < n:
            return "string"
        if found[f"whole{i}"] < n or found[f"null{i}"]:
            return "double"
        return "int" if found[f"most{i}"] < 1 << 31 else "bigint"

    return {c: kind(i) for i, c in enumerate(rows.columns)}


def typed(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    return rows.select(*[strip(F.col(f"`{c}`")).cast(t).alias(c) if t != "string" else F.col(f"`{c}`") for c, t in types.items()])


def read_inferred(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(typed rows, broken lines) of a text table of unknown types."""
    rows, broken = read_checked(spark, path)
    return typed(rows, infer_types(rows)), broken
