"""Data quality reports. Each report is one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillsight.functions.columns import col
from tillsight.functions.ordering import attach, exact_quantiles


def missing_profile(df: DataFrame, table: str) -> DataFrame:
    """Null count and share (percent, two decimals) of the columns that have nulls."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("missing")) for c in df.columns]
    )
    share = F.round(F.col("missing") * 100.0 / F.col("_rows"), 2)
    return (
        counts.select("_rows", F.inline(cells))
        .filter("missing > 0")
        .select(F.lit(table).alias("table_name"), "column_name", "missing", share.alias("missing_pct"))
    )


def null_total(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All null cells of each table."""
    parts = []
    for name, df in tables.items():
        cells = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns), F.lit(0))
        parts.append(df.agg(cells.cast("long").alias("null_cells")).select(F.lit(name).alias("table_name"), "null_cells"))
    return _union(parts)


def row_counts(before: Mapping[str, DataFrame], after: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table before and after cleaning."""
    parts = []
    for side, tables in (("rows_before", before), ("rows_after", after)):
        for name, df in tables.items():
            n = df.agg(F.count(F.lit(1)).alias("n"))
            parts.append(n.select(F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n"))
    pick = lambda side: F.max(F.when(F.col("side") == side, F.col("n")))
    out = _union(parts).groupBy("table_name").agg(
        pick("rows_before").alias("rows_before"), pick("rows_after").alias("rows_after")
    )
    return out.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def reject_reasons(tagged: DataFrame, reason: str = "rejection_reason") -> DataFrame:
    """Rejected rows by reason, with their share of all rejects and of all rows."""
    by_reason = tagged.groupBy(reason).agg(F.count(F.lit(1)).alias("rows"))
    # The grouped frame holds one row per reason, a handful by construction.
    whole = by_reason.agg(
        F.sum("rows").alias("all_rows"),
        F.sum(F.when(F.col(reason).isNotNull(), F.col("rows"))).alias("rejected"),
    )
    return attach(by_reason.filter(F.col(reason).isNotNull()), whole).select(
        F.col(reason),
        "rows",
        F.round(F.col("rows") * 100.0 / F.col("_k.rejected"), 2).alias("pct_of_rejects"),
        F.round(F.col("rows") * 100.0 / F.col("_k.all_rows"), 2).alias("pct_of_rows"),
    )


def reject_rates(tagged: Mapping[str, DataFrame], reason: str = "rejection_reason") -> DataFrame:
    """Rows, rejects and reject rate of each table."""
    parts = []
    for name, df in tagged.items():
        rows = df.agg(F.count(F.lit(1)).alias("rows"), F.count(F.col(reason)).alias("rejected"))
        rate = F.round(F.try_divide(F.col("rejected") * 100.0, F.col("rows")), 2)
        parts.append(rows.select(F.lit(name).alias("table_name"), "rows", "rejected", rate.alias("reject_pct")))
    return _union(parts)


def iqr_bounds(df: DataFrame, value: str, multiplier: float = 1.5) -> DataFrame:
    """One row: exact quartiles and the outlier fences around them."""
    q = exact_quantiles(df, value, {"q1": 0.25, "q3": 0.75})
    spread = (F.col("q3") - F.col("q1")) * F.lit(float(multiplier))
    return q.select("q1", "q3", (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high"))


def detect_outliers(df: DataFrame, value: str, multiplier: float = 1.5, flag: str = "is_outlier") -> DataFrame:
    """Adds a boolean: strictly outside the fences; false for null values."""
    x = F.col(value).cast("double")
    outside = (x < F.col("_k.low")) | (x > F.col("_k.high"))
    marked = attach(df, iqr_bounds(df, value, multiplier)).withColumn(flag, F.coalesce(outside, F.lit(False)))
    return marked.drop("_k")


# Accepted ranges of a feature row (column, low, high) ---------------
FEATURE_RANGES: list[tuple[str, float | None, float | None]] = [
    ("recency_days", 0, 1000),
    ("frequency_30d", 0, None),
    ("monetary_30d", 0, None),
    ("frequency_60d", 0, None),
    ("monetary_60d", 0, None),
    ("frequency_90d", 0, None),
    ("monetary_90d", 0, None),
    ("avg_order_value", 0, 10000),
    ("total_loyalty_points", 0, None),
    ("num_stores_visited", 1, 15),
]
# End of fixed values ----------------------------------------------------------------


def rule_errors(ranges: Sequence[tuple[str, float | None, float | None]] = FEATURE_RANGES) -> Column:
    """Array with one message per violated range; empty for a valid row."""
    found = []
    for name, low, high in ranges:
        if low is not None:
            found.append(F.when(col(name) < low, F.lit(f"{name} below {low:g}")))
        if high is not None:
            found.append(F.when(col(name) > high, F.lit(f"{name} above {high:g}")))
    return F.array_compact(F.array(*found))


def validate_features(df: DataFrame, ranges=FEATURE_RANGES) -> DataFrame:
    out = df.withColumn("errors", rule_errors(ranges))
    return out.withColumn("is_valid", F.size("errors") == 0)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns that the frame does not have (schema only, no job)."""
    present = set(df.columns)
    return sorted(c for c in required if c not in present)


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def leakage_report(
    train: DataFrame,
    test: DataFrame,
    key: str,
    order: str,
    features: Sequence[str] = (),
    targets: Sequence[str] = (),
) -> DataFrame:
    """One row of guards: time order, shared keys, targets used as features."""
    out = attach(test.agg(F.min(order).alias("first_test")), train.agg(F.max(order).alias("last_train")), "_t")
    return attach(out, key_overlap(train, test, key)).select(
        "_t.last_train",
        "first_test",
        (F.col("_t.last_train") <= F.col("first_test")).alias("in_time_order"),
        "_k.shared_keys",
        F.lit(len(set(features) & set(targets))).cast("long").alias("leaked_targets"),
    )


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Number of distinct keys on both sides (0 means disjoint)."""
    shared = left.select(key).distinct().join(right.select(key), key, "left_semi")
    return shared.agg(F.count(F.lit(1)).alias("shared_keys"))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
