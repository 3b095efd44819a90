"""Temporal and random splits, time-series folds, oversampling.

A temporal split needs only the row at each cut, not a sorted table: the cut rows
come from exact rank selection and every row is then compared with them. Rows
with equal time are ordered by the hash of the key (see ``tie_break``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tillsight.functions.columns import col
from tillsight.functions.ordering import Rank, attach, order_statistics, tie_break, time_then_key_levels
from tillsight.session import cut_lineage

KEY = "customer_id"


def sort_mark(ts: str, key: str) -> Column:
    return F.struct(F.col(ts).alias("t"), tie_break(key).alias("m"))


def with_cuts(df: DataFrame, ts: str, key: str, ranks: Mapping[str, Rank]) -> DataFrame:
    """Adds a struct ``_k`` with the sort marks at the given ranks (null if no such row).

    The frame is written once: the search reads two of its columns several times.
    """
    df = cut_lineage(df)
    found = order_statistics(df, time_then_key_levels(ts, key), ranks)
    at = lambda name: F.max(F.when(F.col("rank_name") == name, F.col("value"))).alias(name)
    return attach(df, found.agg(*[at(name) for name in ranks]))


def share_rank(share: float) -> Rank:
    """Rank of the last row of the leading share: int(share * n) rows go first."""
    return lambda n: F.floor(F.lit(float(share)) * n) - 1


def temporal_split(df: DataFrame, ts: str = "last_purchase", key: str = KEY, share: float = 0.8) -> DataFrame:
    """Adds ``split``: the earliest int(share * n) rows are train, the rest test."""
    out = with_cuts(df, ts, key, {"cut": share_rank(share)})
    early = F.coalesce(sort_mark(ts, key) <= F.col("_k.cut"), F.lit(False))
    return out.withColumn("split", F.when(early, "train").otherwise("test")).drop("_k")


def validation_tail(df: DataFrame, ts: str = "last_purchase", key: str = KEY, share: float = 0.15) -> DataFrame:
    """Adds boolean ``is_validation`` for the latest share of the rows."""
    out = with_cuts(df, ts, key, {"cut": share_rank(1 - share)})
    late = ~F.coalesce(sort_mark(ts, key) <= F.col("_k.cut"), F.lit(False))
    return out.withColumn("is_validation", late).drop("_k")


def seeded(key: str, seed: int) -> Column:
    """Hexadecimal digits that look random, from the key and a seed."""
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def random_split(df: DataFrame, key: str = KEY, share: float = 0.8, seed: int = 42) -> DataFrame:
    """Split by a hash of key and seed: the same rows on every run, layout and engine."""
    place = F.conv(F.substring(seeded(key, seed), 1, 8), 16, 10).cast("long") % 10_000
    return df.withColumn("split", F.when(place < int(share * 10_000), "train").otherwise("test"))


def time_slices(df: DataFrame, ts: str = "last_purchase", key: str = KEY, folds: int = 5) -> DataFrame:
    """Adds ``slice``: 0 before all tests, i + 1 for the rows that fold i tests. Each
    of the last ``folds`` slices has n // (folds + 1) of the n rows."""
    size = lambda n: F.floor(n / (folds + 1))
    ranks = {f"b{i}": (lambda n, i=i: n - (folds - i) * size(n) - 1) for i in range(folds)}
    mark = F.col("_mark")
    slice_no = sum((F.when(mark <= F.col(f"_k.b{i}"), 0).otherwise(1) for i in range(folds)), F.lit(0))
    placed = with_cuts(df, ts, key, ranks).withColumn("_mark", sort_mark(ts, key))
    return placed.withColumn("slice", slice_no).drop("_mark", "_k")


def time_series_folds(df: DataFrame, ts: str = "last_purchase", key: str = KEY, folds: int = 5) -> DataFrame:
    """One copy of a row per fold it takes part in, with ``fold`` and ``role``: fold i
    tests its own slice and trains on everything before it."""
    placed = time_slices(df, ts, key, folds)
    out = placed.withColumn("fold", F.explode(F.sequence(F.greatest(F.col("slice") - 1, F.lit(0)), F.lit(folds - 1))))
    role = F.when(F.col("slice") == F.col("fold") + 1, "test").otherwise("train")
    return out.withColumn("role", role).drop("slice")


def oversample(df: DataFrame, target: str = "future_spend_30d", extra: int = 3) -> DataFrame:
    """Each spender ``extra`` more times; ``copy`` numbers the copies from 0."""
    copies = F.when(F.col(target) > 0, extra).otherwise(0)
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), copies)))


def spender_weight(target: str = "future_spend_30d", extra: int = 3) -> Column:
    """The same emphasis as a weight column, without copying rows."""
    return F.when(col(target) > 0, float(1 + extra)).otherwise(1.0)


def is_active(days: int = 60) -> Column:
    return F.col("recency_days") <= days


def active_only(df: DataFrame, days: int = 60) -> DataFrame:
    return df.filter(is_active(days))


def spenders_only(df: DataFrame, target: str = "future_spend_30d") -> DataFrame:
    return df.filter(F.col(target) > 0)


def split_summary(df: DataFrame, ts: str = "last_purchase", target: str = "future_spend_30d") -> DataFrame:
    """Rows, time range and spender share of each split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(ts).alias("first_purchase_in_split"),
        F.max(ts).alias("last_purchase_in_split"),
        F.avg((F.col(target) > 0).cast("double")).alias("spender_share"),
    )


def stable_sample(df: DataFrame, n: int = 5, key: str = KEY, seed: int = 42) -> DataFrame:
    """n pseudo-random rows, the same on every run and engine."""
    return df.orderBy(seeded(key, seed), key).limit(n)


def top_spenders(scored: DataFrame, n: int = 10, score: str = "predicted_spend_30d", key: str = KEY) -> DataFrame:
    return scored.orderBy(F.desc(score), key).limit(n)


def lookup(df: DataFrame, value, key: str = KEY) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))
