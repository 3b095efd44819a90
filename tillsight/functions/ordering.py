"""Exact order statistics and running sums over data of any size.

Sorting a whole table into one window, or keeping every distinct value in one
aggregation buffer, ends in a single task. Here the sort key is split into
*levels*, coarse to exact (for example day, second, timestamp). A level is any
orderable column; levels must be non-decreasing in the key. Each step counts one
level with map-side partial aggregation, which folds hot values into one row per
task, and goes on only inside the bucket that holds the wanted rank. What a
window sees is a histogram, never the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillsight.functions.columns import col
from tillsight.session import cut_lineage

Rank = Callable[[Column], Column]


def numeric_levels(c: Column | str) -> list[Column]:
    """Three levels for any number: 0.14 % wide, 4e-8 wide, exact.

    Buckets follow the sign and the binary logarithm, so they separate values of all
    magnitudes alike, tiny ones as well as huge ones, and no minimum or maximum has to be
    known. Infinities and NaN (the largest value) have buckets of their own.
    """
    c = col(c)
    x = c.cast("double")

    def bucket(steps: int) -> Column:
        # The smallest positive double is 2 ** -1074: the offset keeps all buckets positive.
        place = F.floor(F.log2(F.abs(x)) * steps) + 2000 * steps
        place = F.when(F.abs(x) == float("inf"), F.lit(1 << 61)).otherwise(place)
        signed = F.when(F.isnan(x), F.lit(1 << 62)).when(x < 0, -place).otherwise(place)
        # Null values are dropped by the last level. The buckets are declared non-null,
        # or Spark would compute them once more in a filter below every join.
        return F.coalesce(F.when(x == 0, F.lit(0)).otherwise(signed), F.lit(0))

    return [bucket(1 << 9), bucket(1 << 24), c]


def timestamp_levels(c: Column | str) -> list[Column]:
    c = col(c)
    return [F.to_date(c), F.date_trunc("second", c), c]


def tie_break(key: Column | str) -> Column:
    """Uniform, engine-independent order among rows with equal sort value."""
    return F.md5(col(key).cast("string"))


def time_then_key_levels(ts: Column | str, key: Column | str) -> list[Column]:
    """Order by time, ties by the hashed key: no day or second can be too hot,
    because the first four hash digits cut it into 65,536 even parts."""
    ts, mark = col(ts), tie_break(key)
    return [
        F.to_date(ts),
        F.date_trunc("second", ts),
        F.struct(ts.alias("t"), F.substring(mark, 1, 4).alias("m")),
        F.struct(ts.alias("t"), mark.alias("m")),
    ]


def order_statistics(
    df: DataFrame,
    levels: Sequence[Column],
    ranks: Mapping[str, Rank],
    by: Sequence[str] = (),
) -> DataFrame:
    """The exact values at given 0-based ranks, per group.

    ``ranks`` maps a name to a function of the group's row count. Result:
    ``by..., rank_name, row_count, value``, at most one row per group and name
    (none where the rank is outside the group). Rows whose last level is null
    are ignored, as are null groups.
    """
    by, labels = list(by), list(ranks)
    names = [f"_level{i}" for i in range(len(levels))]
    base = df.select(*by, *[c.alias(n) for c, n in zip(levels, names)])
    for c in [*by, names[-1]]:
        base = base.filter(F.col(c).isNotNull())

    # The first level counts everything, once for all ranks.
    level = names[0]
    group = Window.partitionBy(*by)
    counts = base.groupBy(*by, level).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_size", F.sum("_n").over(group)).withColumn("_upto", _running(group, level))
    wanted = F.array(
        *[
            F.struct(F.lit(i).alias("_id"), ranks[name](F.col("_size")).cast("long").alias("_rank"))
            for i, name in enumerate(labels)
        ]
    )
    rows = counts.withColumn("_w", F.explode(wanted)).select("*", "_w._id", "_w._rank")
    targets = _hit(rows, [*by, level, "_id", "_size"])

    # Later levels count the rows of the buckets that hold a rank, once per rank.
    for depth, level in enumerate(names[1:], 1):
        upper = names[:depth]
        # Without groups there is one target per rank: a proven size, so broadcast.
        # With groups the size is unknown and left to the adaptive planner.
        inside = base.join(targets if by else F.broadcast(targets), [*by, *upper])
        counts = inside.groupBy(*by, "_id", "_size", "_rank", *upper, level).agg(F.count(F.lit(1)).alias("_n"))
        counts = counts.withColumn("_upto", _running(Window.partitionBy(*by, "_id"), level))
        targets = _hit(counts, [*by, *upper, level, "_id", "_size"])
    name_of = F.get(F.array(*[F.lit(n) for n in labels]), F.col("_id"))
    return targets.select(
        *by, name_of.alias("rank_name"), F.col("_size").alias("row_count"), F.col(names[-1]).alias("value")
    )


def _running(group, level: str) -> Column:
    return F.sum("_n").over(group.orderBy(level).rowsBetween(Window.unboundedPreceding, 0))


def _hit(counts: DataFrame, keep: list[str]) -> DataFrame:
    """Buckets that hold their rank, and the rank counted from the bucket's start."""
    before = F.col("_upto") - F.col("_n")
    hit = counts.filter((F.col("_rank") >= before) & (F.col("_rank") < F.col("_upto")))
    return hit.select(*keep, (F.col("_rank") - before).alias("_rank"))


def exact_quantiles(
    df: DataFrame,
    value: Column | str,
    quantiles: Mapping[str, float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Linearly interpolated quantiles as one row per group: ``by..., <names>``.

    Without groups there is always exactly one row (nulls for no data).
    """
    ranks: dict[str, Rank] = {}
    for name, q in quantiles.items():
        ranks[f"{name}/low"] = lambda n, q=q: F.floor(F.lit(float(q)) * (n - 1))
        ranks[f"{name}/high"] = lambda n, q=q: F.ceil(F.lit(float(q)) * (n - 1))
    found = order_statistics(df, numeric_levels(value), ranks, by)

    def at(name):
        return F.max(F.when(F.col("rank_name") == name, F.col("value").cast("double")))

    def between(name, q):
        place = F.lit(float(q)) * (F.max("row_count") - 1)
        low, high = at(f"{name}/low"), at(f"{name}/high")
        return (low + (high - low) * (place - F.floor(place))).alias(name)

    out = [between(name, q) for name, q in quantiles.items()]
    return found.groupBy(*by).agg(*out) if by else found.agg(*out)


def exact_median(df: DataFrame, value: Column | str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    return exact_quantiles(df, value, {name: 0.5}, by)


def attach(df: DataFrame, one_row: DataFrame, name: str = "_k") -> DataFrame:
    """Add the columns of a one-row frame as one struct column.

    It is a scalar subquery: Spark computes the row once and plugs it in; there
    is no join. Read the parts as ``<name>.<column>``. One struct per frame keeps
    the plan small, where a subquery per value would be planned again each time.
    """
    row = one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns]).alias("row"))
    return df.withColumn(name, row.scalar())


def running_sums(
    df: DataFrame,
    levels: Sequence[Column],
    measures: Mapping[str, Column],
) -> DataFrame:
    """For every distinct key: its own sums and the sums of all smaller keys.

    ``measures`` maps names to columns to sum. Result: ``value`` (the last
    level), ``<name>`` and ``<name>_before``. The prefix of a key is the prefix
    of its coarse bucket plus the prefix inside it, so each window covers one
    bucket of one level only.
    """
    names = [f"_level{i}" for i in range(len(levels))]
    base = df.select(
        *[c.alias(n) for c, n in zip(levels, names)],
        *[c.alias(m) for m, c in measures.items()],
    ).filter(F.col(names[-1]).isNotNull())
    exact = base.groupBy(*names).agg(*[F.sum(m).alias(m) for m in measures])

    def level(depth: int) -> DataFrame:
        """Sums per key of this level, and the prefix inside the next coarser key."""
        keys = names[: depth + 1]
        sums = exact
        if depth < len(names) - 1:
            sums = exact.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
        inside = Window.partitionBy(*names[:depth]).orderBy(names[depth])
        inside = inside.rowsBetween(Window.unboundedPreceding, -1)
        return sums.select("*", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"{m}_before") for m in measures])

    # From coarse to fine. The finer frame is already partitioned by the join keys,
    # because its window was, so only the coarser (smaller) frame moves.
    out = level(0)
    for depth in range(1, len(names)):
        coarser = out.select(*names[:depth], *[F.col(f"{m}_before").alias(f"_{m}") for m in measures])
        finer = level(depth).join(coarser, names[:depth])
        out = finer.withColumns({f"{m}_before": F.col(f"{m}_before") + F.col(f"_{m}") for m in measures})
    return out.select(F.col(names[-1]).alias("value"), *measures, *[f"{m}_before" for m in measures])


def positions(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds the 0-based ``position`` of every row in the order of unique keys.

    The rows are range-partitioned, so each partition holds one stretch of the
    order, and written down, so a lost task cannot draw other boundaries. The
    offsets are one row per partition: a proven size, so they are broadcast.
    """
    order = list(order)
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    placed = cut_lineage(ranged)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    out = placed.withColumn("_row", inside).join(F.broadcast(offsets), "_part")
    return out.withColumn("position", F.col("_before") + F.col("_row") - 1).drop("_part", "_row", "_before")
