"""Customer measures kept up to date: new days are folded into a state, history is not read again.

The state has one row per customer: exact sums over all days that are older than ``keep`` days, and the
days since then one by one (purchases, amounts, first and last purchase). Counts, sums, extremes
and the gaps between purchases follow from both, for any cutoff up to the last folded day.
Rows may come in any order as long as they are not older than the days that the state keeps apart;
older ones are not folded but handed back. Folding in any number of steps gives the
same state as folding all at once.

The rows of a customer are folded to days before they are moved, so a customer with a third of all
rows sends a few rows per task, and a state row never holds more than ``keep`` days and those of one fold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tillsight.functions.columns import as_ntz, days_between
from tillsight.operators.customer import KEY, TS, gap_mean, gap_std
from tillsight.operators.periods import FeatureSpec
from tillsight.session import cut_lineage

KEEP = 365  # days that are kept one by one


def _daily(rows: DataFrame, amount: str) -> DataFrame:
    """One row per customer and day. Squares of decimals stay exact."""
    kind = rows.schema[amount].dataType
    square = F.col(amount) * F.col(amount)
    wide = isinstance(kind, T.DecimalType)
    total = lambda c, digits: F.sum(c.cast(f"decimal(38,{digits})") if wide else c)
    digits = kind.scale if wide else 0
    return rows.groupBy(KEY, F.to_date(TS).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count(amount).alias("amounts"), total(F.col(amount), digits).alias("amount"),
        total(square, 2 * digits).alias("squares"), F.min(amount).alias("low"), F.max(amount).alias("high"),
        F.min(TS).alias("first"), F.max(TS).alias("last"), F.lit(0).cast("long").alias("gap_sum"), F.lit(0).cast("long").alias("gap_squares"),
    )


DAY = ("day", "n", "amounts", "amount", "squares", "low", "high", "first", "last")


def _cells(state: DataFrame) -> DataFrame:
    """The state as rows: the sums of older days under a null day, and each kept day."""
    days = state.select(KEY, F.explode("days").alias("d")).select(KEY, *[F.col(f"d.{c}").alias(c) for c in DAY])
    days = days.withColumns({c: F.lit(0).cast("long") for c in ("gap_sum", "gap_squares")})
    old = state.filter("old.n > 0").select(KEY, F.lit(None).cast("date").alias("day"), "old.*")
    return days.unionByName(old)


def fold(state: DataFrame | None, rows: DataFrame, until: str, keep: int = KEEP, amount: str = "total_amount") -> tuple[DataFrame, DataFrame]:
    """(state, late): the state with the rows before the day ``until``, which becomes its last day,
    and the rows that are older than the days it kept apart."""
    rows = rows.filter(F.col(KEY).isNotNull() & (F.col(TS) < as_ntz(until)))
    late = rows.limit(0)
    if state is not None:
        edge = state.agg(F.max("since")).first()[0]
        if edge is not None:
            late, rows = rows.filter(F.to_date(TS) < F.lit(edge)), rows.filter(F.to_date(TS) >= F.lit(edge))
    cells = _daily(rows, amount)
    if state is not None:
        cells = cells.unionByName(_cells(state))
    # One shuffle: days, gaps and customers all follow the customer.
    cells = cells.repartition(KEY).groupBy(KEY, "day").agg(
        *[F.sum(c).cast(cells.schema[c].dataType).alias(c) for c in ("n", "amounts", "amount", "squares", "gap_sum", "gap_squares")],
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("first").alias("first"), F.max("last").alias("last"),
    )
    before = F.lag("last").over(Window.partitionBy(KEY).orderBy(F.asc_nulls_first("day")))
    cells = cells.withColumn("gap", F.coalesce(days_between(F.col("first"), before), F.lit(0)))
    since = F.date_sub(F.lit(until).cast("date"), keep)
    old = F.col("day").isNull() | (F.col("day") < since)
    # The gap of the null day is a customer's first purchase, so none.
    gap = F.when(F.col("day").isNull(), 0).otherwise(F.col("gap"))
    out = cells.groupBy(KEY).agg(
        F.struct(
            F.coalesce(F.sum(F.when(old, F.col("n"))), F.lit(0)).cast("long").alias("n"),
            F.coalesce(F.sum(F.when(old, F.col("amounts"))), F.lit(0)).cast("long").alias("amounts"),
            *[F.sum(F.when(old, F.col(c))).cast(cells.schema[c].dataType).alias(c) for c in ("amount", "squares")],
            F.min(F.when(old, F.col("low"))).alias("low"), F.max(F.when(old, F.col("high"))).alias("high"),
            F.min(F.when(old, F.col("first"))).alias("first"), F.max(F.when(old, F.col("last"))).alias("last"),
            F.coalesce(F.sum(F.when(old, F.col("gap_sum") + gap)), F.lit(0)).cast("long").alias("gap_sum"),
            F.coalesce(F.sum(F.when(old, F.col("gap_squares") + gap * gap)), F.lit(0)).cast("long").alias("gap_squares"),
        ).alias("old"),
        F.array_sort(F.collect_list(F.when(~old, F.struct(*DAY)))).alias("days"),
        F.first(since).alias("since"),
    )
    return cut_lineage(out), late


def state_measures(state: DataFrame, spec: FeatureSpec, order_values: bool = True) -> DataFrame:
    """Lifetime and look-back measures and the purchase cadence of every customer at a midnight
    cutoff, up to the last folded day and no earlier than the kept days allow."""
    cutoff = F.to_date(spec.at)
    inside = F.filter("days", lambda d: d["day"] < cutoff)
    base = state.withColumn("days", inside).filter((F.col("old.n") > 0) | (F.size("days") > 0))

    kind = base.schema["old"].dataType["amount"].dataType

    def total(days: Column, start: Column) -> Column:
        return F.aggregate(days, start.cast(kind), lambda acc, d: (acc + F.coalesce(d["amount"], F.lit(0).cast(kind))).cast(kind))

    def of(field: str, days: Column, start: Column) -> Column:
        return F.aggregate(days, start, lambda acc, d: acc + d[field])

    square = base.schema["old"].dataType["squares"].dataType
    squares = F.aggregate("days", F.coalesce("old.squares", F.lit(0)).cast(square), lambda acc, d: (acc + F.coalesce(d["squares"], F.lit(0).cast(square))).cast(square))
    last = F.coalesce(F.get(F.col("days"), F.size("days") - 1)["last"], F.col("old.last"))
    first = F.coalesce("old.first", F.get(F.col("days"), F.lit(0))["first"])
    step = lambda acc, d: F.struct(
        d["last"].alias("last"),
        (acc["s"] + _gap(d, acc)).alias("s"), (acc["q"] + _gap(d, acc) * _gap(d, acc)).alias("q"),
    )
    gaps = F.aggregate("days", F.struct(F.col("old.last").alias("last"), F.col("old.gap_sum").alias("s"), F.col("old.gap_squares").alias("q")), step)
    base = base.withColumns({
        "frequency_total": of("n", F.col("days"), F.col("old.n")), "_amounts": of("amounts", F.col("days"), F.col("old.amounts")),
        "_sum": total(F.col("days"), F.coalesce("old.amount", F.lit(0))), "_squares": squares,
        "first_purchase_date": first, "last_purchase": last, "_gaps": gaps,
        "max_order_value": F.greatest("old.high", F.array_max(F.transform("days", lambda d: d["high"]))).cast("double"),
        "min_order_value": F.least("old.low", F.array_min(F.transform("days", lambda d: d["low"]))).cast("double"),
    })
    n = F.col("_amounts")
    spread = F.col("_squares").cast("double") - F.col("_sum").cast("double") * F.col("_sum").cast("double") / n
    mean = F.try_divide(F.col("_sum").cast("double"), n.cast("double"))
    base = base.withColumns({"gap_count": F.col("frequency_total") - 1, "gap_sum": F.col("_gaps.s"), "gap_squares": F.col("_gaps.q")})
    windows = []
    for days in spec.lookbacks:
        recent = _since(F.date_sub(cutoff, days))
        count, spend = of("n", recent, F.lit(0).cast("long")), total(recent, F.lit(0)).cast("double")
        windows += [count.alias(f"frequency_{days}d"), spend.alias(f"monetary_{days}d")]
        if order_values:
            amounts = of("amounts", recent, F.lit(0).cast("long")).cast("double")
            windows.append(F.coalesce(F.try_divide(spend, amounts), F.lit(0.0)).alias(f"avg_order_value_{days}d"))
    return base.select(
        KEY, "frequency_total", "first_purchase_date", "last_purchase", days_between(spec.at, F.col("last_purchase")).alias("recency_days"),
        F.col("_sum").cast("double").alias("monetary_total"), mean.alias("avg_order_value"), "max_order_value", "min_order_value",
        F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1))).otherwise(0.0).alias("std_order_value"), *windows,
        F.coalesce(gap_mean(), F.lit(0.0)).alias("avg_days_between_purchases"), F.coalesce(gap_std(), F.lit(0.0)).alias("std_days_between_purchases"),
    )


def _since(day: Column) -> Column:
    return F.filter("days", lambda d: d["day"] >= day)


def _gap(day: Column, acc: Column) -> Column:
    return F.coalesce(days_between(day["first"], acc["last"]), F.lit(0)).cast("long")


def fold_days(header: DataFrame, cutoffs: Sequence[str], keep: int = KEEP) -> DataFrame:
    """The state after folding the rows between consecutive cutoffs, one fold each."""
    state, start = None, None
    for until in cutoffs:
        rows = header if start is None else header.filter(F.col(TS) >= as_ntz(start))
        state, _ = fold(state, rows, until, keep)
        start = until
    return state
