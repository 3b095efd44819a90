"""Customer features by grain.

Each block is a chain of grouped aggregates that ends with one row per customer.
Before the customer id becomes the grouping key, rows are folded on a finer key
(customer and day, customer and product, customer and store), so a customer that
owns a third of all rows never arrives in one task as raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillsight.functions.columns import (
    clip,
    day_part,
    days_between,
    is_weekend,
    mean,
    sample_std,
    total,
    weekday_name,
)
from tillsight.functions.ordering import attach, exact_median
from tillsight.operators.periods import FeatureSpec

KEY = "customer_id"
TS = "transaction_date"


# -- header grain ---------------------------------------------------------------------
def window_measures(spec: FeatureSpec, amount: str = "total_amount", order_values: bool = True) -> list[Column]:
    """Frequency, spend and mean order value of every look-back, as conditional
    aggregates of the same scan and the same shuffle."""
    out = []
    for days in spec.lookbacks:
        inside = spec.lookback(TS, days)
        spend = F.when(inside, F.col(amount))
        out.append(F.count_if(inside).alias(f"frequency_{days}d"))
        out.append(total(spend).alias(f"monetary_{days}d"))
        if order_values:
            out.append(F.coalesce(mean(spend), F.lit(0.0)).alias(f"avg_order_value_{days}d"))
    return out


def lifetime_measures(spec: FeatureSpec, amount: str = "total_amount") -> list[Column]:
    past = spec.history(TS)
    spend = F.when(past, F.col(amount))
    when = F.when(past, F.col(TS))
    return [
        F.count_if(past).alias("frequency_total"),
        F.min(when).alias("first_purchase_date"),
        F.max(when).alias("last_purchase"),
        days_between(spec.at, F.max(when)).alias("recency_days"),
        total(spend).alias("monetary_total"),
        mean(spend).alias("avg_order_value"),
        F.max(spend).cast("double").alias("max_order_value"),
        F.min(spend).cast("double").alias("min_order_value"),
        F.coalesce(sample_std(spend), F.lit(0.0)).alias("std_order_value"),
    ]


def target_measures(spec: FeatureSpec, amount: str = "total_amount") -> list[Column]:
    ahead = spec.future(TS)
    spend = total(F.when(ahead, F.col(amount)))
    return [
        spend.alias("future_spend_30d"),
        F.count_if(ahead).alias("future_transactions_30d"),
        (spend > 0).cast("int").alias("will_purchase_30d"),
    ]


def smallest_mode(value: Column, condition: Column, size: int) -> Column:
    """Most frequent value in 0..size-1, ties to the smallest, null if none.

    One counter per value: a fixed number of longs per group, no value map.
    """
    counts = F.array(*[F.count_if(condition & (value == v)) for v in range(size)])
    top = F.array_max(counts)
    return F.when(top > 0, F.array_position(counts, top).cast("int") - 1)


def time_measures(spec: FeatureSpec) -> list[Column]:
    """Hour and weekday habits of the history rows."""
    past = spec.history(TS)
    hour, dow = F.hour(TS), F.weekday(F.col(TS))
    in_past = lambda c: F.when(past, c)
    common_hour = smallest_mode(hour, past, 24)
    common_dow = smallest_mode(dow, past, 7)
    return [
        mean(in_past(hour)).alias("avg_purchase_hour"),
        common_hour.alias("most_common_hour"),
        day_part(common_hour).alias("preferred_time_of_day"),
        common_dow.alias("most_common_dow"),
        weekday_name(common_dow).alias("preferred_day"),
        mean(in_past(is_weekend(TS).cast("int"))).alias("weekend_transaction_pct"),
        mean(in_past(dow)).alias("avg_dow"),
        F.coalesce(sample_std(in_past(dow)), F.lit(0.0)).alias("std_dow"),
        active_months(in_past(F.col(TS))).alias("active_months"),
    ]


def active_months(ts: Column) -> Column:
    """Distinct calendar months (1-12) as a bit mask: no distinct shuffle."""
    return F.bit_count(F.bit_or(F.when(ts.isNotNull(), F.call_function("shiftleft", F.lit(1), F.month(ts)))))


def header_features(
    header: DataFrame,
    spec: FeatureSpec,
    amount: str = "total_amount",
    measures: Sequence[Column] | None = None,
    with_target: bool = True,
) -> DataFrame:
    """Lifetime, look-back, habit and target measures: one scan, one shuffle.

    Customers whose first purchase is after the cutoff have no history and are
    left out, as nothing is known about them at the cutoff.
    """
    chosen = list(measures) if measures is not None else [*lifetime_measures(spec, amount), *window_measures(spec, amount)]
    has_past = F.count_if(spec.history(TS)).alias("_past")
    target = target_measures(spec, amount) if with_target else []
    rows = header.filter(F.col(KEY).isNotNull() & (spec.relevant(TS) if with_target else spec.history(TS)))
    out = rows.groupBy(KEY).agg(has_past, *chosen, *target)
    return out.filter("_past > 0").drop("_past")


# -- purchase cadence -----------------------------------------------------------------
def purchase_gaps(header: DataFrame, spec: FeatureSpec | None = None) -> DataFrame:
    """Sums of the whole-day gaps between consecutive purchases, per customer.

    Two purchases on one calendar day are less than a day apart, a gap of 0.
    So only the first and last purchase of each customer and day matter, and the
    window runs over days instead of purchases.
    """
    rows = header.filter(F.col(KEY).isNotNull() & F.col(TS).isNotNull())
    if spec is not None:
        rows = rows.filter(spec.history(TS))
    days = rows.groupBy(KEY, F.to_date(TS).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.min(TS).alias("first"), F.max(TS).alias("last")
    )
    previous = F.lag("last").over(Window.partitionBy(KEY).orderBy("day"))
    gaps = days.withColumn("gap", F.coalesce(days_between(F.col("first"), previous), F.lit(0)))
    return gaps.groupBy(KEY).agg(
        (F.sum("n") - 1).alias("gap_count"),
        F.sum("gap").alias("gap_sum"),
        F.sum(F.col("gap") * F.col("gap")).alias("gap_squares"),
    )


def gap_mean() -> Column:
    return F.try_divide(F.col("gap_sum").cast("double"), F.col("gap_count").cast("double"))


def gap_std() -> Column:
    """Sample standard deviation from exact integer sums; null below two gaps."""
    n, s, q = F.col("gap_count"), F.col("gap_sum"), F.col("gap_squares")
    spread = (q * n - s * s).cast("double")
    return F.when(n > 1, F.sqrt(F.try_divide(spread, (n * (n - 1)).cast("double"))))


def purchase_cadence(header: DataFrame, spec: FeatureSpec | None = None) -> DataFrame:
    """Mean and deviation of the gaps; 0 where there are too few purchases."""
    return purchase_gaps(header, spec).select(
        KEY,
        F.coalesce(gap_mean(), F.lit(0.0)).alias("avg_days_between_purchases"),
        F.coalesce(gap_std(), F.lit(0.0)).alias("std_days_between_purchases"),
    )


def average_gap(header: DataFrame, spec: FeatureSpec | None = None) -> DataFrame:
    """Mean gap; single-purchase customers get the median of the others."""
    gaps = purchase_gaps(header, spec).select(KEY, gap_mean().alias("avg_gap_days"))
    filled = attach(gaps, exact_median(gaps, "avg_gap_days", name="m"))
    return filled.select(KEY, F.coalesce("avg_gap_days", "_k.m").alias("avg_gap_days"))


# -- line grain -------------------------------------------------------------------------
def most_frequent(count: str, value: str) -> Column:
    """Value with the highest count, ties to the smallest value; null values lose."""
    pair = F.struct((-F.col(count)).alias("c"), F.col(value).alias("v"))
    return F.min(F.when(F.col(value).isNotNull(), pair)).getField("v")


def share_column(category: str) -> str:
    return "pct_spend_" + category.lower().replace(" ", "_")


def basket_features(
    lines: DataFrame,
    header: DataFrame,
    products: DataFrame,
    spec: FeatureSpec,
    categories: Sequence[str] = (),
) -> DataFrame:
    """Variety, favourite category and spend share per category.

    Order: lines meet history headers, fold to customer and product, and only
    then look up the category, so the product join sees pairs, not lines.
    ``categories`` are the pivot values; naming them keeps this one pass.
    """
    past = header.filter(spec.history(TS) & F.col(KEY).isNotNull()).select("transaction_id", KEY)
    pairs = (
        lines.join(past, "transaction_id")
        .groupBy(KEY, "product_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("qty"), F.sum("line_item_amount").alias("amt"))
    )
    lookup = products.select("product_id", "product_category")
    by_category = (
        pairs.join(lookup, "product_id", "left")
        .groupBy(KEY, "product_category")
        .agg(
            F.sum("n").alias("n"),
            F.sum("qty").alias("qty"),
            F.sum("amt").alias("amt"),
            F.count("product_id").alias("products"),
        )
    )
    known = F.col("product_category").isNotNull()
    whole = F.sum(F.when(known, F.col("amt"))).cast("double")
    shares = [
        F.coalesce(
            F.try_divide(F.sum(F.when(F.col("product_category") == c, F.col("amt"))).cast("double"), whole),
            F.lit(0.0),
        ).alias(share_column(c))
        for c in categories
    ]
    return by_category.groupBy(KEY).agg(
        F.count("product_category").alias("unique_categories"),
        F.sum("products").alias("unique_products"),
        total("qty").alias("total_items_purchased"),
        most_frequent("n", "product_category").alias("top_category"),
        *shares,
    )


def store_features(header: DataFrame, stores: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Stores and regions visited, and the most visited of each."""
    visits = (
        header.filter(spec.history(TS) & F.col(KEY).isNotNull())
        .groupBy(KEY, "store_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    regions = (
        visits.join(stores.select("store_id", "store_region"), "store_id", "left")
        .groupBy(KEY, "store_region")
        .agg(
            F.sum("n").alias("n"),
            F.count("store_id").alias("stores"),
            F.min(
                F.when(F.col("store_id").isNotNull(), F.struct((-F.col("n")).alias("c"), F.col("store_id").alias("v")))
            ).alias("best"),
        )
    )
    return regions.groupBy(KEY).agg(
        F.sum("stores").alias("unique_stores"),
        F.count("store_region").alias("unique_regions"),
        F.min("best").getField("v").alias("primary_store_id"),
        most_frequent("n", "store_region").alias("primary_region"),
    )


# -- transaction grain --------------------------------------------------------------------
def transaction_rollup(lines: DataFrame) -> DataFrame:
    """Line total, quantity and distinct products of each transaction."""
    products = lines.groupBy("transaction_id", "product_id").agg(
        F.sum("line_item_amount").alias("amt"), F.sum("quantity").alias("qty")
    )
    return products.filter(F.col("transaction_id").isNotNull()).groupBy("transaction_id").agg(
        # The type of the amounts is kept: decimal money stays exact.
        F.coalesce(F.sum("amt"), F.lit(0)).alias("line_total"),
        F.coalesce(F.sum("qty"), F.lit(0)).alias("quantity"),
        F.count("product_id").alias("num_products"),
    )


def sales_with_lines(header: DataFrame, lines: DataFrame) -> DataFrame:
    """Headers that have lines, with the rollup: both sides unique, so no skew."""
    return header.join(transaction_rollup(lines), "transaction_id")


def order_profile(sales: DataFrame, spec: FeatureSpec, with_target: bool = True) -> DataFrame:
    """The 13 order measures, tenure, look-backs and target of each customer."""
    past = spec.history(TS)
    of = lambda c: F.when(past, F.col(c))
    measures = [
        F.count_if(past).alias("total_frequency"),
        total(of("line_total")).alias("total_monetary"),
        mean(of("line_total")).alias("avg_order_value"),
        F.coalesce(sample_std(of("line_total")), F.lit(0.0)).alias("std_order_value"),
        F.min(of("line_total")).cast("double").alias("min_order"),
        F.max(of("line_total")).cast("double").alias("max_order"),
        F.min(of(TS)).alias("first_purchase"),
        F.max(of(TS)).alias("last_purchase"),
        total(of("quantity")).alias("total_quantity"),
        mean(of("quantity")).alias("avg_quantity"),
        F.sum(of("num_products")).alias("total_products"),
        mean(of("num_products")).alias("avg_products_per_order"),
        days_between(spec.at, F.max(of(TS))).alias("recency_days"),
        days_between(spec.at, F.min(of(TS))).alias("customer_tenure_days"),
        *window_measures(spec, "line_total", order_values=False),
    ]
    return header_features(sales, spec, "line_total", measures, with_target)


def stores_visited(header: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Distinct stores per customer, folded to customer and store first."""
    seen = header.filter(spec.history(TS) & F.col(KEY).isNotNull()).select(KEY, "store_id").distinct()
    return seen.groupBy(KEY).agg(F.count("store_id").alias("num_stores_visited"))


# -- attributes -----------------------------------------------------------------------------
def customer_attributes(customers: DataFrame, spec: FeatureSpec, style: str = "clipped") -> DataFrame:
    """Tier, points, segment and tenure from registration.

    ``clipped``: negative tenure is 0 and a missing tier is Unknown.
    ``defaulted``: missing tenure is 365, tier Bronze, segment NR.
    """
    since = F.col("customer_since").try_cast("timestamp_ntz")
    tenure = days_between(spec.at, since)
    points = F.coalesce(F.col("total_loyalty_points").cast("double"), F.lit(0.0))
    if style == "clipped":
        tier, segment, days = F.coalesce("loyalty_status", F.lit("Unknown")), F.col("segment_id"), clip(tenure, low=0)
        name = "tenure_days"
    else:
        tier = F.coalesce("loyalty_status", F.lit("Bronze"))
        segment = F.coalesce("segment_id", F.lit("NR"))
        days, name = F.coalesce(tenure, F.lit(365)), "customer_tenure_days"
    return customers.select(
        KEY, tier.alias("loyalty_status"), points.alias("total_loyalty_points"), segment.alias("segment_id"), days.alias(name)
    )
