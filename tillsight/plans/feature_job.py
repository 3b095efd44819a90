"""Clean tables to customer feature tables.

Every block ends with one row per customer and all joins use ``customer_id``, so
the joins are one-to-one: no skew, and blocks that are already partitioned by the
customer are not shuffled again. Families with label codes write the joined
table before coding, because the codes and the coded rows both read it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tillsight.models.prep import label_encode
from tillsight.operators import customer as cu
from tillsight.operators import derived as d
from tillsight.operators.periods import FeatureSpec
from tillsight.session import cut_lineage
from tillsight.sources.schemas import CATEGORIES, PRESETS, TARGETS, feature_groups

KEY = cu.KEY


def full_features(
    header: DataFrame, lines: DataFrame, products: DataFrame, stores: DataFrame, customers: DataFrame,
    spec: FeatureSpec, categories: Sequence[str] = CATEGORIES,
) -> DataFrame:
    """The wide feature table: id, first purchase, all feature groups, three targets."""
    measures = [*cu.lifetime_measures(spec), *cu.window_measures(spec), *cu.time_measures(spec)]
    base = cu.header_features(header, spec, measures=measures)
    out = (
        base.join(cu.basket_features(lines, header, products, spec, categories), KEY, "left")
        .join(cu.store_features(header, stores, spec), KEY, "left")
        .join(cu.purchase_cadence(header, spec), KEY, "left")
        .join(cu.customer_attributes(customers, spec), KEY, "left")
    )
    filled = d.fill_features(out)
    features = [f for group in feature_groups(categories, spec.lookbacks).values() for f in group]
    return filled.select(KEY, "first_purchase_date", *[F.col(f"`{f}`") for f in features], *TARGETS)


def rfm_features(
    header: DataFrame, lines: DataFrame, products: DataFrame, customers: DataFrame, spec: FeatureSpec, coded: bool = True
) -> DataFrame:
    """The compact family: 19 features, three of them label codes."""
    past = spec.history(cu.TS)
    weekend = cu.mean(F.when(past, cu.is_weekend(cu.TS).cast("int")))
    measures = [
        *cu.lifetime_measures(spec)[:6],
        *cu.window_measures(spec, order_values=False),
        (weekend > 0.5).cast("int").alias("is_weekend_shopper"),
    ]
    base = cu.header_features(header, spec, measures=measures)
    basket = cu.basket_features(lines, header, products, spec).select(KEY, "unique_categories", "top_category")
    out = (
        base.join(basket, KEY, "left")
        .join(cu.stores_visited(header, spec), KEY, "left")
        .join(cu.average_gap(header, spec).withColumnRenamed("avg_gap_days", "avg_days_between_purchases"), KEY, "left")
        .join(cu.customer_attributes(customers, spec, "defaulted"), KEY, "left")
    )
    out = out.withColumns(
        {
            "total_frequency": F.col("frequency_total"),
            "total_monetary": F.col("monetary_total"),
            "num_categories": F.coalesce("unique_categories", F.lit(1)),
            "top_category": F.coalesce("top_category", F.lit("Unknown")),
            "loyalty_status": F.coalesce("loyalty_status", F.lit("Bronze")),
            "segment_id": F.coalesce("segment_id", F.lit("NR")),
            "total_loyalty_points": F.coalesce("total_loyalty_points", F.lit(0.0)),
            "customer_tenure_days": F.coalesce("customer_tenure_days", F.lit(365)),
        }
    )
    features = PRESETS["rfm19"]
    if coded:
        out = label_encode(cut_lineage(out), coded_columns(features))
    return out.select(KEY, "first_purchase_date", "last_purchase", *(features if coded else raw_names(features)), *TARGETS)


def coded_columns(features: Sequence[str]) -> list[str]:
    """The categories behind the encoded columns of a feature set."""
    return [f.removesuffix("_encoded") for f in features if f.endswith("_encoded")]


def raw_names(features: Sequence[str]) -> list[str]:
    """The feature set with categories in place of their codes."""
    return [f.removesuffix("_encoded") for f in features]


def order_features(
    header: DataFrame, lines: DataFrame, customers: DataFrame, spec: FeatureSpec, family: str = "momentum32",
    coded: bool = True,
) -> DataFrame:
    """The families built on line totals per order: momentum32, two_stage,
    interaction and velocity. The velocity family needs look-backs 7 to 90.
    With ``coded=False`` categories stay text, to be coded on training rows."""
    sales = cu.sales_with_lines(header, lines)
    base = cu.order_profile(sales, spec)
    # Three columns of the headers look small in their files, but all rows would pass through the driver.
    visited = cu.stores_visited(cu.sales_with_lines(header.hint("merge"), lines), spec)
    out = base.join(visited, KEY, "left")
    attributes = customers.select(KEY, "loyalty_status", "segment_id", F.col("total_loyalty_points").cast("double"))
    # As many customers as rows: they are shuffled, not broadcast, and the rows keep their order.
    out = out.join(attributes.hint("shuffle_hash"), KEY, "left").withColumn("avg_days_between_purchases", d.tenure_per_order())
    out = out.fillna(0, ["total_loyalty_points"]).withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit("Unknown")) for c in ("loyalty_status", "segment_id")}
    )
    if family == "interaction":
        out = d.with_columns(out.withColumn("total_loyalty_points", d.points_proxy()), d.interactions(), d.polynomials())
    elif family == "velocity":
        habits = cu.header_features(sales, spec, "line_total", cu.time_measures(spec), with_target=False)
        habits = habits.select(
            KEY, "avg_dow", "std_dow", F.col("weekend_transaction_pct").alias("weekend_ratio"),
            F.col("avg_purchase_hour").alias("avg_hour"), "active_months",
        )
        out = d.with_columns(
            out.join(habits, KEY), d.velocity(), d.order_spread(),
            {
                "spend_trend": d.spend_trend(), "purchase_overdue_ratio": d.overdue_ratio(),
                "recency_score": d.recency_score(),
                "momentum_monetary": d.ratio("monetary_30d", "total_monetary"),
                "momentum_frequency": d.ratio("frequency_30d", "total_frequency"),
            },
        )
    else:
        out = d.with_columns(out, d.momentum(), d.short_to_medium(), d.order_spread())
    features = PRESETS[family]
    if coded and coded_columns(features):
        out = label_encode(cut_lineage(out), coded_columns(features))
    return out.select(KEY, "first_purchase", "last_purchase", *(features if coded else raw_names(features)), *TARGETS)
