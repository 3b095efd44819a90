"""Customer frames that several queries start from (SQL: profile, cust, scored, split)."""

from pyspark.sql import functions as F

from tillsight.operators import customer as cu
from tillsight.operators.periods import FeatureSpec
from tillsight.sources.bindings import EVENT_CUTOFF, ORDER_CUTOFF

SPEC = FeatureSpec(ORDER_CUTOFF, lookbacks=(30, 60, 90))
WIDE = FeatureSpec(ORDER_CUTOFF, lookbacks=(7, 14, 30, 60, 90))
EVENTS = FeatureSpec(EVENT_CUTOFF, horizon_days=7, lookbacks=(7, 14))


def order_profile(t):
    return cu.order_profile(cu.sales_with_lines(t.header, t.lines), WIDE)


def customer_table(t):
    """Compact per-customer frame of the header, with target."""
    past = SPEC.history(cu.TS)
    when, spend = F.when(past, F.col(cu.TS)), F.when(past, F.col("total_amount"))
    measures = [
        F.count_if(past).alias("total_frequency"),
        cu.total(spend).alias("total_monetary"),
        F.min(when).alias("first_purchase"),
        F.max(when).alias("last_purchase"),
        cu.days_between(SPEC.at, F.max(when)).alias("recency_days"),
        *cu.window_measures(SPEC, order_values=False),
    ]
    return cu.header_features(t.header, SPEC, measures=measures)


def scored(t):
    return customer_table(t).select(
        "customer_id", "last_purchase", "future_spend_30d", "will_purchase_30d",
        (F.col("monetary_90d") / 3).alias("predicted"),
        (F.col("frequency_90d") / (F.col("frequency_90d") + 1)).alias("probability"),
        (F.col("total_monetary") / F.col("total_frequency")).alias("amount"),
    )
