"""Features computed from features: pure projections, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tillsight.functions.columns import clip, col, days_between, ratio
from tillsight.functions.ordering import attach, exact_quantiles
from tillsight.operators.periods import FeatureSpec
from tillsight.session import cut_lineage

# Fixed values -----------------------------------------------------------------------
CATEGORICALS = [
    "loyalty_status",
    "segment_id",
    "top_category",
    "primary_store_id",
    "primary_region",
    "preferred_time_of_day",
    "preferred_day",
]
# Spend buckets: lower bounds (exclusive) of buckets 1..4, and the value of each bucket.
BUCKET_BOUNDS = [0, 100, 500, 1000]
BUCKET_VALUES = [0, 50, 300, 750, 1500]
# Score tiers: upper bounds (inclusive); above the last comes VIP.
SCORE_TIERS = [(0, "Zero"), (25, "Low"), (75, "Medium"), (200, "High")]
TOP_SCORE_TIER = "VIP"
# Value tiers: upper bounds (exclusive); exactly zero is Inactive.
VALUE_TIERS = [(100, "Low Value"), (300, "Medium Value"), (500, "Medium-High Value")]
INACTIVE, TOP_VALUE_TIER = "Inactive", "High Value"
ACTIONS = {
    "High Value": "Exclusive offers and priority support",
    "Medium-High Value": "Loyalty rewards",
    "Medium Value": "Personalized campaigns",
    "Low Value": "Re-engagement campaign",
    "Inactive": "Win-back strategy",
}
DAYS_PER_MONTH, WEEKS_PER_MONTH = 30, 4.3
POINTS_PER_SPEND = 0.1
# Tenure buckets in days (upper bound, inclusive); our choice, as none is specified.
TENURE_BUCKETS = [(90, "0-3 months"), (180, "3-6 months"), (365, "6-12 months"), (730, "1-2 years")]
# End of fixed values ------------------------------------------------------------------


# -- ratios and trends -------------------------------------------------------------------
def momentum() -> dict[str, Column]:
    """Recent activity as a share of lifetime activity."""
    out = {f"momentum_monetary_{d}d": ratio(f"monetary_{d}d", "total_monetary") for d in (30, 60, 90)}
    out |= {f"momentum_frequency_{d}d": ratio(f"frequency_{d}d", "total_frequency") for d in (30, 60)}
    return out


def short_to_medium() -> dict[str, Column]:
    return {
        "ratio_30d_90d_monetary": ratio("monetary_30d", "monetary_90d"),
        "ratio_30d_90d_frequency": ratio("frequency_30d", "frequency_90d"),
    }


def order_spread() -> dict[str, Column]:
    return {
        "order_value_range": F.col("max_order") - F.col("min_order"),
        "order_value_cv": ratio("std_order_value", "avg_order_value"),
    }


def tenure_per_order() -> Column:
    return ratio("customer_tenure_days", "total_frequency")


def velocity() -> dict[str, Column]:
    """Change of pace between nested look-backs."""
    return {
        "velocity_7d_30d": ratio("monetary_7d", "monetary_30d"),
        "velocity_30d_90d": ratio("monetary_30d", "monetary_90d"),
        "velocity_14d_60d": ratio("monetary_14d", "monetary_60d"),
        "freq_velocity_7d_30d": ratio("frequency_7d", "frequency_30d"),
        "freq_velocity_30d_90d": ratio("frequency_30d", "frequency_90d"),
    }


def spend_trend() -> Column:
    """Last month against the mean of the two months before."""
    return F.col("monetary_30d") - (F.col("monetary_90d") - F.col("monetary_30d")) / 2


def overdue_ratio(gap: str = "avg_days_between_purchases") -> Column:
    return ratio("recency_days", gap)


def recency_score() -> Column:
    return F.lit(1.0) / (F.col("recency_days").cast("double") + 1)


def rfm_score() -> Column:
    return recency_score() * F.col("total_frequency") * F.col("total_monetary")


def interactions() -> dict[str, Column]:
    return {
        "recency_score": recency_score(),
        "rfm_score": rfm_score(),
        "monetary_momentum_30d": ratio("monetary_30d", "total_monetary"),
        "monetary_momentum_90d": ratio("monetary_90d", "total_monetary"),
        "frequency_momentum_30d": ratio("frequency_30d", "total_frequency"),
        "order_value_range": F.col("max_order") - F.col("min_order"),
        "order_cv": ratio("std_order_value", "avg_order_value"),
        "purchase_density": ratio("total_frequency", "customer_tenure_days"),
        "loyalty_per_dollar": ratio("total_loyalty_points", "total_monetary"),
    }


def points_proxy(spend: str = "total_monetary") -> Column:
    return F.col(spend) * F.lit(POINTS_PER_SPEND)


def polynomials() -> dict[str, Column]:
    m, f = F.col("total_monetary").cast("double"), F.col("total_frequency").cast("double")
    return {
        "monetary_squared": m * m,
        "monetary_sqrt": F.sqrt(m),
        "frequency_squared": f * f,
        "log_monetary": F.log1p(m),
        "log_frequency": F.log1p(f),
    }


def tenure(spec: FeatureSpec, start: str, fill: int | None = None, clipped: bool = False) -> Column:
    """Days from a start date to the cutoff, optionally filled and not below 0."""
    days = days_between(spec.at, F.col(start))
    if clipped:
        days = clip(days, low=0)
    return days if fill is None else F.coalesce(days, F.lit(fill))


# -- documented only ------------------------------------------------------------------------
def activity_flags() -> dict[str, Column]:
    return {
        "is_active_30d": (F.col("recency_days") <= 30).cast("int"),
        "is_active_60d": (F.col("recency_days") <= 60).cast("int"),
    }


def tenure_bucket(days: str = "tenure_days") -> Column:
    out = None
    for upper, label in TENURE_BUCKETS:
        inside = F.col(days) <= upper
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out.when(F.col(days).isNotNull(), "2+ years")


def category_diversity(shares: list[str]) -> Column:
    """Shannon entropy of the category shares, scaled to 0..1."""
    parts = [F.when(F.col(f"`{s}`") > 0, -F.col(f"`{s}`") * F.ln(F.col(f"`{s}`"))).otherwise(0.0) for s in shares]
    whole = sum(parts[1:], parts[0])
    return whole / F.ln(F.lit(float(max(len(shares), 2))))


def behaviour_segments(rfm: DataFrame) -> DataFrame:
    """Champions / Loyal / At Risk / Lost from thirds of recency, frequency, spend.

    Thirds are cut at exact quantiles, so no global sort is needed. Recent means
    the lower third of recency, lapsed the upper third; strong and weak likewise
    for frequency and spend.
    """
    thirds = {"low": 1 / 3, "high": 2 / 3}
    names = ("recency", "frequency", "monetary")
    rfm = cut_lineage(rfm)
    # One search for the three measures, as groups of one long column.
    cells = F.array(*[F.struct(F.lit(c).alias("_measure"), F.col(c).cast("double").alias("_value")) for c in names])
    found = exact_quantiles(rfm.select(F.inline(cells)), "_value", thirds, ["_measure"])
    pick = lambda c, q: F.max(F.when(F.col("_measure") == c, F.col(q))).alias(q)
    found = found.agg(*[F.struct(pick(c, "low"), pick(c, "high")).alias(f"_{c}") for c in names])
    out = attach(rfm, found, "_thirds").withColumns({f"_{c}": F.col(f"_thirds._{c}") for c in names}).drop("_thirds")
    upper = lambda c: F.col(c) > F.col(f"_{c}.high")
    lower = lambda c: F.col(c) <= F.col(f"_{c}.low")
    recent, lapsed = lower("recency"), upper("recency")
    frequent, spender = upper("frequency"), upper("monetary")
    rare, low = lower("frequency"), lower("monetary")
    segment = (
        F.when(recent & frequent & spender, "Champions")
        .when(lapsed & (rare | low), "Lost")
        .when(lapsed, "At Risk")
        .otherwise("Loyal")
    )
    return out.withColumn("behaviour_segment", segment).drop("_recency", "_frequency", "_monetary")


# -- fills -------------------------------------------------------------------------------------
def fill_features(df: DataFrame, categoricals: list[str] = CATEGORICALS, unknown: str | Mapping[str, str] = "Unknown") -> DataFrame:
    """Numbers null -> 0, known categoricals null -> Unknown (or per-column text)."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    out = df.fillna(0, subset=numeric)
    texts = {c: unknown if isinstance(unknown, str) else unknown.get(c, "Unknown") for c in categoricals if c in df.columns}
    return out.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(text)) for c, text in texts.items()})


# -- targets -------------------------------------------------------------------------------------
def target_cap(train: DataFrame, target: str = "future_spend_30d", of: str = "spenders", q: float = 0.99) -> DataFrame:
    """One row ``cap``: a quantile of the training target. Test rows never count."""
    rows = train.filter(F.col(target) > 0) if of == "spenders" else train
    return exact_quantiles(rows, target, {"cap": q})


def log_target(c: Column | str) -> Column:
    return F.log1p(col(c).cast("double"))


def unlog_target(c: Column | str) -> Column:
    return F.expm1(col(c))


def spend_bucket(c: Column | str) -> Column:
    c, out = col(c), None
    for number in range(len(BUCKET_BOUNDS), 0, -1):
        above = c > BUCKET_BOUNDS[number - 1]
        out = F.when(above, number) if out is None else out.when(above, number)
    return out.when(c.isNotNull(), 0)


def bucket_value(bucket: Column | str) -> Column:
    return F.get(F.array(*[F.lit(float(v)) for v in BUCKET_VALUES]), col(bucket).cast("int"))


# -- tiers and score details -----------------------------------------------------------------------
def score_tier(c: Column | str) -> Column:
    """Right-closed bins from Zero to VIP; null for scores of -1 or less."""
    c = col(c)
    out = F.when(c <= -1, F.lit(None).cast("string"))
    for upper, label in SCORE_TIERS:
        out = out.when(c <= upper, label)
    return out.when(c.isNotNull(), TOP_SCORE_TIER)


def value_tier(c: Column | str) -> Column:
    c = col(c)
    out = F.when(c == 0, INACTIVE)
    for upper, label in VALUE_TIERS:
        out = out.when(c < upper, label)
    return out.when(c.isNotNull(), TOP_VALUE_TIER)


def recommended_action(tier: Column | str) -> Column:
    out = None
    for label, action in ACTIONS.items():
        hit = col(tier) == label
        out = F.when(hit, action) if out is None else out.when(hit, action)
    return out


def prediction_band(score: Column | str, error: Column | float) -> dict[str, Column]:
    score, error = col(score), error if isinstance(error, Column) else F.lit(float(error))
    return {
        "prediction_range_low": F.greatest(score - error, F.lit(0.0)),
        "prediction_range_high": score + error,
    }


def score_rates(score: Column | str, mean_target: Column) -> dict[str, Column]:
    score = col(score)
    return {
        "daily_average": score / DAYS_PER_MONTH,
        "weekly_average": score / WEEKS_PER_MONTH,
        "pct_vs_average": F.when(mean_target > 0, (score - mean_target) / mean_target * 100).otherwise(0.0),
    }


def with_columns(df: DataFrame, *groups: Mapping[str, Column]) -> DataFrame:
    merged: dict[str, Column] = {}
    for g in groups:
        merged |= g
    return df.withColumns(merged)
