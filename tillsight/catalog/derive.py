"""Derived features, targets and tiers."""

from pyspark.sql import functions as F

from tillsight.catalog.registry import CUT, PAST, query, rounded, sql_days
from tillsight.catalog.views import SPEC, customer_table, order_profile, scored
from tillsight.functions.columns import clip, day_part, pad_id, weekday_name
from tillsight.functions.ordering import attach
from tillsight.operators import derived as d
from tillsight.operators.customer import basket_features, share_column
from tillsight.operators.explore import customer_rfm
from tillsight.operators.splits import temporal_split
from tillsight.operators.periods import FeatureSpec
from tillsight.plans.feature_job import order_features
from tillsight.sources.bindings import CATEGORIES, ORDER_CUTOFF
from tillsight.sources.schemas import PRESETS

KEY = "customer_id"


def _pick(df, columns):
    return rounded(df.select(KEY, *columns), 6)


def _sql(columns, source="profile"):
    return f"SELECT customer_id, {', '.join(f'round({e}, 6) AS {n}' for n, e in columns.items())} FROM {source}"


def _ratio(a, b):
    return f"{a}::DOUBLE / greatest({b}::DOUBLE, 1.0::DOUBLE)"


MOMENTUM = {f"momentum_monetary_{x}d": _ratio(f"monetary_{x}d", "total_monetary") for x in (30, 60, 90)}
MOMENTUM |= {f"momentum_frequency_{x}d": _ratio(f"frequency_{x}d", "total_frequency") for x in (30, 60)}
SHORT = {"ratio_30d_90d_monetary": _ratio("monetary_30d", "monetary_90d"), "ratio_30d_90d_frequency": _ratio("frequency_30d", "frequency_90d")}
SPREAD = {"order_value_range": "max_order - min_order", "order_value_cv": _ratio("std_order_value", "avg_order_value")}
VELOCITY = {
    "velocity_7d_30d": _ratio("monetary_7d", "monetary_30d"), "velocity_30d_90d": _ratio("monetary_30d", "monetary_90d"),
    "velocity_14d_60d": _ratio("monetary_14d", "monetary_60d"), "freq_velocity_7d_30d": _ratio("frequency_7d", "frequency_30d"),
    "freq_velocity_30d_90d": _ratio("frequency_30d", "frequency_90d"),
}


@query("e_momentum", "profile", _sql(MOMENTUM | SHORT))
def momentum(t):
    return _pick(d.with_columns(order_profile(t), d.momentum(), d.short_to_medium()), [*MOMENTUM, *SHORT])


@query("e_spread", "profile", _sql(SPREAD))
def spread(t):
    return _pick(d.with_columns(order_profile(t), d.order_spread()), SPREAD)


@query("e_velocity", "profile", _sql(VELOCITY))
def velocity(t):
    return _pick(d.with_columns(order_profile(t), d.velocity()), VELOCITY)


GAP = f"({_ratio('customer_tenure_days', 'total_frequency')})"
TREND = {
    "spend_trend": "monetary_30d - (monetary_90d - monetary_30d) / 2",
    "tenure_per_order": GAP,
    "overdue_ratio": f"recency_days::DOUBLE / greatest({GAP}, 1.0::DOUBLE)",
    "recency_score": "1.0::DOUBLE / (recency_days::DOUBLE + 1)",
}


@query("e_trend", "profile", _sql(TREND))
def trend(t):
    out = order_profile(t).withColumn("tenure_per_order", d.tenure_per_order())
    columns = {"spend_trend": d.spend_trend(), "overdue_ratio": d.overdue_ratio("tenure_per_order"), "recency_score": d.recency_score()}
    return _pick(d.with_columns(out, columns), TREND)


INTERACTION = {
    "rfm_score": "1.0::DOUBLE / (recency_days::DOUBLE + 1) * total_frequency * total_monetary",
    "monetary_momentum_30d": _ratio("monetary_30d", "total_monetary"),
    "order_cv": _ratio("std_order_value", "avg_order_value"),
    "purchase_density": _ratio("total_frequency", "customer_tenure_days"),
    "total_loyalty_points": "total_monetary * 0.1::DOUBLE",
    "loyalty_per_dollar": _ratio("(total_monetary * 0.1::DOUBLE)", "total_monetary"),
}


@query("e_rfm_score", "profile", _sql(INTERACTION))
def rfm_score(t):
    out = order_profile(t).withColumn("total_loyalty_points", d.points_proxy())
    return _pick(d.with_columns(out, d.interactions()), INTERACTION)


POLY = {
    "monetary_sqrt": "sqrt(total_monetary)", "frequency_squared": "total_frequency::DOUBLE * total_frequency",
    "log_monetary": "ln(1 + total_monetary)", "log_frequency": "ln(1 + total_frequency::DOUBLE)",
}


@query("e_poly", "profile", _sql(POLY).replace(" FROM profile", ", total_monetary * total_monetary AS monetary_squared FROM profile"))
def poly(t):
    # The square is exact in both engines and too large to be rounded to 6 places.
    out = d.with_columns(order_profile(t), d.polynomials())
    return out.select(KEY, *[F.round(c, 6).alias(c) for c in POLY], "monetary_squared")


@query(
    "e_tenure", "profile customers",
    f"""SELECT c.customer_id, greatest({sql_days(CUT, 'customer_since::TIMESTAMP')}, 0) AS tenure_clipped,
          {sql_days(CUT, 'customer_since::TIMESTAMP')} AS tenure_raw, coalesce(customer_tenure_days, 365) AS from_first_purchase
        FROM customers c LEFT JOIN profile p ON c.customer_id = p.customer_id""",
)
def tenure(t):
    since = t.customers.withColumn("customer_since", F.col("customer_since").cast("timestamp_ntz"))
    out = since.join(order_profile(t).select(KEY, "customer_tenure_days"), KEY, "left")
    return out.select(
        KEY, d.tenure(SPEC, "customer_since", clipped=True).alias("tenure_clipped"), d.tenure(SPEC, "customer_since").alias("tenure_raw"),
        F.coalesce("customer_tenure_days", F.lit(365)).alias("from_first_purchase"),
    )


@query(
    "e_fills", "customers profile",
    """SELECT c.customer_id, coalesce(total_frequency, 0) AS total_frequency, coalesce(total_monetary, 0) AS total_monetary,
          coalesce(CASE WHEN loyalty_status <> 'Gold' THEN loyalty_status END, 'Unknown') AS loyalty_status, segment_id
        FROM customers c LEFT JOIN profile p ON c.customer_id = p.customer_id""",
)
def fills(t):
    tier = F.when(F.col("loyalty_status") != "Gold", F.col("loyalty_status"))
    joined = t.customers.select(KEY, tier.alias("loyalty_status"), "segment_id").join(
        order_profile(t).select(KEY, "total_frequency", "total_monetary"), KEY, "left"
    )
    return d.fill_features(joined)


@query(
    "e_cap_log", "split",
    """WITH c AS (SELECT quantile_cont(future_spend_30d, 0.99) AS cap FROM split WHERE split = 'train' AND future_spend_30d > 0)
       SELECT customer_id, round(least(future_spend_30d, cap), 4) AS capped, round(ln(1 + least(future_spend_30d, cap)), 4) AS logged,
              round(least(future_spend_30d, cap), 4) AS back FROM split, c""",
)
def cap_log(t):
    split = temporal_split(customer_table(t))
    capped = clip("future_spend_30d", high=F.col("_k.cap"))
    return rounded(attach(split, d.target_cap(split.filter("split = 'train'"))).select(KEY, capped.alias("capped"), d.log_target(capped).alias("logged"), d.unlog_target(d.log_target(capped)).alias("back")))


@query(
    "e_cap_all_train", "split",
    "SELECT round(quantile_cont(future_spend_30d, 0.99), 4) AS cap FROM split WHERE split = 'train'",
)
def cap_all_train(t):
    return rounded(d.target_cap(temporal_split(customer_table(t)).filter("split = 'train'"), of="train"))


@query(
    "e_bucket", "scored",
    """SELECT customer_id, CAST(CASE WHEN s > 1000 THEN 4 WHEN s > 500 THEN 3 WHEN s > 100 THEN 2 WHEN s > 0 THEN 1 ELSE 0 END AS INT) AS bucket,
          CASE WHEN s > 1000 THEN 1500 WHEN s > 500 THEN 750 WHEN s > 100 THEN 300 WHEN s > 0 THEN 50 ELSE 0 END::DOUBLE AS bucket_value
       FROM (SELECT customer_id, predicted / 100 AS s FROM scored)""",
)
def bucket(t):
    out = scored(t).select(KEY, d.spend_bucket(F.col("predicted") / 100).alias("bucket"))
    return out.withColumn("bucket_value", d.bucket_value("bucket"))


SMALL = "(SELECT customer_id, round(predicted / 500, 2) AS s FROM scored)"


def _small(t):
    return scored(t).select(KEY, F.round(F.col("predicted") / 500, 2).alias("s"))


@query(
    "e_tier_score", "scored",
    f"""SELECT customer_id, CASE WHEN s <= -1 THEN NULL WHEN s <= 0 THEN 'Zero' WHEN s <= 25 THEN 'Low' WHEN s <= 75 THEN 'Medium'
          WHEN s <= 200 THEN 'High' ELSE 'VIP' END AS spend_category FROM {SMALL}""",
)
def tier_score(t):
    return _small(t).select(KEY, d.score_tier("s").alias("spend_category"))


@query(
    "e_tier_value", "scored",
    f"""SELECT customer_id, tier, CASE tier WHEN 'High Value' THEN 'Exclusive offers and priority support' WHEN 'Medium-High Value' THEN 'Loyalty rewards'
          WHEN 'Medium Value' THEN 'Personalized campaigns' WHEN 'Low Value' THEN 'Re-engagement campaign' ELSE 'Win-back strategy' END AS action
        FROM (SELECT customer_id, CASE WHEN s = 0 THEN 'Inactive' WHEN s < 100 THEN 'Low Value' WHEN s < 300 THEN 'Medium Value'
                WHEN s < 500 THEN 'Medium-High Value' ELSE 'High Value' END AS tier FROM {SMALL})""",
)
def tier_value(t):
    return _small(t).select(KEY, d.value_tier("s").alias("tier")).withColumn("action", d.recommended_action("tier"))


@query(
    "e_band", "scored",
    f"SELECT customer_id, s, round(greatest(s - 42.93, 0), 4) AS prediction_range_low, round(s + 42.93, 4) AS prediction_range_high FROM {SMALL}",
)
def band(t):
    return rounded(d.with_columns(_small(t), d.prediction_band("s", 42.93)))


@query(
    "e_score_rates", "scored",
    """SELECT customer_id, round(predicted / 30, 4) AS daily_average, round(predicted / 4.3::DOUBLE, 4) AS weekly_average,
          round((predicted - m) / m * 100, 4) AS pct_vs_average FROM scored, (SELECT avg(future_spend_30d) AS m FROM scored)""",
)
def score_rates(t):
    base = scored(t)
    rates = d.score_rates("predicted", F.col("_k.m"))
    out = attach(base, base.agg(F.avg("future_spend_30d").alias("m")))
    return rounded(d.with_columns(out, rates).select(KEY, *rates))


SEGMENTS = """WITH q AS (SELECT quantile_cont(recency, 1/3::DOUBLE) AS r1, quantile_cont(recency, 2/3::DOUBLE) AS r2, quantile_cont(frequency, 1/3::DOUBLE) AS f1,
    quantile_cont(frequency, 2/3::DOUBLE) AS f2, quantile_cont(monetary, 1/3::DOUBLE) AS m1, quantile_cont(monetary, 2/3::DOUBLE) AS m2 FROM rfm)
  SELECT customer_id, CASE WHEN recency <= r1 AND frequency > f2 AND monetary > m2 THEN 'Champions'
    WHEN recency > r2 AND (frequency <= f1 OR monetary <= m1) THEN 'Lost' WHEN recency > r2 THEN 'At Risk' ELSE 'Loyal' END AS behaviour_segment FROM rfm, q"""


@query("e_segments", "rfm", SEGMENTS)
def segments(t):
    return d.behaviour_segments(customer_rfm(t.header)).select(KEY, "behaviour_segment")


@query(
    "e_activity", "profile",
    """SELECT customer_id, CAST(recency_days <= 30 AS INT) AS is_active_30d, CAST(recency_days <= 60 AS INT) AS is_active_60d,
         CASE WHEN customer_tenure_days <= 90 THEN '0-3 months' WHEN customer_tenure_days <= 180 THEN '3-6 months'
              WHEN customer_tenure_days <= 365 THEN '6-12 months' WHEN customer_tenure_days <= 730 THEN '1-2 years' ELSE '2+ years' END AS tenure_bucket FROM profile""",
)
def activity(t):
    out = d.with_columns(order_profile(t), d.activity_flags(), {"tenure_bucket": d.tenure_bucket("customer_tenure_days")})
    return out.select(KEY, "is_active_30d", "is_active_60d", "tenure_bucket")


@query(
    "e_diversity", "header lines products",
    """WITH s AS (SELECT customer_id, product_category, sum(line_item_amount)::DOUBLE AS a FROM header JOIN lines USING (transaction_id)
         JOIN products USING (product_id) WHERE transaction_date < TIMESTAMP '2001-01-01' GROUP BY 1, 2),
       p AS (SELECT customer_id, a / sum(a) OVER (PARTITION BY customer_id) AS p FROM s)
       SELECT customer_id, abs(round(sum(-p * ln(p)) / ln(6), 4)) AS category_diversity FROM p GROUP BY 1""",
)
def diversity(t):
    shares = basket_features(t.lines, t.header, t.products, SPEC, CATEGORIES)
    score = d.category_diversity([share_column(c) for c in CATEGORIES])
    return shares.select(KEY, F.abs(F.round(score, 4)).alias("category_diversity"))


@query(
    "x_day_part", "purchases",
    """SELECT transaction_id, CASE WHEN h >= 6 AND h < 12 THEN 'morning' WHEN h >= 12 AND h < 17 THEN 'afternoon' WHEN h >= 17 AND h < 21 THEN 'evening' ELSE 'night' END AS part,
         ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][w] AS weekday
       FROM (SELECT transaction_id, hour(transaction_date) AS h, isodow(transaction_date) AS w FROM purchases)""",
)
def part_of_day(t):
    return t.purchases.select(
        "transaction_id", day_part(F.hour("transaction_date")).alias("part"), weekday_name(F.weekday("transaction_date")).alias("weekday")
    )


@query("x_pad_id", "customers", "SELECT customer_id, 'C' || lpad(CAST(customer_id AS VARCHAR), greatest(5, length(CAST(customer_id AS VARCHAR)))::INT, '0') AS padded FROM customers")
def padded_id(t):
    return t.customers.select(KEY, pad_id("C", KEY, 5).alias("padded"))


# -- whole feature families -----------------------------------------------------------
def _family_sql(columns):
    """Columns of a family from the SQL order profile, customers and codes."""
    return f"""WITH f AS (SELECT p.*, loyalty_status, segment_id, c.total_loyalty_points AS points, v.num_stores_visited,
           {GAP} AS avg_days_between_purchases,
           CAST(dense_rank() OVER (ORDER BY loyalty_status) - 1 AS BIGINT) AS loyalty_status_encoded,
           CAST(dense_rank() OVER (ORDER BY segment_id) - 1 AS BIGINT) AS segment_id_encoded
         FROM profile p LEFT JOIN customers c ON p.customer_id = c.customer_id
           JOIN (SELECT customer_id, count(DISTINCT store_id) AS num_stores_visited FROM sales WHERE {PAST} GROUP BY 1) v ON p.customer_id = v.customer_id)
       SELECT customer_id, {', '.join(f'{e} AS {n}' if e != n else n for n, e in columns.items())} FROM f"""


_NOISY = ("std_order_value", "order_value_cv", "order_cv", "std_dow")


def _family(t, family):
    spec = FeatureSpec(ORDER_CUTOFF, lookbacks=(7, 14, 30, 60, 90))
    out = order_features(t.header, t.lines, t.customers, spec, family)
    return out.select(KEY, *[F.round(c, 4).alias(c) if c in _NOISY else F.col(c) for c in PRESETS[family]])


def _columns(family, **formulas):
    known = {c: c for c in PRESETS[family]}
    known |= {"std_order_value": "round(std_order_value, 4)"}
    if "total_loyalty_points" in known:
        known["total_loyalty_points"] = "coalesce(points, 0)"
    return {c: formulas.get(c, e) for c, e in known.items() if c in PRESETS[family]}


CV = f"round({SPREAD['order_value_cv']}, 4)"


@query("e_family_momentum", "profile sales customers", _family_sql(_columns("momentum32", **MOMENTUM, **SHORT, order_value_range="max_order - min_order", order_value_cv=CV)))
def family_momentum(t):
    return _family(t, "momentum32")


@query("e_family_two_stage", "profile sales customers", _family_sql(_columns("two_stage", **MOMENTUM, **SHORT, order_value_range="max_order - min_order", order_value_cv=CV)))
def family_two_stage(t):
    return _family(t, "two_stage")


@query(
    "e_family_velocity", "profile sales customers",
    _family_sql(
        _columns(
            "velocity", **VELOCITY, order_value_range="max_order - min_order", order_value_cv=CV, spend_trend=TREND["spend_trend"],
            recency_score=TREND["recency_score"], purchase_overdue_ratio=TREND["overdue_ratio"],
            momentum_monetary=MOMENTUM["momentum_monetary_30d"], momentum_frequency=MOMENTUM["momentum_frequency_30d"],
            avg_dow="avg_dow", std_dow="round(std_dow, 4)", weekend_ratio="weekend_ratio", avg_hour="avg_hour", active_months="active_months",
        )
    ).replace(
        " FROM f",
        f""" FROM f JOIN (SELECT customer_id, sum(isodow(transaction_date) - 1)::DOUBLE / count(*) AS avg_dow,
             coalesce(stddev_samp(isodow(transaction_date) - 1), 0) AS std_dow, sum(CAST(isodow(transaction_date) >= 6 AS INT))::DOUBLE / count(*) AS weekend_ratio,
             sum(hour(transaction_date))::DOUBLE / count(*) AS avg_hour, CAST(count(DISTINCT month(transaction_date)) AS INT) AS active_months
             FROM sales WHERE {PAST} GROUP BY 1) h USING (customer_id)""",
    ),
)
def family_velocity(t):
    return _family(t, "velocity")


PROXY = "(total_monetary * 0.1::DOUBLE)"


@query(
    "e_family_interaction", "profile sales customers",
    _family_sql(
        _columns(
            "interaction", total_loyalty_points=PROXY, rfm_score=INTERACTION["rfm_score"],
            monetary_momentum_30d=MOMENTUM["momentum_monetary_30d"], monetary_momentum_90d=MOMENTUM["momentum_monetary_90d"],
            frequency_momentum_30d=MOMENTUM["momentum_frequency_30d"], order_value_range="max_order - min_order", order_cv=CV,
            recency_score=TREND["recency_score"], loyalty_per_dollar=_ratio(PROXY, "total_monetary"),
            purchase_density=INTERACTION["purchase_density"], monetary_squared="total_monetary * total_monetary",
            monetary_sqrt="sqrt(total_monetary)", frequency_squared=POLY["frequency_squared"],
            log_monetary="round(ln(1 + total_monetary), 6)", log_frequency="round(ln(1 + total_frequency::DOUBLE), 6)",
        )
    ),
)
def family_interaction(t):
    out = _family(t, "interaction")
    return out.withColumns({c: F.round(c, 6) for c in ("log_monetary", "log_frequency")})
