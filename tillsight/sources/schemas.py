"""Schemas of the raw and derived tables, and named feature sets."""

from __future__ import annotations

# Raw tables: anything that can be dirty is read as text.
RAW = {
    "stores": "store_id STRING, store_name STRING, store_city STRING, store_region STRING, opening_date STRING",
    "products": "product_id STRING, product_name STRING, product_category STRING, unit_price DOUBLE, current_stock_level DOUBLE",
    "customer_details": (
        "customer_id STRING, first_name STRING, email STRING, loyalty_status STRING, total_loyalty_points DOUBLE, "
        "last_purchase_date STRING, segment_id STRING, customer_phone STRING, customer_since STRING"
    ),
    "promotion_details": (
        "promotion_id STRING, promotion_name STRING, start_date STRING, end_date STRING, "
        "discount_percentage DOUBLE, applicable_category STRING"
    ),
    "loyalty_rules": (
        "rule_id INT, rule_name STRING, points_per_unit_spend DOUBLE, min_spend_threshold INT, bonus_points DOUBLE"
    ),
    "store_sales_header": (
        "transaction_id STRING, customer_id STRING, store_id STRING, transaction_date STRING, "
        "total_amount DOUBLE, customer_phone STRING"
    ),
    "store_sales_line_items": (
        "line_item_id BIGINT, transaction_id STRING, product_id STRING, promotion_id STRING, "
        "quantity DOUBLE, line_item_amount DOUBLE"
    ),
}

# Groups of the customer feature table.
LOOKBACKS = (30, 60, 90, 180, 365)
CATEGORIES = [
    "Apparel", "Automotive", "Beauty", "Books", "Electronics", "Grocery",
    "Home & Garden", "Jewelry", "Sports", "Toys", "Unknown",
]


def feature_groups(categories=CATEGORIES, lookbacks=LOOKBACKS) -> dict[str, list[str]]:
    """Feature names by group; the full set is their concatenation (51 by default)."""
    windows = [f(d) for d in lookbacks for f in (lambda d: f"monetary_{d}d", lambda d: f"avg_order_value_{d}d")]
    return {
        "rfm": [
            "recency_days", "frequency_total", *[f"frequency_{d}d" for d in lookbacks],
            "monetary_total", "avg_order_value", "max_order_value", "min_order_value", "std_order_value", *windows,
        ],
        "products": [
            "unique_categories", "unique_products", "total_items_purchased", "top_category",
            *["pct_spend_" + c.lower().replace(" ", "_") for c in categories],
        ],
        "stores": ["unique_stores", "unique_regions", "primary_store_id", "primary_region"],
        "attributes": ["loyalty_status", "total_loyalty_points", "segment_id", "tenure_days"],
        "behaviour": [
            "avg_days_between_purchases", "std_days_between_purchases", "avg_purchase_hour",
            "preferred_time_of_day", "preferred_day", "weekend_transaction_pct",
        ],
    }


TARGETS = ["future_spend_30d", "future_transactions_30d", "will_purchase_30d"]

_WINDOWS = [f"{m}_{d}d" for d in (30, 60, 90) for m in ("monetary", "frequency")]
_ORDERS = [
    "total_frequency", "total_monetary", "avg_order_value", "std_order_value", "min_order", "max_order",
    "num_stores_visited", "total_quantity", "avg_quantity", "total_products", "avg_products_per_order",
    "recency_days", "customer_tenure_days", "avg_days_between_purchases",
]
_SHORT_TERM = ["ratio_30d_90d_monetary", "ratio_30d_90d_frequency"]

# Named feature sets of the model families.
PRESETS: dict[str, list[str]] = {
    "base51": [f for group in feature_groups().values() for f in group],
    "rfm19": [
        "recency_days", "frequency_30d", "frequency_60d", "frequency_90d",
        "monetary_30d", "monetary_60d", "monetary_90d", "total_frequency", "total_monetary",
        "avg_order_value", "num_stores_visited", "avg_days_between_purchases",
        "total_loyalty_points", "customer_tenure_days", "num_categories", "is_weekend_shopper",
        "loyalty_status_encoded", "segment_id_encoded", "top_category_encoded",
    ],
    "momentum32": [
        *_ORDERS, *_WINDOWS,
        "momentum_monetary_30d", "momentum_monetary_60d", "momentum_monetary_90d",
        "momentum_frequency_30d", "momentum_frequency_60d", *_SHORT_TERM,
        "order_value_range", "order_value_cv", "total_loyalty_points",
        "loyalty_status_encoded", "segment_id_encoded",
    ],
    "two_stage": [
        *_ORDERS, *_WINDOWS,
        "momentum_monetary_30d", "momentum_monetary_90d", "momentum_frequency_30d", "ratio_30d_90d_monetary",
        "order_value_range", "order_value_cv", "total_loyalty_points",
        "loyalty_status_encoded", "segment_id_encoded",
    ],
    "interaction": [
        *[c for c in _ORDERS if c not in ("total_products", "avg_products_per_order")], *_WINDOWS,
        "total_loyalty_points", "rfm_score", "monetary_momentum_30d", "monetary_momentum_90d",
        "frequency_momentum_30d", "order_value_range", "order_cv", "recency_score", "loyalty_per_dollar",
        "purchase_density", "monetary_squared", "monetary_sqrt", "frequency_squared", "log_monetary", "log_frequency",
    ],
    "velocity": [
        *_ORDERS, "monetary_7d", "frequency_7d", "monetary_14d", "frequency_14d", *_WINDOWS,
        "avg_dow", "std_dow", "weekend_ratio", "avg_hour", "active_months",
        "velocity_7d_30d", "velocity_30d_90d", "velocity_14d_60d", "spend_trend",
        "freq_velocity_7d_30d", "freq_velocity_30d_90d", "purchase_overdue_ratio",
        "momentum_monetary", "momentum_frequency", "order_value_range", "order_value_cv",
        "total_loyalty_points", "loyalty_status_encoded", "segment_id_encoded", "recency_score",
    ],
}
