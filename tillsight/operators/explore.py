"""Descriptive tables: time series, stores, categories, tiers, distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tillsight.functions.columns import as_ntz, days_between, is_weekend, mean, sample_std, shift_days, total, weekday_name
from tillsight.functions.ordering import attach, exact_quantiles
from tillsight.models.gram import correlation_cells

KEY, TS, AMOUNT = "customer_id", "transaction_date", "total_amount"


# -- time ---------------------------------------------------------------------------------
def monthly_sales(header: DataFrame) -> DataFrame:
    rows = header.filter(F.col(TS).isNotNull())
    return rows.groupBy(F.date_trunc("month", TS).cast("date").alias("month")).agg(
        F.count("transaction_id").alias("transactions"), total(AMOUNT).alias("revenue")
    )


def daily_sales(header: DataFrame) -> DataFrame:
    rows = header.filter(F.col(TS).isNotNull())
    return rows.groupBy(F.to_date(TS).alias("day")).agg(
        F.count("transaction_id").alias("transactions"), total(AMOUNT).alias("revenue")
    )


def weekday_sales(header: DataFrame) -> DataFrame:
    """One row per weekday, Monday first; days without sales have count 0."""
    seen = header.filter(F.col(TS).isNotNull()).groupBy(F.weekday(F.col(TS)).alias("dow")).agg(
        F.count("transaction_id").alias("transactions"), mean(AMOUNT).alias("mean_amount")
    )
    calendar = header.sparkSession.range(7).select(F.col("id").cast("int").alias("dow"))
    return (
        calendar.join(F.broadcast(seen), "dow", "left")  # seven rows at most
        .select("dow", weekday_name("dow").alias("weekday"), F.coalesce("transactions", F.lit(0)).alias("transactions"), "mean_amount")
        .orderBy("dow")
    )


def hourly_sales(header: DataFrame) -> DataFrame:
    rows = header.filter(F.col(TS).isNotNull())
    return rows.groupBy(F.hour(TS).alias("hour")).agg(F.count(F.lit(1)).alias("transactions")).orderBy("hour")


def sales_span(header: DataFrame) -> DataFrame:
    first, last = F.min(TS), F.max(TS)
    return header.agg(first.alias("first_sale"), last.alias("last_sale"), days_between(last, first).alias("days"))


# -- stores, regions, categories, tiers -------------------------------------------------------
def store_sales(header: DataFrame) -> DataFrame:
    rows = header.filter(F.col("store_id").isNotNull())
    return rows.groupBy("store_id").agg(
        F.count("transaction_id").alias("transactions"),
        F.round(total(AMOUNT), 2).alias("revenue"),
        F.round(mean(AMOUNT), 2).alias("mean_amount"),
    )


def top_stores(header: DataFrame, n: int = 5) -> DataFrame:
    return store_sales(header).orderBy(F.desc("revenue"), "store_id").limit(n)


def region_sales(header: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue and mean sale per region; folded to stores before the lookup."""
    by_store = header.groupBy("store_id").agg(F.sum(AMOUNT).alias("amt"), F.count(AMOUNT).alias("n"))
    regions = by_store.join(stores.select("store_id", "store_region"), "store_id", "left")
    return regions.filter(F.col("store_region").isNotNull()).groupBy("store_region").agg(
        total("amt").alias("revenue"),
        F.try_divide(F.sum("amt").cast("double"), F.sum("n").cast("double")).alias("mean_amount"),
    )


def category_sales(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, items and sold products per category; folded to products first."""
    by_product = lines.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.sum("line_item_amount").alias("amt"), F.sum("quantity").alias("qty")
    )
    named = by_product.join(products.select("product_id", "product_category"), "product_id", "left")
    return named.filter(F.col("product_category").isNotNull()).groupBy("product_category").agg(
        total("amt").alias("revenue"), total("qty").alias("items_sold"), F.count("product_id").alias("products_sold")
    )


def category_products(products: DataFrame) -> DataFrame:
    return value_shares(products, "product_category", "products")


def value_shares(df: DataFrame, column: str, count: str = "rows") -> DataFrame:
    """Rows of each value and their percentage of all non-null rows."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(count))
    out = attach(counts, df.agg(F.count(column).alias("n")))
    return out.withColumn("pct", F.round(F.col(count) * 100.0 / F.col("_k.n"), 2)).drop("_k")


def sale_per_tier(header: DataFrame, customers: DataFrame, tier: str = "loyalty_status") -> DataFrame:
    """Mean sale per tier; folded to customers before the join, so a customer
    with very many sales joins as one row."""
    by_customer = header.filter(F.col(KEY).isNotNull()).groupBy(KEY).agg(
        F.sum(AMOUNT).alias("amt"), F.count(AMOUNT).alias("n")
    )
    return by_customer.join(customers.select(KEY, tier), KEY).groupBy(tier).agg(
        F.sum("n").alias("transactions"),
        F.try_divide(F.sum("amt").cast("double"), F.sum("n").cast("double")).alias("mean_amount"),
    )


# -- customers ----------------------------------------------------------------------------------
def customer_rfm(header: DataFrame, reference: str | None = None) -> DataFrame:
    """Recency (to the day after the last sale), frequency and spend."""
    rows = header.filter(F.col(KEY).isNotNull())
    rfm = rows.groupBy(KEY).agg(
        F.max(TS).alias("_last"), F.count("transaction_id").alias("frequency"), total(AMOUNT).alias("monetary")
    )
    if reference is None:
        rfm = attach(rfm, header.agg(F.max(TS).alias("t")))
        today = shift_days(F.col("_k.t"), 1)
    else:
        today = as_ntz(reference)
    return rfm.select(KEY, days_between(today, F.col("_last")).alias("recency"), "frequency", "monetary")


def basic_features(header: DataFrame) -> DataFrame:
    """Spend, mean sale, sales and distinct stores of each customer."""
    by_store = header.filter(F.col(KEY).isNotNull()).groupBy(KEY, "store_id").agg(
        F.sum(AMOUNT).alias("amt"), F.count(AMOUNT).alias("amounts"), F.count("transaction_id").alias("n")
    )
    return by_store.groupBy(KEY).agg(
        total("amt").alias("total_spend"),
        F.try_divide(F.sum("amt").cast("double"), F.sum("amounts").cast("double")).alias("avg_transaction"),
        F.sum("n").alias("num_transactions"),
        F.count("store_id").alias("num_stores"),
    )


def spend_of_all_customers(customers: DataFrame, header: DataFrame) -> DataFrame:
    """Every customer with total spend, 0 without sales."""
    spend = header.filter(F.col(KEY).isNotNull()).groupBy(KEY).agg(total(AMOUNT).alias("total_spend"))
    return customers.select(KEY).join(spend, KEY, "left").select(KEY, F.coalesce("total_spend", F.lit(0.0)).alias("total_spend"))


def activity_summary(rfm: DataFrame, active_days: int = 30, churn_days: int = 180, high: float = 0.9) -> DataFrame:
    """Counts and shares of active, churned and high-value customers."""
    counts = attach(rfm, exact_quantiles(rfm, "monetary", {"edge": high})).agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("recency") <= active_days).alias("active"),
        F.count_if(F.col("recency") > churn_days).alias("churned"),
        F.count_if(F.col("monetary") > F.col("_k.edge")).alias("high_value"),
    )
    pct = lambda c: F.round(F.try_divide(F.col(c) * 100.0, F.col("customers")), 1).alias(f"{c}_pct")
    return counts.select("*", pct("active"), pct("churned"), pct("high_value"))


# -- distributions --------------------------------------------------------------------------------
def describe_column(df: DataFrame, value: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles in one row."""
    q = exact_quantiles(df, value, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    stats = df.agg(
        F.count(value).alias("count"),
        mean(value).alias("mean"),
        sample_std(value).alias("std"),
        F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"),
    )
    return attach(stats, q).select("count", "mean", "std", "min", "_k.q25", "_k.q50", "_k.q75", "max")


def skewness(df: DataFrame, value: str) -> DataFrame:
    """Bias-corrected skewness (sample-size adjusted third moment)."""
    n = F.count(value).cast("double")
    adjusted = F.skewness(F.col(value).cast("double")) * F.sqrt(n * (n - 1)) / (n - 2)
    return df.agg(F.when(F.count(value) > 2, adjusted).alias("skewness"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix as rows (x, y, corr); null pairs are left out pair by pair."""
    return correlation_cells(df, {c: F.col(f"`{c}`") for c in columns})


def target_summary(df: DataFrame, target: str = "future_spend_30d") -> DataFrame:
    """Share of zeros, mean, median, deviation, maximum and 99th percentile."""
    q = exact_quantiles(df, target, {"median": 0.5, "p99": 0.99})
    stats = df.agg(
        mean((F.col(target) == 0).cast("int")).alias("zero_share"),
        mean(target).alias("mean"),
        sample_std(target).alias("std"),
        F.max(target).cast("double").alias("max"),
    )
    return attach(stats, q).select("zero_share", "mean", "_k.median", "std", "max", "_k.p99")


def impute_median(df: DataFrame, column: str) -> DataFrame:
    out = attach(df, exact_quantiles(df, column, {"m": 0.5}))
    return out.withColumn(column, F.coalesce(F.col(column).cast("double"), F.col("_k.m"))).drop("_k")


def prediction_summary(scored: DataFrame, score: str = "predicted_spend_30d") -> DataFrame:
    stats = scored.agg(F.count(F.lit(1)).alias("customers"), mean(score).alias("mean_score"))
    middle = exact_quantiles(scored, score, {"median_score": 0.5})
    return attach(stats, middle).select("customers", "mean_score", "_k.median_score")


def weekend_share(header: DataFrame) -> DataFrame:
    """Share of weekend purchases and the majority flag, per customer."""
    rows = header.filter(F.col(KEY).isNotNull())
    share = mean(is_weekend(TS).cast("int"))
    return rows.groupBy(KEY).agg(share.alias("weekend_ratio"), (share > 0.5).cast("int").alias("is_weekend_shopper"))
