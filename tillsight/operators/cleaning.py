"""Repairs of the seven raw tables. Rows are never dropped here (see routing)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillsight.functions.columns import (
    clip,
    col,
    day_text,
    parse_date,
    shift_days,
    strip,
    title_case,
    valid_email,
    valid_phone,
)
from tillsight.functions.ordering import attach, exact_median
from tillsight.operators.profiling import detect_outliers
from tillsight.session import cut_lineage

# Fixed values -------------------------------------------------------------------
DEFAULT_OPENING_DATE = "2018-01-01"
UNKNOWN_CATEGORY = "Unknown"
MAX_PRICE = 1000
PRICE_SCALE_ERROR = 100
DEFAULT_LOYALTY = "Bronze"
DEFAULT_SEGMENT = "NR"
DEFAULT_FIRST_NAME = "Unknown"
PROMOTION_DAYS = 30
DISCOUNT_TOO_HIGH = 0.5
DEFAULT_DISCOUNT = 0.1
DEFAULT_PROMOTION_CATEGORY = "ALL"
DEFAULT_PROMOTION_NAME = "Unnamed Promotion"
DEFAULT_LINE_PRICE = 20.0
UNKNOWN_STORE = "UNKNOWN"
HEADER_OUTLIER_MULTIPLIER = 3.0
PRICE_AUDIT = "Extreme price outlier (>1000)"
DISCOUNT_AUDIT = "Invalid discount percentage"
# End of fixed values --------------------------------------------------------------


# -- stores ------------------------------------------------------------------------
def store_name_from_city(name: str = "store_name", city: str = "store_city") -> Column:
    return F.coalesce(F.col(name), F.concat(F.col(city), F.lit(" Store")))


def city_from_store_name(name: str = "store_name", city: str = "store_city") -> Column:
    derived = F.when(F.contains(F.col(name), F.lit("Store")), F.replace(F.col(name), F.lit(" Store"), F.lit("")))
    return F.coalesce(F.col(city), derived)


def opening_date(text: str = "opening_date") -> Column:
    return F.coalesce(parse_date(text), F.lit(DEFAULT_OPENING_DATE).cast("timestamp_ntz"))


def clean_stores(stores: DataFrame) -> DataFrame:
    """Name from city, then city from name; opening date as yyyy-MM-dd."""
    return (
        stores.withColumn("store_name", store_name_from_city())
        .withColumn("opening_date", day_text(opening_date()))
        .withColumn("store_city", city_from_store_name())
    )


# -- products ------------------------------------------------------------------------
def canonical_category(c: Column | str = "product_category") -> Column:
    return F.coalesce(title_case(strip(c)), F.lit(UNKNOWN_CATEGORY))


def repaired_price(c: Column | str = "unit_price") -> Column:
    """Sign and scale errors undone; null stays null."""
    price = F.abs(col(c))
    return F.when(price > MAX_PRICE, price / PRICE_SCALE_ERROR).otherwise(price)


def repaired_stock(c: Column | str = "current_stock_level") -> Column:
    return F.coalesce(clip(c, low=0), F.lit(0))


def impute_price(products: DataFrame, price: str = "unit_price", category: str = "product_category") -> DataFrame:
    """Null price: median of the category, else median of all prices.

    Both medians come from one search, in which every price counts for its category and
    for the whole table. The two columns that it reads are written once.
    """
    prices = cut_lineage(products.select(F.col(category).alias("_category"), F.col(price).alias("_price")).filter(F.col(price).isNotNull()))
    scopes = F.array(F.struct(F.lit(False).alias("_all"), F.col("_category").alias("_of")), F.struct(F.lit(True).alias("_all"), F.lit("").alias("_of")))
    medians = exact_median(prices.select("_price", F.inline(scopes)), "_price", ["_all", "_of"], "_median")
    medians = cut_lineage(medians)
    by_category = medians.filter("NOT _all").select(F.col("_of").alias(category), F.col("_median").alias("_category_median"))
    # One row at most.
    overall = medians.filter("_all").agg(F.max("_median").alias("m"))
    joined = attach(products.join(by_category, category, "left"), overall)
    filled = F.coalesce(F.col(price).cast("double"), F.col("_category_median"), F.col("_k.m"))
    return joined.withColumn(price, filled).select(*products.columns)


def repair_products(products: DataFrame) -> DataFrame:
    """All product repairs that need no other row."""
    return (
        products.withColumn("product_category", canonical_category())
        .withColumn("unit_price", repaired_price())
        .withColumn("current_stock_level", repaired_stock())
        .withColumn("product_name", F.coalesce("product_name", F.concat(F.lit("Product_"), F.col("product_id").cast("string"))))
    )


def clean_products(products: DataFrame) -> DataFrame:
    return impute_price(repair_products(products))


def audit_products(products: DataFrame) -> DataFrame:
    """Products whose price was scaled down, with the price before that step.
    They also stay in the clean table."""
    audited = products.withColumn("product_category", canonical_category()).withColumn(
        "unit_price", F.abs("unit_price")
    )
    return audited.filter(F.col("unit_price") > MAX_PRICE).withColumn("rejection_reason", F.lit(PRICE_AUDIT))


# -- customers -----------------------------------------------------------------------
def loyalty_tier(c: Column | str = "loyalty_status") -> Column:
    return title_case(strip(F.coalesce(col(c), F.lit(DEFAULT_LOYALTY))))


def clean_customers(customers: DataFrame) -> DataFrame:
    return customers.withColumns(
        {
            "email": F.when(valid_email("email"), F.col("email")),
            "customer_phone": F.when(valid_phone("customer_phone"), F.col("customer_phone")),
            "last_purchase_date": day_text(parse_date("last_purchase_date")),
            "customer_since": day_text(parse_date("customer_since")),
            "loyalty_status": loyalty_tier(),
            "total_loyalty_points": F.coalesce("total_loyalty_points", F.lit(0)),
            "segment_id": F.coalesce("segment_id", F.lit(DEFAULT_SEGMENT)),
            "first_name": F.coalesce("first_name", F.lit(DEFAULT_FIRST_NAME)),
        }
    )


# -- promotions and rules --------------------------------------------------------------
def discount_is_invalid(c: Column | str = "discount_percentage") -> Column:
    return F.coalesce((col(c) < 0) | (col(c) > 1), F.lit(False))


def repaired_discount(c: Column | str = "discount_percentage") -> Column:
    c = col(c)
    return F.when(c < 0, 0.0).when(c > 1, DISCOUNT_TOO_HIGH).when(c.isNull(), DEFAULT_DISCOUNT).otherwise(c)


def promotion_end(start: Column, end: Column) -> Column:
    return F.coalesce(end, shift_days(start, PROMOTION_DAYS))


def _promotion_dates(promotions: DataFrame) -> DataFrame:
    start, end = parse_date("start_date"), parse_date("end_date")
    return promotions.withColumns(
        {"start_date": day_text(start), "end_date": day_text(promotion_end(start, end))}
    )


def clean_promotions(promotions: DataFrame) -> DataFrame:
    return _promotion_dates(promotions).withColumns(
        {
            "discount_percentage": repaired_discount(),
            "promotion_name": F.coalesce("promotion_name", F.lit(DEFAULT_PROMOTION_NAME)),
            "applicable_category": F.coalesce("applicable_category", F.lit(DEFAULT_PROMOTION_CATEGORY)),
        }
    )


def audit_promotions(promotions: DataFrame) -> DataFrame:
    """Promotions with an impossible discount, as they were; kept in the clean table."""
    return _promotion_dates(promotions.filter(discount_is_invalid())).withColumn(
        "rejection_reason", F.lit(DISCOUNT_AUDIT)
    )


def clean_rules(rules: DataFrame) -> DataFrame:
    return rules.withColumns(
        {
            "rule_name": F.coalesce("rule_name", F.concat(F.lit("Rule_"), F.col("rule_id").cast("string"))),
            "bonus_points": F.coalesce("bonus_points", F.lit(0)),
        }
    )


# -- line amounts and header outliers ---------------------------------------------------
def unique_prices(products: DataFrame, order: str = "unit_price") -> DataFrame:
    """One price per product id: the smallest where an id occurs more than once."""
    return products.groupBy("product_id").agg(F.min(order).alias("_list_price"))


def impute_line_amount(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Null amount: quantity x list price, or quantity x 20 for an unknown product.

    Only lines without an amount meet the price table, so a table of lines is not
    shuffled for the few that need a price. Lines without a product id skip the
    join as well: their null keys would all go to one task.
    """
    amount = F.col("line_item_amount").cast("double")
    needs_price = amount.isNull() & F.col("product_id").isNotNull()
    quantity = F.col("quantity").cast("double")
    priced = lines.filter(needs_price).join(unique_prices(products), "product_id", "left")
    price = F.coalesce(F.col("_list_price").cast("double"), F.lit(DEFAULT_LINE_PRICE))
    filled = priced.withColumn("line_item_amount", quantity * price).select(*lines.columns)
    rest = lines.filter(~needs_price)
    return rest.withColumn("line_item_amount", F.coalesce(amount, quantity * DEFAULT_LINE_PRICE)).unionByName(filled)


def flag_header_outliers(header: DataFrame, amount: str = "total_amount") -> DataFrame:
    """is_outlier = 1 outside three inter-quartile ranges of the accepted rows."""
    flagged = detect_outliers(header, amount, HEADER_OUTLIER_MULTIPLIER)
    return flagged.withColumn("is_outlier", F.col("is_outlier").cast("int"))
