"""Repairs of raw tables."""

from pyspark.sql import functions as F

from tillsight.catalog.registry import query, rounded, sql_parse_date, sql_title
from tillsight.functions.columns import day_text, lenient_timestamp, parse_date, strict_timestamp, timestamp_text
from tillsight.operators import cleaning as c
from tillsight.operators import routing as r
from tillsight.plans.cleaning_job import clean_all

TS = "transaction_date"


@query("c_parse_dates", "raw_header", f"SELECT transaction_id, {sql_parse_date('transaction_date')} AS parsed FROM raw_header")
def parse_dates(t):
    return t.raw_header.select("transaction_id", parse_date(TS).alias("parsed"))


@query(
    "c_date_text", "raw_header",
    f"""SELECT transaction_id, strftime({sql_parse_date('transaction_date')}, '%Y-%m-%d') AS day,
               strftime({sql_parse_date('transaction_date')}, '%Y-%m-%d %H:%M:%S') AS second FROM raw_header""",
)
def date_text(t):
    return t.raw_header.select("transaction_id", day_text(parse_date(TS)).alias("day"), timestamp_text(parse_date(TS)).alias("second"))


@query("io_lenient_cast", "raw_header", "SELECT transaction_id, CASE WHEN transaction_date LIKE '____-__-__ %' OR transaction_date LIKE '____/__/__' THEN CASE WHEN transaction_date LIKE '____-%' THEN try_cast(transaction_date AS TIMESTAMP) END END AS ts FROM raw_header")
def lenient_cast(t):
    return t.raw_header.select("transaction_id", lenient_timestamp(TS).alias("ts"))


@query("io_strict_cast", "header", "SELECT transaction_id, CAST(strftime(transaction_date, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts FROM header")
def strict_cast(t):
    return t.header.select("transaction_id", strict_timestamp(timestamp_text(TS)).alias("ts"))


@query(
    "c_clean_stores", "raw_stores",
    f"""SELECT store_id, name AS store_name, coalesce(store_city, CASE WHEN contains(name, 'Store') THEN replace(name, ' Store', '') END) AS store_city,
               store_region, strftime(coalesce({sql_parse_date('opening_date')}, TIMESTAMP '2018-01-01'), '%Y-%m-%d') AS opening_date
        FROM (SELECT *, coalesce(store_name, store_city || ' Store') AS name FROM raw_stores)""",
)
def clean_stores(t):
    return c.clean_stores(t.raw_stores)


@query("c_category", "raw_products", f"SELECT product_id, coalesce({sql_title('trim(product_category)')}, 'Unknown') AS product_category FROM raw_products")
def category(t):
    return t.raw_products.select("product_id", c.canonical_category().alias("product_category"))


@query(
    "c_price_fix", "clean_products",
    "SELECT product_id, round(repaired, 4) AS unit_price, current_stock_level, product_name FROM clean_products",
)
def price_fix(t):
    return rounded(c.repair_products(t.raw_products).select("product_id", "unit_price", "current_stock_level", "product_name"))


@query(
    "c_price_audit", "raw_products",
    f"""SELECT product_id, product_name, coalesce({sql_title('trim(product_category)')}, 'Unknown') AS product_category,
               round(abs(unit_price), 4) AS unit_price, current_stock_level, 'Extreme price outlier (>1000)' AS rejection_reason
        FROM raw_products WHERE abs(unit_price) > 1000""",
)
def price_audit(t):
    return rounded(c.audit_products(t.raw_products))


PRICED = """SELECT p.product_id, p.product_name, p.product_category,
  coalesce(p.repaired, m.m, (SELECT median(repaired) FROM clean_products)) AS unit_price, p.current_stock_level
  FROM clean_products p LEFT JOIN (SELECT product_category, median(repaired) AS m FROM clean_products GROUP BY 1) m
  ON p.product_category = m.product_category"""


@query("c_price_impute", "clean_products", f"SELECT product_id, product_name, product_category, round(unit_price, 4) AS unit_price, current_stock_level FROM ({PRICED})")
def price_impute(t):
    return rounded(c.clean_products(t.raw_products))


@query(
    "c_clean_customers", "raw_customers",
    rf"""SELECT customer_id, coalesce(first_name, 'Unknown') AS first_name,
         CASE WHEN lower(trim(email)) NOT IN ('n/a','na','null','none','unknown','')
               AND regexp_matches(trim(email), '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,}}$') THEN email END AS email,
         {sql_title("trim(coalesce(loyalty_status, 'Bronze'))")} AS loyalty_status,
         coalesce(total_loyalty_points, 0) AS total_loyalty_points,
         strftime({sql_parse_date('last_purchase_date')}, '%Y-%m-%d') AS last_purchase_date,
         coalesce(segment_id, 'NR') AS segment_id,
         CASE WHEN length(regexp_replace(customer_phone, '[^0-9]', '', 'g')) >= 10 THEN customer_phone END AS customer_phone,
         strftime({sql_parse_date('customer_since')}, '%Y-%m-%d') AS customer_since FROM raw_customers""",
)
def clean_customers(t):
    return c.clean_customers(t.raw_customers)


@query(
    "c_clean_promotions", "raw_promotions",
    f"""SELECT promotion_id, coalesce(promotion_name, 'Unnamed Promotion') AS promotion_name,
         strftime({sql_parse_date('start_date')}, '%Y-%m-%d') AS start_date,
         strftime(coalesce({sql_parse_date('end_date')}, {sql_parse_date('start_date')} + INTERVAL 30 DAY), '%Y-%m-%d') AS end_date,
         CASE WHEN discount_percentage < 0 THEN 0.0::DOUBLE WHEN discount_percentage > 1 THEN 0.5::DOUBLE
              WHEN discount_percentage IS NULL THEN 0.1::DOUBLE ELSE discount_percentage END AS discount_percentage,
         coalesce(applicable_category, 'ALL') AS applicable_category FROM raw_promotions""",
)
def clean_promotions(t):
    return c.clean_promotions(t.raw_promotions)


@query(
    "c_discount_audit", "raw_promotions",
    f"""SELECT promotion_id, promotion_name, strftime({sql_parse_date('start_date')}, '%Y-%m-%d') AS start_date,
         strftime(coalesce({sql_parse_date('end_date')}, {sql_parse_date('start_date')} + INTERVAL 30 DAY), '%Y-%m-%d') AS end_date,
         discount_percentage, applicable_category, 'Invalid discount percentage' AS rejection_reason
        FROM raw_promotions WHERE discount_percentage < 0 OR discount_percentage > 1""",
)
def discount_audit(t):
    return c.audit_promotions(t.raw_promotions)


@query(
    "c_clean_rules", "raw_rules",
    "SELECT rule_id, coalesce(rule_name, 'Rule_' || CAST(rule_id AS VARCHAR)) AS rule_name, coalesce(bonus_points, 0) AS bonus_points FROM raw_rules",
)
def clean_rules(t):
    return c.clean_rules(t.raw_rules)


@query(
    "c_line_amount", "raw_lines products",
    """SELECT line_item_id, round(coalesce(line_item_amount::DOUBLE, quantity * coalesce(p.price, 20.0)), 4) AS line_item_amount
       FROM raw_lines l LEFT JOIN (SELECT product_id, min(unit_price) AS price FROM products GROUP BY 1) p ON l.product_id = p.product_id""",
)
def line_amount(t):
    return rounded(c.impute_line_amount(t.raw_lines, t.products).select("line_item_id", "line_item_amount"))


@query(
    "c_header_outliers", "accepted",
    """WITH f AS (SELECT quantile_cont(total_amount::DOUBLE, 0.25) AS q1, quantile_cont(total_amount::DOUBLE, 0.75) AS q3 FROM accepted)
       SELECT transaction_id, CAST(total_amount::DOUBLE < q1 - 3*(q3-q1) OR total_amount::DOUBLE > q3 + 3*(q3-q1) AS INT) AS is_outlier
       FROM accepted, f""",
)
def header_outliers(t):
    accepted = r.accepted_header(r.tag_header(t.raw_header))
    return c.flag_header_outliers(accepted).select("transaction_id", "is_outlier")


@query(
    "c_clean_lines", "tagged_lines clean_products",
    f"""SELECT l.line_item_id, l.transaction_id, l.product_id, l.promotion_id, l.quantity,
              round(coalesce(l.line_item_amount::DOUBLE, l.quantity * coalesce(p.unit_price, 20.0)), 4) AS line_item_amount
       FROM tagged_lines l LEFT JOIN ({PRICED}) p ON l.product_id = p.product_id WHERE l.rejection_reason IS NULL""",
)
def clean_lines(t):
    raw = {
        "stores": t.raw_stores, "products": t.raw_products, "customer_details": t.raw_customers,
        "promotion_details": t.raw_promotions, "loyalty_rules": t.raw_rules,
        "store_sales_header": t.raw_header, "store_sales_line_items": t.raw_lines,
    }
    return rounded(clean_all(raw, materialise=True).clean["store_sales_line_items"])


@query(
    "c_header_text", "tagged",
    """SELECT transaction_id, customer_id, coalesce(store_id, 'UNKNOWN') AS store_id,
              strftime(parsed_date, '%Y-%m-%d %H:%M:%S') AS transaction_date, total_amount::DOUBLE AS total_amount
       FROM tagged WHERE rejection_reason IS NULL""",
)
def header_text(t):
    out = r.accepted_header(r.tag_header(t.raw_header), as_text=True)
    return out.withColumn("total_amount", F.col("total_amount").cast("double"))
