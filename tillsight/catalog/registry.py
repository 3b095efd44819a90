"""Registration of queries, and the SQL text that mirrors the table bindings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tillsight.functions.columns import DATE_FORMATS
from tillsight.sources.bindings import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, ctes: str = "", sql: str | None = None):
    """Register ``fn(tables) -> DataFrame``; ``ctes`` names the SQL tables it needs."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = with_ctes(ctes, sql)
        return fn

    return register


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """All double columns rounded, as the SQL does it."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        out.append((F.round(c, digits) if isinstance(f.dataType, T.DoubleType) else c).alias(f.name))
    return df.select(*out)


def with_ctes(names: str, body: str) -> str:
    wanted: list[str] = []

    def add(n: str) -> None:
        for needed in NEEDS.get(n, "").split():
            add(needed)
        if n not in wanted:
            wanted.append(n)

    for n in names.split():
        add(n)
    if not wanted:
        return body
    body = body.strip()
    head = ",\n".join(f"{n} AS ({CTES[n]})" for n in wanted)
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(start):
            return f"{start}{head},\n{body[len(start):]}"
    return f"WITH {head}\n{body}"


def sql_days(later: str, earlier: str) -> str:
    return f"CAST(floor(date_diff('microsecond', {earlier}, {later}) / 86400000000.0) AS BIGINT)"


def sql_parse_date(c: str) -> str:
    """strptime equivalents of the date formats, tried in the same order."""
    names = {
        "yyyy-M-d H:m:s": "%Y-%m-%d %H:%M:%S", "yyyy-M-d H:m": "%Y-%m-%d %H:%M", "yyyy-M-d": "%Y-%m-%d",
        "yyyy/M/d": "%Y/%m/%d", "d/M/yyyy": "%d/%m/%Y", "M-d-yyyy": "%m-%d-%Y",
        "d-M-yyyy H:m": "%d-%m-%Y %H:%M", "d-M-yyyy": "%d-%m-%Y",
    }
    tries = ", ".join(f"try_strptime(trim({c}), '{names[f]}')" for f in DATE_FORMATS)
    return f"coalesce({tries})"


def sql_title(c: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({c}), '\\p{{L}}+|\\P{{L}}+'), "
        "lambda x: upper(x[1]) || x[2:]), '')"
    )


CUT = "TIMESTAMP '2001-01-01'"
PAST = f"transaction_date < {CUT}"
FUTURE = f"transaction_date >= {CUT} AND transaction_date < {CUT} + INTERVAL 30 DAY"


def sql_window(days: int) -> str:
    return f"{PAST} AND transaction_date >= {CUT} - INTERVAL {days} DAY"


def _profile_windows(amount: str, days=(7, 14, 30, 60, 90)) -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE {sql_window(d)}) AS frequency_{d}d, "
        f"coalesce(sum({amount}) FILTER (WHERE {sql_window(d)}), 0)::DOUBLE AS monetary_{d}d"
        for d in days
    )


NEEDS = {
    "rollup": "lines", "sales": "header rollup", "profile": "sales", "features": "profile customers",
    "tagged": "raw_header", "accepted": "tagged", "tagged_lines": "raw_lines accepted",
    "clean_products": "raw_products", "history": "header", "cust": "header", "scored": "cust", "rfm": "header",
    "gaps": "header", "split": "cust", "basic": "header",
}

CTES = {
    "header": """
  SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, CAST(o_orderkey % 25 AS INT) AS store_id,
         o_orderdate AS transaction_date, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount FROM orders""",
    "purchases": """
  SELECT event_id AS transaction_id, user_id AS customer_id, CAST(event_id % 25 AS INT) AS store_id,
         ts AS transaction_date, CAST(value AS DECIMAL(18,2)) AS total_amount FROM events WHERE event_type = 'purchase'""",
    "lines": """
  SELECT l_orderkey * 10 + l_linenumber AS line_item_id, l_orderkey AS transaction_id, l_partkey AS product_id,
         l_returnflag AS promotion_id, l_quantity AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS line_item_amount FROM lineitem""",
    "products": """
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS product_category, p_retailprice AS unit_price,
         p_size AS current_stock_level FROM part""",
    "stores": """
  SELECT n_nationkey AS store_id, n_name AS store_name, r_name AS store_region
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "customers": """
  SELECT c_custkey AS customer_id, c_name AS first_name,
         CASE c_nationkey % 4 WHEN 0 THEN 'Bronze' WHEN 1 THEN 'Silver' WHEN 2 THEN 'Gold' ELSE 'Platinum' END AS loyalty_status,
         c_acctbal AS total_loyalty_points, c_mktsegment AS segment_id,
         DATE '1994-01-01' + CAST(c_custkey % 3000 AS INT) AS customer_since FROM customer""",
    "raw_header": """
  SELECT o_orderkey AS transaction_id,
         CASE WHEN o_orderkey % 20 <> 0 THEN o_custkey END AS customer_id,
         CASE WHEN o_orderkey % 33 <> 1 THEN CAST(o_orderkey % 25 AS VARCHAR) END AS store_id,
         CASE WHEN o_orderkey % 50 = 7 THEN NULL WHEN o_orderkey % 50 = 11 THEN 'garbage'
              WHEN o_orderkey % 50 = 13 THEN strftime(o_orderdate, '%d-%m-%Y %H:%M')
              WHEN o_orderkey % 50 = 17 THEN strftime(o_orderdate, '%Y/%m/%d')
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS transaction_date,
         CAST(CASE WHEN o_orderkey % 97 = 5 THEN -o_totalprice WHEN o_orderkey % 41 <> 3 THEN o_totalprice END AS DECIMAL(18,2)) AS total_amount
  FROM orders""",
    "raw_lines": """
  SELECT l_orderkey * 10 + l_linenumber AS line_item_id,
         CASE WHEN l_partkey % 83 = 0 THEN NULL WHEN (l_orderkey + l_linenumber) % 71 = 0 THEN l_orderkey + 1000000000
              ELSE l_orderkey END AS transaction_id,
         CASE WHEN (l_orderkey + l_linenumber) % 47 <> 2 THEN l_partkey END AS product_id,
         CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS promotion_id,
         CASE WHEN (l_orderkey + l_linenumber) % 61 = 3 THEN 0.0 WHEN (l_orderkey + l_linenumber) % 37 = 4 THEN -l_quantity
              WHEN (l_orderkey + l_linenumber) % 53 <> 5 THEN l_quantity END::DOUBLE AS quantity,
         CASE WHEN (l_orderkey + l_linenumber) % 43 <> 6 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS line_item_amount
  FROM lineitem""",
    "raw_products": """
  SELECT p_partkey AS product_id, CASE WHEN p_partkey % 20 <> 6 THEN p_name END AS product_name,
         CASE WHEN p_partkey % 50 = 3 THEN NULL WHEN p_partkey % 30 = 4 THEN lower(p_type)
              WHEN p_partkey % 40 = 5 THEN p_type || ' & co-op ' ELSE p_type END AS product_category,
         CASE WHEN p_partkey % 33 = 7 THEN NULL WHEN p_partkey % 50 = 8 THEN -p_retailprice
              WHEN p_partkey % 70 = 9 THEN p_retailprice * 100 ELSE p_retailprice / 10 END AS unit_price,
         CASE WHEN p_partkey % 19 = 2 THEN NULL WHEN p_partkey % 23 = 1 THEN -p_size ELSE p_size END AS current_stock_level
  FROM part""",
    "raw_customers": """
  SELECT *, strftime_text AS last_purchase_date, strftime_text AS customer_since FROM (
  SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 25 <> 9 THEN c_name END AS first_name,
         CASE WHEN c_custkey % 30 = 1 THEN lower(replace(c_name, '#', '.')) || 'mail.com' WHEN c_custkey % 50 = 2 THEN 'N/A'
              WHEN c_custkey % 20 = 3 THEN NULL ELSE ' ' || lower(replace(c_name, '#', '.')) || '@mail.com' END AS email,
         CASE WHEN c_custkey % 15 = 2 THEN NULL WHEN c_custkey % 15 = 3 THEN lower(tier) || ' ' ELSE tier END AS loyalty_status,
         CASE WHEN c_custkey % 18 <> 4 THEN c_acctbal END AS total_loyalty_points,
         CASE WHEN c_custkey % 22 <> 5 THEN c_mktsegment END AS segment_id,
         CASE WHEN c_custkey % 33 = 1 THEN '12345' WHEN c_custkey % 50 = 4 THEN 'unknown' WHEN c_custkey % 12 = 5 THEN NULL
              ELSE '(' || substr(lpad(CAST(c_custkey AS VARCHAR), 10, '5'), 1, 3) || ') '
                   || substr(lpad(CAST(c_custkey AS VARCHAR), 10, '5'), 4, 7) END AS customer_phone,
         CASE WHEN c_custkey % 20 = 6 THEN strftime(since, '%d/%m/%Y') WHEN c_custkey % 20 = 7 THEN strftime(since, '%m-%d-%Y')
              WHEN c_custkey % 33 = 8 THEN NULL ELSE strftime(since, '%Y-%m-%d') END AS strftime_text
  FROM (SELECT *, DATE '1994-01-01' + CAST(c_custkey % 3000 AS INT) AS since,
               CASE c_nationkey % 4 WHEN 0 THEN 'Bronze' WHEN 1 THEN 'Silver' WHEN 2 THEN 'Gold' ELSE 'Platinum' END AS tier
        FROM customer))""",
    "raw_stores": """
  SELECT s_suppkey AS store_id, CASE WHEN s_suppkey % 10 <> 3 THEN n_name || ' Store' END AS store_name,
         CASE WHEN s_suppkey % 30 <> 4 AND s_suppkey % 30 <> 13 THEN n_name END AS store_city, r_name AS store_region,
         CASE WHEN s_suppkey % 20 = 1 THEN strftime(DATE '2001-01-01' + CAST(s_suppkey % 5000 AS INT), '%Y/%m/%d')
              WHEN s_suppkey % 20 = 2 THEN 'soon'
              ELSE strftime(DATE '2001-01-01' + CAST(s_suppkey % 5000 AS INT), '%Y-%m-%d') END AS opening_date
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "raw_promotions": """
  SELECT s_suppkey AS promotion_id, CASE WHEN s_suppkey % 20 <> 4 THEN s_name END AS promotion_name,
         strftime(DATE '2000-01-01' + CAST(s_suppkey % 700 AS INT), '%Y-%m-%d') AS start_date,
         CASE WHEN s_suppkey % 15 <> 5 THEN strftime(DATE '2000-01-15' + CAST(s_suppkey % 700 AS INT), '%d/%m/%Y') END AS end_date,
         CASE WHEN s_suppkey % 30 = 1 THEN 1.295::DOUBLE WHEN s_suppkey % 40 = 2 THEN -0.1::DOUBLE
              WHEN s_suppkey % 25 = 3 THEN NULL ELSE (s_suppkey % 50) / 100 END AS discount_percentage,
         CASE WHEN s_suppkey % 33 <> 6 THEN 'C' || CAST(s_nationkey AS VARCHAR) END AS applicable_category
  FROM supplier""",
    "raw_rules": """
  SELECT s_suppkey AS rule_id, CASE WHEN s_suppkey % 6 <> 5 THEN s_name END AS rule_name,
         CASE WHEN s_suppkey % 7 <> 3 THEN CAST(s_suppkey % 100 AS INT) END AS bonus_points FROM supplier""",
    # Routing
    "tagged": f"""
  SELECT *, CASE WHEN customer_id IS NULL THEN 'Missing customer_id - cannot attribute transaction'
                 WHEN parsed_date IS NULL THEN 'Invalid transaction date'
                 WHEN total_amount < 0 THEN 'Negative total amount'
                 WHEN total_amount IS NULL THEN 'Missing total amount' END AS rejection_reason
  FROM (SELECT *, {sql_parse_date('transaction_date')} AS parsed_date FROM raw_header)""",
    "accepted": """
  SELECT transaction_id, customer_id, coalesce(store_id, 'UNKNOWN') AS store_id, parsed_date AS transaction_date, total_amount
  FROM tagged WHERE rejection_reason IS NULL""",
    "tagged_lines": """
  SELECT l.*, CASE WHEN l.transaction_id IS NULL THEN 'Missing transaction_id'
                   WHEN a.transaction_id IS NULL THEN 'Transaction was rejected'
                   WHEN quantity = 0 THEN 'Zero quantity'
                   WHEN quantity < 0 THEN 'Negative quantity (possible return)'
                   WHEN quantity IS NULL THEN 'Missing quantity'
                   WHEN product_id IS NULL THEN 'Missing product_id' END AS rejection_reason
  FROM raw_lines l LEFT JOIN (SELECT DISTINCT transaction_id FROM accepted) a ON l.transaction_id = a.transaction_id""",
    "clean_products": f"""
  SELECT product_id, coalesce(product_name, 'Product_' || CAST(product_id AS VARCHAR)) AS product_name,
         coalesce({sql_title('trim(product_category)')}, 'Unknown') AS product_category,
         CASE WHEN abs(unit_price) > 1000 THEN abs(unit_price) / 100 ELSE abs(unit_price) END AS repaired,
         coalesce(greatest(current_stock_level, 0), 0) AS current_stock_level
  FROM raw_products""",
    # Customers
    "rollup": """
  SELECT transaction_id, sum(line_item_amount) AS line_total, sum(quantity) AS quantity,
         count(DISTINCT product_id) AS num_products FROM lines GROUP BY transaction_id""",
    "sales": "SELECT h.*, r.line_total, r.quantity, r.num_products FROM header h JOIN rollup r USING (transaction_id)",
    "profile": f"""
  SELECT customer_id, count(*) FILTER (WHERE {PAST}) AS total_frequency,
         (sum(line_total) FILTER (WHERE {PAST}))::DOUBLE AS total_monetary,
         (sum(line_total) FILTER (WHERE {PAST}))::DOUBLE / count(*) FILTER (WHERE {PAST}) AS avg_order_value,
         coalesce(stddev_samp(line_total::DOUBLE) FILTER (WHERE {PAST}), 0) AS std_order_value,
         (min(line_total) FILTER (WHERE {PAST}))::DOUBLE AS min_order,
         (max(line_total) FILTER (WHERE {PAST}))::DOUBLE AS max_order,
         min(transaction_date) FILTER (WHERE {PAST}) AS first_purchase,
         max(transaction_date) FILTER (WHERE {PAST}) AS last_purchase,
         (sum(quantity) FILTER (WHERE {PAST}))::DOUBLE AS total_quantity,
         (sum(quantity) FILTER (WHERE {PAST}))::DOUBLE / count(*) FILTER (WHERE {PAST}) AS avg_quantity,
         CAST(sum(num_products) FILTER (WHERE {PAST}) AS BIGINT) AS total_products,
         (sum(num_products) FILTER (WHERE {PAST}))::DOUBLE / count(*) FILTER (WHERE {PAST}) AS avg_products_per_order,
         {sql_days(CUT, f'max(transaction_date) FILTER (WHERE {PAST})')} AS recency_days,
         {sql_days(CUT, f'min(transaction_date) FILTER (WHERE {PAST})')} AS customer_tenure_days,
         {_profile_windows('line_total')},
         coalesce(sum(line_total) FILTER (WHERE {FUTURE}), 0)::DOUBLE AS future_spend_30d,
         count(*) FILTER (WHERE {FUTURE}) AS future_transactions_30d,
         CAST(coalesce(sum(line_total) FILTER (WHERE {FUTURE}), 0) > 0 AS INT) AS will_purchase_30d
  FROM sales GROUP BY customer_id HAVING count(*) FILTER (WHERE {PAST}) > 0""",
    "cust": f"""
  SELECT customer_id, count(*) FILTER (WHERE {PAST}) AS total_frequency,
         (sum(total_amount) FILTER (WHERE {PAST}))::DOUBLE AS total_monetary,
         min(transaction_date) FILTER (WHERE {PAST}) AS first_purchase,
         max(transaction_date) FILTER (WHERE {PAST}) AS last_purchase,
         {sql_days(CUT, f'max(transaction_date) FILTER (WHERE {PAST})')} AS recency_days,
         {_profile_windows('total_amount', (30, 60, 90))},
         coalesce(sum(total_amount) FILTER (WHERE {FUTURE}), 0)::DOUBLE AS future_spend_30d,
         count(*) FILTER (WHERE {FUTURE}) AS future_transactions_30d,
         CAST(coalesce(sum(total_amount) FILTER (WHERE {FUTURE}), 0) > 0 AS INT) AS will_purchase_30d
  FROM header GROUP BY customer_id HAVING count(*) FILTER (WHERE {PAST}) > 0""",
    # A stand-in score from features, the same in both engines.
    "scored": """
  SELECT customer_id, last_purchase, future_spend_30d, will_purchase_30d, monetary_90d / 3 AS predicted,
         frequency_90d / (frequency_90d + 1.0) AS probability, total_monetary / total_frequency AS amount FROM cust""",
    "split": """
  SELECT *, CASE WHEN row_number() OVER (ORDER BY last_purchase, md5(CAST(customer_id AS VARCHAR)))
                 <= floor(0.8::DOUBLE * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split FROM cust""",
    "rfm": f"""
  SELECT customer_id, {sql_days("(SELECT max(transaction_date) + INTERVAL 1 DAY FROM header)", 'max(transaction_date)')} AS recency,
         count(*) AS frequency, sum(total_amount)::DOUBLE AS monetary FROM header GROUP BY customer_id""",
    "basic": """
  SELECT customer_id, sum(total_amount)::DOUBLE AS total_spend, sum(total_amount)::DOUBLE / count(*) AS avg_transaction,
         count(*) AS num_transactions, count(DISTINCT store_id) AS num_stores FROM header GROUP BY customer_id""",
}
