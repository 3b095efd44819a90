"""Profiling, validation and outlier queries."""

from pyspark.sql import functions as F

from tillsight.catalog.registry import PAST, query, rounded
from tillsight.catalog.views import WIDE, customer_table
from tillsight.functions.columns import null_tokens_to_null, valid_email, valid_phone
from tillsight.operators import customer as cu
from tillsight.operators import profiling as p
from tillsight.operators import routing as r
from tillsight.operators.splits import temporal_split


def _missing_sql(table, name, columns):
    parts = [
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing, "
        f"round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2)::DOUBLE AS missing_pct FROM {table}"
        for c in columns
    ]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE missing > 0"


HEADER_COLUMNS = ["transaction_id", "customer_id", "store_id", "transaction_date", "total_amount"]
PRODUCT_COLUMNS = ["product_id", "product_name", "product_category", "unit_price", "current_stock_level"]


@query("q_missing_profile", "raw_header", _missing_sql("raw_header", "store_sales_header", HEADER_COLUMNS))
def missing_profile(t):
    return p.missing_profile(t.raw_header, "store_sales_header")


@query("q_missing_products", "raw_products", _missing_sql("raw_products", "products", PRODUCT_COLUMNS))
def missing_products(t):
    return p.missing_profile(t.raw_products, "products")


@query(
    "q_null_totals", "raw_header accepted",
    """SELECT 'raw' AS table_name, CAST(sum(CAST(customer_id IS NULL AS INT) + CAST(store_id IS NULL AS INT)
         + CAST(transaction_date IS NULL AS INT) + CAST(total_amount IS NULL AS INT)) AS BIGINT) AS null_cells FROM raw_header
       UNION ALL SELECT 'clean', CAST(sum(CAST(customer_id IS NULL AS INT) + CAST(store_id IS NULL AS INT)
         + CAST(transaction_date IS NULL AS INT) + CAST(total_amount IS NULL AS INT)) AS BIGINT) FROM accepted""",
)
def null_totals(t):
    return p.null_total({"raw": t.raw_header, "clean": r.accepted_header(r.tag_header(t.raw_header))})


@query(
    "q_row_counts", "raw_header accepted raw_lines tagged_lines",
    """SELECT 'header' AS table_name, (SELECT count(*) FROM raw_header) AS rows_before, (SELECT count(*) FROM accepted) AS rows_after,
              (SELECT count(*) FROM raw_header) - (SELECT count(*) FROM accepted) AS rows_removed
       UNION ALL SELECT 'lines', (SELECT count(*) FROM raw_lines),
              (SELECT count(*) FROM tagged_lines WHERE rejection_reason IS NULL),
              (SELECT count(*) FROM tagged_lines WHERE rejection_reason IS NOT NULL)""",
)
def row_counts(t):
    accepted = r.accepted_header(r.tag_header(t.raw_header))
    lines = r.accepted_lines(r.tag_lines(t.raw_lines, accepted))
    return p.row_counts({"header": t.raw_header, "lines": t.raw_lines}, {"header": accepted, "lines": lines})


@query(
    "q_reject_share", "tagged",
    """SELECT rejection_reason, count(*) AS rows,
              round(count(*) * 100.0 / (SELECT count(*) FROM tagged WHERE rejection_reason IS NOT NULL), 2)::DOUBLE AS pct_of_rejects,
              round(count(*) * 100.0 / (SELECT count(*) FROM tagged), 2)::DOUBLE AS pct_of_rows
       FROM tagged WHERE rejection_reason IS NOT NULL GROUP BY 1""",
)
def reject_share(t):
    return p.reject_reasons(r.tag_header(t.raw_header))


@query(
    "q_reject_rates", "tagged tagged_lines",
    """SELECT 'header' AS table_name, count(*) AS rows, count(rejection_reason) AS rejected,
              round(count(rejection_reason) * 100.0 / count(*), 2)::DOUBLE AS reject_pct FROM tagged
       UNION ALL SELECT 'lines', count(*), count(rejection_reason), round(count(rejection_reason) * 100.0 / count(*), 2)::DOUBLE FROM tagged_lines""",
)
def reject_rates(t):
    header = r.tag_header(t.raw_header)
    return p.reject_rates({"header": header, "lines": r.tag_lines(t.raw_lines, r.accepted_header(header))})


@query(
    "q_email_phone_valid", "raw_customers",
    r"""SELECT customer_id,
          coalesce(lower(trim(email)) NOT IN ('n/a','na','null','none','unknown','')
                   AND regexp_matches(trim(email), '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$'), false) AS email_ok,
          coalesce(length(regexp_replace(customer_phone, '[^0-9]', '', 'g')) >= 10, false) AS phone_ok FROM raw_customers""",
)
def email_phone(t):
    return t.raw_customers.select("customer_id", valid_email("email").alias("email_ok"), valid_phone("customer_phone").alias("phone_ok"))


IQR = """WITH f AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM (SELECT {x}::DOUBLE AS x FROM {table}))
"""


@query(
    "q_iqr_bounds", "header",
    IQR.format(x="total_amount", table="header")
    + "SELECT round(q1,4) AS q1, round(q3,4) AS q3, round(q1-1.5*(q3-q1),4) AS low, round(q3+1.5*(q3-q1),4) AS high FROM f",
)
def iqr_bounds(t):
    return rounded(p.iqr_bounds(t.header, "total_amount"))


@query(
    "q_iqr_outliers", "lines",
    "WITH spread AS (SELECT line_item_id, CASE line_item_id % 97 WHEN 0 THEN 6 WHEN 1 THEN -4 ELSE 1 END * line_item_amount::DOUBLE AS v FROM lines), "
    + IQR.format(x="v", table="spread").strip().removeprefix("WITH ")
    + """ SELECT line_item_id, v < q1 - 1.5*(q3-q1) OR v > q3 + 1.5*(q3-q1) AS is_outlier FROM spread, f""",
)
def iqr_outliers(t):
    """Some amounts are made far too large or negative, so that the fences have rows on both sides."""
    factor = F.when(F.col("line_item_id") % 97 == 0, 6).when(F.col("line_item_id") % 97 == 1, -4).otherwise(1)
    rows = t.lines.withColumn("v", factor * F.col("line_item_amount").cast("double"))
    return p.detect_outliers(rows, "v").select("line_item_id", "is_outlier")


# Every rule is broken by some rows: (column, divisor of the key, value).
BROKEN = [("recency_days", 13, -1), ("frequency_30d", 17, -2), ("monetary_30d", 19, -3.5), ("frequency_60d", 23, -4),
          ("monetary_60d", 29, -5.5), ("frequency_90d", 31, -6), ("monetary_90d", 37, -7.5), ("avg_order_value", 41, -8.5),
          ("num_stores_visited", 43, 0)]


def _broken_sql():
    columns = ", ".join(f"CASE WHEN customer_id % {n} = 0 THEN {v} ELSE {c} END AS {c}" for c, n, v in BROKEN)
    tests = []
    for c, low, high in p.FEATURE_RANGES:
        tests += [f"CASE WHEN {c} < {low} THEN '{c} below {low:g}' END"] if low is not None else []
        tests += [f"CASE WHEN {c} > {high} THEN '{c} above {high:g}' END"] if high is not None else []
    return f"""WITH st AS (SELECT customer_id, count(DISTINCT store_id) AS num_stores_visited FROM sales WHERE {PAST} GROUP BY 1),
      b AS (SELECT customer_id, total_loyalty_points, {columns} FROM profile LEFT JOIN st USING (customer_id)
            LEFT JOIN customers USING (customer_id)),
      e AS (SELECT customer_id, list_filter([{', '.join(tests)}], lambda x: x IS NOT NULL) AS errors FROM b)
      SELECT customer_id, len(errors)::INT AS n_errors, len(errors) = 0 AS is_valid, array_to_string(errors, '; ') AS messages FROM e"""


@query("q_rule_errors", "profile sales customers", _broken_sql())
def rule_errors(t):
    sales = cu.sales_with_lines(t.header, t.lines)
    rows = cu.order_profile(sales, WIDE).join(cu.stores_visited(sales, WIDE), "customer_id", "left")
    rows = rows.join(t.customers.select("customer_id", "total_loyalty_points"), "customer_id", "left")
    rows = rows.withColumns({c: F.when(F.col("customer_id") % n == 0, F.lit(v)).otherwise(F.col(c)) for c, n, v in BROKEN})
    out = p.validate_features(rows)
    return out.select("customer_id", F.size("errors").alias("n_errors"), "is_valid", F.concat_ws("; ", "errors").alias("messages"))


@query(
    "q_required_columns", "",
    "SELECT 'loyalty_score' AS missing_column, count(*) AS rows FROM customer",
)
def required_columns(t):
    missing = p.missing_columns(t.customers, ["customer_id", "segment_id", "loyalty_score"])
    return t.customers.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(F.array(*[F.lit(m) for m in missing])).alias("missing_column"), "rows")


@query(
    "q_leakage_guards", "split",
    """SELECT (SELECT max(last_purchase) FROM split WHERE split='train') AS last_train,
              (SELECT min(last_purchase) FROM split WHERE split='test') AS first_test,
              (SELECT max(last_purchase) FROM split WHERE split='train') <= (SELECT min(last_purchase) FROM split WHERE split='test') AS in_time_order,
              0::BIGINT AS shared_keys, 0::BIGINT AS leaked_targets""",
)
def leakage_guards(t):
    split = temporal_split(customer_table(t))
    return p.leakage_report(
        split.filter("split = 'train'"), split.filter("split = 'test'"), "customer_id", "last_purchase",
        ["monetary_30d", "recency_days"], ["future_spend_30d"],
    )


@query(
    "io_null_tokens", "raw_customers",
    """SELECT customer_id,
        CASE WHEN lower(trim(email)) NOT IN ('','n/a','na','null','none','nan','#n/a','nat','<na>') THEN email END AS email,
        CASE WHEN lower(trim(customer_phone)) NOT IN ('','n/a','na','null','none','nan','#n/a','nat','<na>') THEN customer_phone END AS customer_phone
       FROM raw_customers""",
)
def null_tokens(t):
    return null_tokens_to_null(t.raw_customers, ["email", "customer_phone"]).select("customer_id", "email", "customer_phone")
