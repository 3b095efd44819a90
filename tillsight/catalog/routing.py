"""Accept/reject routing and row filters."""

from pyspark.sql import functions as F

from tillsight.catalog.registry import CUT, FUTURE, PAST, query, rounded
from tillsight.catalog.views import SPEC, customer_table
from tillsight.operators import routing as r
from tillsight.operators.explore import activity_summary, customer_rfm
from tillsight.operators.periods import FeatureSpec, future_rows, history_rows, known_customers
from tillsight.operators.splits import active_only, lookup, spenders_only
from tillsight.sources.bindings import ORDER_CUTOFF

RIGHT = FeatureSpec(ORDER_CUTOFF, horizon_days=45, lookbacks=(30, 60, 90), bounds="right")


@query("f_route_header", "tagged", "SELECT transaction_id, customer_id, transaction_date, total_amount::DOUBLE AS total_amount, rejection_reason FROM tagged")
def route_header(t):
    return r.tag_header(t.raw_header).select(
        "transaction_id", "customer_id", "transaction_date", F.col("total_amount").cast("double"), r.REASON
    )


@query("f_route_lines", "tagged_lines", "SELECT line_item_id, transaction_id, product_id, quantity, rejection_reason FROM tagged_lines")
def route_lines(t):
    tagged = r.tag_lines(t.raw_lines, r.accepted_header(r.tag_header(t.raw_header)))
    return tagged.select("line_item_id", "transaction_id", "product_id", "quantity", r.REASON)


@query("f_rejected_header", "tagged", "SELECT transaction_id, transaction_date, rejection_reason FROM tagged WHERE rejection_reason IS NOT NULL")
def rejected_header(t):
    return r.rejected(r.tag_header(t.raw_header)).select("transaction_id", "transaction_date", r.REASON)


@query(
    "u_reject_union", "tagged tagged_lines",
    """SELECT 'header' AS table_name, transaction_id, rejection_reason FROM tagged WHERE rejection_reason IS NOT NULL
       UNION ALL SELECT 'lines', transaction_id, rejection_reason FROM tagged_lines WHERE rejection_reason IS NOT NULL""",
)
def reject_union(t):
    header = r.tag_header(t.raw_header)
    lines = r.tag_lines(t.raw_lines, r.accepted_header(header))
    part = lambda df, n: r.rejected(df).select(F.lit(n).alias("table_name"), "transaction_id", r.REASON)
    return part(header, "header").unionByName(part(lines, "lines"))


@query("f_history_left", "header", f"SELECT transaction_id, customer_id FROM header WHERE {PAST}")
def history_left(t):
    return history_rows(t.header, SPEC).select("transaction_id", "customer_id")


@query("f_history_right", "header", f"SELECT transaction_id, customer_id FROM header WHERE transaction_date <= {CUT}")
def history_right(t):
    return history_rows(t.header, RIGHT).select("transaction_id", "customer_id")


@query("f_windows_left", "header", f"SELECT transaction_id, customer_id FROM header WHERE {FUTURE}")
def windows_left(t):
    return future_rows(t.header, SPEC).select("transaction_id", "customer_id")


@query(
    "f_windows_right", "header",
    f"SELECT transaction_id, customer_id FROM header WHERE transaction_date > {CUT} AND transaction_date <= {CUT} + INTERVAL 45 DAY",
)
def windows_right(t):
    return future_rows(t.header, RIGHT).select("transaction_id", "customer_id")


@query(
    "f_lookback", "header",
    f"""SELECT customer_id,
          count(*) FILTER (WHERE {PAST} AND transaction_date >= {CUT} - INTERVAL 30 DAY) AS left_30d,
          count(*) FILTER (WHERE transaction_date <= {CUT} AND transaction_date > {CUT} - INTERVAL 30 DAY) AS right_30d
        FROM header GROUP BY customer_id""",
)
def lookback(t):
    return t.header.groupBy("customer_id").agg(
        F.count_if(SPEC.lookback("transaction_date", 30)).alias("left_30d"),
        F.count_if(RIGHT.lookback("transaction_date", 30)).alias("right_30d"),
    )


@query("f_active", "cust", "SELECT customer_id, recency_days FROM cust WHERE recency_days <= 60")
def active(t):
    return active_only(customer_table(t)).select("customer_id", "recency_days")


@query("f_spenders", "cust", "SELECT customer_id, future_spend_30d FROM cust WHERE future_spend_30d > 0")
def spenders(t):
    return spenders_only(customer_table(t)).select("customer_id", "future_spend_30d")


@query("f_lookup", "customers", "SELECT customer_id, first_name, segment_id FROM customers WHERE customer_id = 42")
def point_lookup(t):
    return lookup(t.customers, 42).select("customer_id", "first_name", "segment_id")


@query(
    "f_activity", "rfm",
    """SELECT count(*) AS customers, count(*) FILTER (WHERE recency <= 30) AS active, count(*) FILTER (WHERE recency > 180) AS churned,
         count(*) FILTER (WHERE monetary > (SELECT quantile_cont(monetary, 0.9) FROM rfm)) AS high_value,
         round(count(*) FILTER (WHERE recency <= 30) * 100.0 / count(*), 1)::DOUBLE AS active_pct,
         round(count(*) FILTER (WHERE recency > 180) * 100.0 / count(*), 1)::DOUBLE AS churned_pct,
         round(count(*) FILTER (WHERE monetary > (SELECT quantile_cont(monetary, 0.9) FROM rfm)) * 100.0 / count(*), 1)::DOUBLE AS high_value_pct
       FROM rfm""",
)
def activity(t):
    return rounded(activity_summary(customer_rfm(t.header)), 1)


@query("u_distinct_customers", "header", f"SELECT DISTINCT customer_id FROM header WHERE {PAST}")
def distinct_customers(t):
    return known_customers(t.header, SPEC)
