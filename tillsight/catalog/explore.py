"""Descriptive reports."""

from pyspark.sql import functions as F

from tillsight.catalog.registry import query, rounded
from tillsight.catalog.views import customer_table, scored
from tillsight.functions.columns import round_even
from tillsight.operators import bins as b
from tillsight.operators import customer as cu
from tillsight.operators import explore as ex
from tillsight.operators.derived import score_tier


@query("a_monthly", "header", "SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, count(*) AS transactions, sum(total_amount)::DOUBLE AS revenue FROM header GROUP BY 1")
def monthly(t):
    return ex.monthly_sales(t.header)


@query("a_daily", "header", "SELECT CAST(transaction_date AS DATE) AS day, count(*) AS transactions, sum(total_amount)::DOUBLE AS revenue FROM header GROUP BY 1")
def daily(t):
    return ex.daily_sales(t.header)


STORE = """SELECT store_id, count(*) AS transactions, round(sum(total_amount)::DOUBLE, 2) AS revenue,
  round(sum(total_amount)::DOUBLE / count(*), 2) AS mean_amount FROM header GROUP BY 1"""


@query("a_store_sales", "header", STORE)
def store_sales(t):
    return ex.store_sales(t.header)


@query("a_store_top5", "header", STORE + " ORDER BY revenue DESC, store_id LIMIT 5")
def store_top5(t):
    return ex.top_stores(t.header, 5)


@query(
    "a_weekday", "purchases",
    """SELECT CAST(i AS INT) AS dow, ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][i + 1] AS weekday,
          coalesce(n, 0) AS transactions, m AS mean_amount FROM range(7) r(i) LEFT JOIN
          (SELECT isodow(transaction_date) - 1 AS d, count(*) AS n, sum(total_amount)::DOUBLE / count(*) AS m FROM purchases GROUP BY 1) ON d = i""",
)
def weekday(t):
    return ex.weekday_sales(t.purchases)


@query("a_hour", "purchases", "SELECT CAST(hour(transaction_date) AS INT) AS hour, count(*) AS transactions FROM purchases GROUP BY 1")
def hour(t):
    return ex.hourly_sales(t.purchases)


@query(
    "a_region", "header stores",
    "SELECT store_region, sum(total_amount)::DOUBLE AS revenue, sum(total_amount)::DOUBLE / count(*) AS mean_amount FROM header JOIN stores USING (store_id) GROUP BY 1",
)
def region(t):
    return ex.region_sales(t.header, t.stores)


@query(
    "a_category_revenue", "lines products",
    """SELECT product_category, sum(line_item_amount)::DOUBLE AS revenue, sum(quantity) AS items_sold, count(DISTINCT product_id) AS products_sold
       FROM lines JOIN products USING (product_id) GROUP BY 1""",
)
def category_revenue(t):
    return ex.category_sales(t.lines, t.products)


@query(
    "a_category_products", "products",
    "SELECT product_category, count(*) AS products, round(count(*) * 100.0 / (SELECT count(*) FROM products), 2)::DOUBLE AS pct FROM products GROUP BY 1",
)
def category_products(t):
    return ex.category_products(t.products)


@query(
    "a_tier_dist", "customers",
    "SELECT loyalty_status, count(*) AS customers, round(count(*) * 100.0 / (SELECT count(*) FROM customers), 2)::DOUBLE AS pct FROM customers GROUP BY 1",
)
def tier_dist(t):
    return ex.value_shares(t.customers, "loyalty_status", "customers")


@query(
    "a_tier_sales", "header customers",
    "SELECT loyalty_status, count(*) AS transactions, sum(total_amount)::DOUBLE / count(*) AS mean_amount FROM header JOIN customers USING (customer_id) GROUP BY 1",
)
def tier_sales(t):
    return ex.sale_per_tier(t.header, t.customers)


def _describe(x, table):
    return f"""SELECT count({x}) AS count, round(sum({x})::DOUBLE / count({x}), 4) AS mean, round(stddev_samp({x}::DOUBLE), 4) AS std, min({x})::DOUBLE AS min,
      round(quantile_cont({x}::DOUBLE, 0.25), 4) AS q25, round(quantile_cont({x}::DOUBLE, 0.5), 4) AS q50, round(quantile_cont({x}::DOUBLE, 0.75), 4) AS q75,
      max({x})::DOUBLE AS max FROM {table}"""


@query("a_describe", "header", _describe("total_amount", "header"))
def describe(t):
    return rounded(ex.describe_column(t.header, "total_amount"))


@query("a_describe_price", "products", _describe("unit_price", "products"))
def describe_price(t):
    return rounded(ex.describe_column(t.products, "unit_price"))


@query("a_orders_per_customer", "header", _describe("n", "(SELECT customer_id, count(*) AS n FROM header GROUP BY 1)"))
def orders_per_customer(t):
    return rounded(ex.describe_column(t.header.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n")), "n"))


@query("a_span", "header", "SELECT min(transaction_date) AS first_sale, max(transaction_date) AS last_sale, CAST(floor(date_diff('microsecond', min(transaction_date), max(transaction_date)) / 86400000000.0) AS BIGINT) AS days FROM header")
def span(t):
    return ex.sales_span(t.header)


@query("a_span_events", "purchases", "SELECT min(transaction_date) AS first_sale, max(transaction_date) AS last_sale, CAST(floor(date_diff('microsecond', min(transaction_date), max(transaction_date)) / 86400000000.0) AS BIGINT) AS days FROM purchases")
def span_events(t):
    return ex.sales_span(t.purchases)


@query("a_skew", "header", "SELECT round(skewness(total_amount::DOUBLE), 4) AS skewness FROM header")
def skew(t):
    return rounded(ex.skewness(t.header, "total_amount"))


@query("a_skew_target", "cust", "SELECT round(skewness(future_spend_30d), 4) AS skewness FROM cust")
def skew_target(t):
    return rounded(ex.skewness(customer_table(t), "future_spend_30d"))


CORR = ["total_spend", "avg_transaction", "num_transactions", "num_stores", "total_loyalty_points", "tenure_days"]
MEASURES = """SELECT b.*, total_loyalty_points, date_diff('day', customer_since, DATE '2001-08-01') AS tenure_days
  FROM basic b JOIN customers c ON b.customer_id = c.customer_id"""


@query(
    "a_corr", "basic customers",
    f"WITH m AS ({MEASURES}) "
    + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, {'1.0::DOUBLE' if x == y else f'round(corr({x}, {y}), 4)'} AS corr FROM {'(SELECT 1)' if x == y else 'm'}"
        for x in CORR for y in CORR
    ),
)
def corr(t):
    tenure = F.date_diff(F.lit("2001-08-01").cast("date"), F.col("customer_since")).alias("tenure_days")
    attributes = t.customers.select("customer_id", "total_loyalty_points", tenure)
    return rounded(ex.correlations(ex.basic_features(t.header).join(attributes, "customer_id"), CORR))


@query("a_rfm", "rfm", "SELECT * FROM rfm")
def rfm(t):
    return ex.customer_rfm(t.header)


@query("a_basic_features", "basic", "SELECT * FROM basic")
def basic(t):
    return ex.basic_features(t.header)


def _hist(x, table, n):
    return f"""WITH v AS (SELECT {x} AS x FROM {table}), e AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / {n} AS w FROM v)
      SELECT CAST(least(floor((x - lo) / w), {n - 1}) AS INT) AS bin, round(any_value(lo) + least(floor((x - lo) / w), {n - 1}) * any_value(w), 4) AS bin_low,
             round(any_value(lo) + (least(floor((x - lo) / w), {n - 1}) + 1) * any_value(w), 4) AS bin_high, count(*) AS rows
      FROM v, e GROUP BY least(floor((x - lo) / w), {n - 1})"""


@query("a_hist50", "header", _hist("total_amount::DOUBLE", "header", 50))
def hist50(t):
    return rounded(b.histogram(t.header, "total_amount", 50))


@query("a_hist_log", "cust", _hist("ln(1 + total_monetary)", "cust", 50))
def hist_log(t):
    return rounded(b.histogram(customer_table(t), F.log1p("total_monetary"), 50))


@query("a_hist_counts", "header", "SELECT n AS value, count(*) AS rows FROM (SELECT customer_id, count(*) AS n FROM header GROUP BY 1) GROUP BY 1")
def hist_counts(t):
    return b.count_histogram(t.header.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n")), "n")


@query(
    "a_box", "lines",
    """WITH f AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM (SELECT line_item_amount::DOUBLE AS x FROM lines))
       SELECT round(any_value(q1), 4) AS q1, round(any_value(q3), 4) AS q3,
         min(line_item_amount::DOUBLE) FILTER (WHERE line_item_amount::DOUBLE >= q1 - 0.5*(q3-q1)) AS whisker_low,
         max(line_item_amount::DOUBLE) FILTER (WHERE line_item_amount::DOUBLE <= q3 + 0.5*(q3-q1)) AS whisker_high,
         count(*) FILTER (WHERE line_item_amount::DOUBLE < q1 - 0.5*(q3-q1) OR line_item_amount::DOUBLE > q3 + 0.5*(q3-q1)) AS fliers FROM lines, f""",
)
def box(t):
    out = b.box_summary(t.lines, "line_item_amount", 0.5)
    return out.withColumns({"q1": F.round("q1", 4), "q3": F.round("q3", 4)})


@query(
    "a_density2d", "basic customers",
    """WITH v AS (SELECT total_loyalty_points AS x, total_spend AS y FROM basic JOIN customers USING (customer_id)),
         e AS (SELECT min(x) AS x0, (max(x) - min(x)) / 20 AS xw, min(y) AS y0, (max(y) - min(y)) / 20 AS yw FROM v)
       SELECT CAST(least(floor((x - x0) / xw), 19) AS INT) AS x_bin, CAST(least(floor((y - y0) / yw), 19) AS INT) AS y_bin, count(*) AS rows FROM v, e GROUP BY 1, 2""",
)
def density2d(t):
    points = ex.basic_features(t.header).join(t.customers.select("customer_id", "total_loyalty_points"), "customer_id")
    return b.density(points, "total_loyalty_points", "total_spend", 20)


@query(
    "a_median_impute", "raw_customers",
    "SELECT customer_id, round(coalesce(total_loyalty_points, (SELECT median(total_loyalty_points) FROM raw_customers)), 4) AS total_loyalty_points FROM raw_customers",
)
def median_impute(t):
    return rounded(ex.impute_median(t.raw_customers.select("customer_id", "total_loyalty_points"), "total_loyalty_points"))


@query(
    "a_target_stats", "cust",
    """SELECT round(sum(CAST(future_spend_30d = 0 AS INT))::DOUBLE / count(*), 4) AS zero_share, round(avg(future_spend_30d), 4) AS mean,
         round(quantile_cont(future_spend_30d, 0.5), 4) AS median, round(stddev_samp(future_spend_30d), 4) AS std,
         max(future_spend_30d) AS max, round(quantile_cont(future_spend_30d, 0.99), 4) AS p99 FROM cust""",
)
def target_stats(t):
    return rounded(ex.target_summary(customer_table(t)))


@query(
    "a_prediction_summary", "scored",
    "SELECT count(*) AS customers, round(avg(predicted), 4) AS mean_score, round(quantile_cont(predicted, 0.5), 4) AS median_score FROM scored",
)
def prediction_summary(t):
    return rounded(ex.prediction_summary(scored(t), "predicted"))


TIER = """CASE WHEN s <= 0 THEN 'Zero' WHEN s <= 25 THEN 'Low' WHEN s <= 75 THEN 'Medium' WHEN s <= 200 THEN 'High' ELSE 'VIP' END"""


@query(
    "a_prediction_tiers", "scored",
    f"""SELECT {TIER} AS spend_category, count(*) AS customers, round(count(*) * 100.0 / (SELECT count(*) FROM scored), 2)::DOUBLE AS pct
        FROM (SELECT predicted / 1000 AS s FROM scored) GROUP BY 1""",
)
def prediction_tiers(t):
    tiers = scored(t).select(score_tier(F.col("predicted") / 1000).alias("spend_category"))
    return ex.value_shares(tiers, "spend_category", "customers")


@query("a_rounding", "cust", "SELECT customer_id, round_even(total_monetary / total_frequency * 100, 0) / 100 AS mean_2dp FROM cust")
def rounding(t):
    value = F.col("total_monetary") / F.col("total_frequency")
    return customer_table(t).select("customer_id", round_even(value, 2).alias("mean_2dp"))


@query("a_header_stats", "cust", "SELECT count(*) AS customers, round(avg(total_monetary), 4) AS mean_historical_spend FROM cust")
def header_stats(t):
    return rounded(customer_table(t).agg(F.count(F.lit(1)).alias("customers"), cu.mean("total_monetary").alias("mean_historical_spend")))


@query("a_spend_per_customer", "basic", _describe("total_spend", "basic"))
def spend_per_customer(t):
    return rounded(ex.describe_column(ex.basic_features(t.header), "total_spend"))


@query("a_average_tables", "rfm", "SELECT round(avg(recency), 4) AS recency, round(avg(frequency), 4) AS frequency, round(avg(monetary), 4) AS monetary FROM rfm")
def average_rfm(t):
    out = ex.customer_rfm(t.header)
    return rounded(out.agg(*[cu.mean(c).alias(c) for c in ("recency", "frequency", "monetary")]))
