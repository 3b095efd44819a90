"""Splits, folds, resampling, encoding, scaling."""

from pyspark.sql import functions as F

from tillsight.catalog.registry import query, rounded
from tillsight.catalog.views import customer_table, scored
from tillsight.models.prep import label_codes, label_encode, standard_scale
from tillsight.operators import splits as s

KEY = "customer_id"
ORDER = "ORDER BY {ts}, md5(CAST(customer_id AS VARCHAR))"
LAST, FIRST = ORDER.format(ts="last_purchase"), ORDER.format(ts="first_purchase")


@query("s_split_last", "split", "SELECT customer_id, split FROM split")
def split_last(t):
    return s.temporal_split(customer_table(t)).select(KEY, "split")


@query(
    "s_split_first", "cust",
    f"SELECT customer_id, CASE WHEN row_number() OVER ({FIRST}) <= floor(0.8::DOUBLE * count(*) OVER ()) THEN 'train' ELSE 'test' END AS split FROM cust",
)
def split_first(t):
    return s.temporal_split(customer_table(t), "first_purchase").select(KEY, "split")


@query(
    "s_split_lines", "lines header",
    """SELECT line_item_id, CASE WHEN row_number() OVER (ORDER BY transaction_date, md5(CAST(line_item_id AS VARCHAR))) <= floor(0.8::DOUBLE * count(*) OVER ())
         THEN 'train' ELSE 'test' END AS split FROM lines JOIN header USING (transaction_id)""",
)
def split_lines(t):
    rows = t.lines.join(t.header.select("transaction_id", "transaction_date"), "transaction_id")
    return s.temporal_split(rows, "transaction_date", "line_item_id").select("line_item_id", "split")


@query(
    "s_random_split", "cust",
    """SELECT customer_id, CASE WHEN ('0x' || substr(md5(customer_id || ':42'), 1, 8))::BIGINT % 10000 < 8000 THEN 'train' ELSE 'test' END AS split FROM cust""",
)
def random_split(t):
    return s.random_split(customer_table(t)).select(KEY, "split")


@query(
    "s_tscv", "cust",
    f"""WITH p AS (SELECT customer_id, row_number() OVER ({LAST}) - 1 AS pos, count(*) OVER () AS n FROM cust),
         f AS (SELECT CAST(i AS INT) AS fold FROM range(5) r(i))
       SELECT customer_id, fold, CASE WHEN pos < n - (5 - fold) * (n // 6) THEN 'train' ELSE 'test' END AS role
       FROM p, f WHERE pos < n - (5 - fold) * (n // 6) + (n // 6)""",
)
def tscv(t):
    return s.time_series_folds(customer_table(t)).select(KEY, "fold", "role")


@query(
    "s_validation_tail", "cust",
    f"SELECT customer_id, row_number() OVER ({LAST}) > floor((1 - 0.15::DOUBLE) * count(*) OVER ()) AS is_validation FROM cust",
)
def validation_tail(t):
    return s.validation_tail(customer_table(t)).select(KEY, "is_validation")


@query(
    "s_oversample", "cust",
    """SELECT customer_id, CAST(i AS INT) AS copy, future_spend_30d FROM cust, range(4) r(i) WHERE i = 0 OR future_spend_30d > 0""",
)
def oversample(t):
    return s.oversample(customer_table(t)).select(KEY, "copy", "future_spend_30d")


@query("s_weights", "cust", "SELECT customer_id, CASE WHEN future_spend_30d > 0 THEN 4.0 ELSE 1.0 END::DOUBLE AS weight FROM cust")
def weights(t):
    return customer_table(t).select(KEY, s.spender_weight().alias("weight"))


@query("t_top_spenders", "scored", "SELECT customer_id, predicted FROM scored ORDER BY predicted DESC, customer_id LIMIT 10")
def top_spenders(t):
    return s.top_spenders(scored(t).select(KEY, "predicted"), 10, "predicted")


@query("t_stable_sample", "cust", "SELECT customer_id, total_frequency, total_monetary FROM cust ORDER BY md5(customer_id || ':42'), customer_id LIMIT 5")
def stable_sample(t):
    return s.stable_sample(customer_table(t), 5).select(KEY, "total_frequency", "total_monetary")


@query(
    "v_split_summary", "split",
    """SELECT split, count(*) AS rows, min(last_purchase) AS first_purchase_in_split, max(last_purchase) AS last_purchase_in_split,
         round(avg(CAST(future_spend_30d > 0 AS INT)), 4) AS spender_share FROM split GROUP BY 1""",
)
def split_summary(t):
    return rounded(s.split_summary(s.temporal_split(customer_table(t))))


@query("p_label_codes", "products", "SELECT product_category, CAST(row_number() OVER (ORDER BY product_category) - 1 AS BIGINT) AS code FROM (SELECT DISTINCT product_category FROM products)")
def codes(t):
    return label_codes(t.products, ["product_category"]).select(F.col("value").alias("product_category"), "code")


@query("p_label_codes_names", "customers", "SELECT first_name, CAST(row_number() OVER (ORDER BY first_name) - 1 AS BIGINT) AS code FROM (SELECT DISTINCT first_name FROM customers)")
def name_codes(t):
    return label_codes(t.customers, ["first_name"]).select(F.col("value").alias("first_name"), "code")


@query(
    "p_label_encode", "customers",
    """SELECT customer_id, CAST(dense_rank() OVER (ORDER BY segment_id) - 1 AS BIGINT) AS segment_id_encoded,
         CAST(dense_rank() OVER (ORDER BY loyalty_status) - 1 AS BIGINT) AS loyalty_status_encoded FROM customers""",
)
def encode(t):
    out = label_encode(t.customers, ["segment_id", "loyalty_status"])
    return out.select(KEY, "segment_id_encoded", "loyalty_status_encoded")


@query(
    "p_unknown_code", "customers",
    """SELECT customer_id, coalesce(CASE WHEN loyalty_status IN ('Bronze', 'Silver') THEN CASE loyalty_status WHEN 'Bronze' THEN 0 ELSE 1 END END, 0)::BIGINT AS loyalty_status_encoded FROM customers""",
)
def unknown_code(t):
    known = label_codes(t.customers.filter(F.col("loyalty_status").isin("Bronze", "Silver")), ["loyalty_status"])
    return label_encode(t.customers, ["loyalty_status"], known, unknown=0).select(KEY, "loyalty_status_encoded")


@query(
    "p_scale", "split",
    """WITH k AS (SELECT avg(total_monetary) AS m, stddev_pop(total_monetary) AS sd, avg(recency_days) AS rm, stddev_pop(recency_days) AS rsd FROM split WHERE split = 'train')
       SELECT customer_id, round((total_monetary - m) / sd, 4) AS total_monetary, round((recency_days - rm) / rsd, 4) AS recency_days FROM split, k""",
)
def scale(t):
    split = s.temporal_split(customer_table(t))
    out = standard_scale(split, split.filter("split = 'train'"), ["total_monetary", "recency_days"])
    return rounded(out.select(KEY, "total_monetary", "recency_days"))
