"""Customer aggregates, windows and the full feature tables."""

from pyspark.sql import functions as F

from tillsight.catalog.registry import CUT, FUTURE, PAST, query, rounded, sql_days, sql_window
from tillsight.catalog.views import EVENTS, SPEC, order_profile
from tillsight.operators import customer as cu
from tillsight.operators.explore import weekend_share
from tillsight.operators.periods import FeatureSpec, history_rows
from tillsight.operators.upkeep import fold_days, state_measures
from tillsight.plans import feature_job as fj
from tillsight.sources.bindings import CATEGORIES, ORDER_CUTOFF

KEY = "customer_id"
FULL = FeatureSpec(ORDER_CUTOFF)
RIGHT45 = FeatureSpec(ORDER_CUTOFF, horizon_days=45, lookbacks=(30, 60, 90), bounds="right")
HAS_PAST = f"HAVING count(*) FILTER (WHERE {PAST}) > 0"
EV_CUT = "TIMESTAMP '2024-01-21'"


def _windows_sql(days):
    return ", ".join(
        f"""count(*) FILTER (WHERE {sql_window(d)}) AS frequency_{d}d,
            coalesce(sum(total_amount) FILTER (WHERE {sql_window(d)}), 0)::DOUBLE AS monetary_{d}d,
            coalesce((sum(total_amount) FILTER (WHERE {sql_window(d)}))::DOUBLE / nullif(count(*) FILTER (WHERE {sql_window(d)}), 0), 0) AS avg_order_value_{d}d"""
        for d in days
    )


LIFETIME = f"""count(*) FILTER (WHERE {PAST}) AS frequency_total,
  min(transaction_date) FILTER (WHERE {PAST}) AS first_purchase_date, max(transaction_date) FILTER (WHERE {PAST}) AS last_purchase,
  {sql_days(CUT, f'max(transaction_date) FILTER (WHERE {PAST})')} AS recency_days,
  (sum(total_amount) FILTER (WHERE {PAST}))::DOUBLE AS monetary_total,
  (sum(total_amount) FILTER (WHERE {PAST}))::DOUBLE / count(*) FILTER (WHERE {PAST}) AS avg_order_value,
  (max(total_amount) FILTER (WHERE {PAST}))::DOUBLE AS max_order_value, (min(total_amount) FILTER (WHERE {PAST}))::DOUBLE AS min_order_value,
  round(coalesce(stddev_samp(total_amount::DOUBLE) FILTER (WHERE {PAST}), 0), 4) AS std_order_value"""
TARGET = f"""coalesce(sum(total_amount) FILTER (WHERE {FUTURE}), 0)::DOUBLE AS future_spend_30d,
  count(*) FILTER (WHERE {FUTURE}) AS future_transactions_30d,
  CAST(coalesce(sum(total_amount) FILTER (WHERE {FUTURE}), 0) > 0 AS INT) AS will_purchase_30d"""


@query("a_recency", "header", f"SELECT customer_id, {sql_days(CUT, 'max(transaction_date)')} AS recency_days, max(transaction_date) AS last_purchase FROM header WHERE {PAST} GROUP BY 1")
def recency(t):
    measures = [m for i, m in enumerate(cu.lifetime_measures(SPEC)) if i in (2, 3)]
    return cu.header_features(t.header, SPEC, measures=measures, with_target=False).select(KEY, "recency_days", "last_purchase")


@query("a_frequency", "header", f"SELECT customer_id, count(*) AS frequency_total, min(transaction_date) AS first_purchase_date FROM header WHERE {PAST} GROUP BY 1")
def frequency(t):
    return cu.header_features(t.header, SPEC, measures=cu.lifetime_measures(SPEC)[:2], with_target=False)


@query("a_windows", "header", f"SELECT customer_id, {_windows_sql((30, 60, 90, 180, 365))} FROM header GROUP BY customer_id {HAS_PAST}")
def windows(t):
    return cu.header_features(t.header, FULL, measures=cu.window_measures(FULL), with_target=False)


@query("a_windows_short", "header", f"SELECT customer_id, {_windows_sql((7, 14, 30, 60, 90))} FROM header GROUP BY customer_id {HAS_PAST}")
def windows_short(t):
    spec = FeatureSpec(ORDER_CUTOFF, lookbacks=(7, 14, 30, 60, 90))
    return cu.header_features(t.header, spec, measures=cu.window_measures(spec), with_target=False)


@query("a_monetary", "header", f"SELECT customer_id, {LIFETIME} FROM header GROUP BY customer_id {HAS_PAST}")
def monetary(t):
    out = cu.header_features(t.header, SPEC, measures=cu.lifetime_measures(SPEC), with_target=False)
    return out.withColumn("std_order_value", F.round("std_order_value", 4))


@query(
    "a_upkeep", "header",
    f"""WITH g AS (SELECT customer_id, {sql_days('transaction_date', 'lag(transaction_date) OVER (PARTITION BY customer_id ORDER BY transaction_date)')} AS gap
         FROM header WHERE {PAST}),
       c AS (SELECT customer_id, coalesce(avg(gap), 0) AS gap_mean, coalesce(stddev_samp(gap), 0) AS gap_std FROM g GROUP BY 1),
       w AS (SELECT customer_id, {LIFETIME}, count(*) FILTER (WHERE {PAST}) AS frequency, {_windows_sql((30, 90))}
         FROM header GROUP BY customer_id {HAS_PAST})
       SELECT w.*, round(gap_mean, 4) AS gap_mean, round(gap_std, 4) AS gap_std FROM w JOIN c USING (customer_id)""",
)
def upkeep(t):
    """Lifetime, look-back and cadence measures of a state that was folded month by month."""
    spec = FeatureSpec(ORDER_CUTOFF, lookbacks=(30, 90))
    state = fold_days(t.header, ["2000-10-01", "2000-11-01", "2000-12-01", ORDER_CUTOFF], keep=120)
    out = state_measures(state, spec)
    lifetime = [c for c in cu.header_features(t.header, spec, measures=cu.lifetime_measures(spec), with_target=False).columns]
    windows = [c for c in out.columns if c.endswith(("_30d", "_90d"))]
    named = out.withColumns({"frequency": F.col("frequency_total"), "gap_mean": F.round("avg_days_between_purchases", 4),
                             "gap_std": F.round("std_days_between_purchases", 4), "std_order_value": F.round("std_order_value", 4)})
    return named.select(*lifetime, "frequency", *windows, "gap_mean", "gap_std")


@query("a_target", "header", f"SELECT customer_id, {TARGET} FROM header GROUP BY customer_id {HAS_PAST}")
def target(t):
    return cu.header_features(t.header, SPEC, measures=[])


@query(
    "a_rfm_target", "header",
    f"SELECT customer_id, {LIFETIME}, {_windows_sql((30, 60, 90, 180, 365))}, {TARGET} FROM header GROUP BY customer_id {HAS_PAST}",
)
def rfm_target(t):
    """Flagship: lifetime, five look-backs and target in one scan and one shuffle."""
    return cu.header_features(t.header, FULL).withColumn("std_order_value", F.round("std_order_value", 4))


PAST_LINES = f"SELECT h.customer_id, h.store_id, l.*, p.product_category FROM header h JOIN lines l USING (transaction_id) LEFT JOIN products p USING (product_id) WHERE {PAST}"


@query(
    "a_distinct", "header lines products",
    f"""SELECT customer_id, count(DISTINCT product_category) AS unique_categories, count(DISTINCT product_id) AS unique_products,
               sum(quantity) AS total_items_purchased FROM ({PAST_LINES}) GROUP BY 1""",
)
def distinct(t):
    out = cu.basket_features(t.lines, t.header, t.products, SPEC)
    return out.select(KEY, "unique_categories", "unique_products", "total_items_purchased")


@query(
    "a_top_category", "header lines products",
    f"""SELECT customer_id, product_category AS top_category FROM (
          SELECT customer_id, product_category, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, product_category) AS rn
          FROM ({PAST_LINES}) GROUP BY 1, 2) WHERE rn = 1""",
)
def top_category(t):
    return cu.basket_features(t.lines, t.header, t.products, SPEC).select(KEY, "top_category")


def _shares_sql():
    cols = ", ".join(
        f"round(coalesce(sum(line_item_amount) FILTER (WHERE product_category = '{c}'), 0)::DOUBLE / sum(line_item_amount)::DOUBLE, 4) AS pct_spend_{c.lower()}"
        for c in CATEGORIES
    )
    return f"SELECT customer_id, {cols} FROM ({PAST_LINES}) GROUP BY customer_id"


@query("a_category_share_pivot", "header lines products", _shares_sql())
def category_share(t):
    out = cu.basket_features(t.lines, t.header, t.products, SPEC, CATEGORIES)
    return rounded(out.select(KEY, *[cu.share_column(c) for c in CATEGORIES]))


@query(
    "a_stores", "header stores",
    f"""WITH v AS (SELECT customer_id, store_id, store_region FROM header LEFT JOIN stores USING (store_id) WHERE {PAST}),
        s AS (SELECT customer_id, store_id, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, store_id) AS rn FROM v GROUP BY 1, 2),
        r AS (SELECT customer_id, store_region, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, store_region) AS rn FROM v GROUP BY 1, 2),
        n AS (SELECT customer_id, count(DISTINCT store_id) AS unique_stores, count(DISTINCT store_region) AS unique_regions FROM v GROUP BY 1)
        SELECT n.customer_id, unique_stores, unique_regions, s.store_id AS primary_store_id, r.store_region AS primary_region
        FROM n JOIN s ON n.customer_id = s.customer_id AND s.rn = 1 JOIN r ON n.customer_id = r.customer_id AND r.rn = 1""",
)
def stores(t):
    return cu.store_features(t.header, t.stores, SPEC)


EV_PAST = f"transaction_date < {EV_CUT}"
MODE_SQL = f"""WITH p AS (SELECT customer_id, hour(transaction_date) AS h, isodow(transaction_date) - 1 AS d FROM purchases WHERE {EV_PAST}),
  mh AS (SELECT customer_id, h, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, h) AS rn FROM p GROUP BY 1, 2),
  md AS (SELECT customer_id, d, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, d) AS rn FROM p GROUP BY 1, 2)
  SELECT mh.customer_id, CAST(h AS INT) AS most_common_hour,
         CASE WHEN h >= 6 AND h < 12 THEN 'morning' WHEN h >= 12 AND h < 17 THEN 'afternoon' WHEN h >= 17 AND h < 21 THEN 'evening' ELSE 'night' END AS preferred_time_of_day,
         CAST(d AS INT) AS most_common_dow,
         ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][CAST(d AS INT) + 1] AS preferred_day
  FROM mh JOIN md ON mh.customer_id = md.customer_id AND mh.rn = 1 AND md.rn = 1"""


@query("a_mode_hour", "purchases", MODE_SQL)
def mode_hour(t):
    out = cu.header_features(t.purchases, EVENTS, measures=cu.time_measures(EVENTS), with_target=False)
    return out.select(KEY, "most_common_hour", "preferred_time_of_day", "most_common_dow", "preferred_day")


@query(
    "a_time_habits", "purchases",
    f"""SELECT customer_id, sum(hour(transaction_date))::DOUBLE / count(*) AS avg_purchase_hour,
          sum(CAST(isodow(transaction_date) >= 6 AS INT))::DOUBLE / count(*) AS weekend_transaction_pct,
          sum(isodow(transaction_date) - 1)::DOUBLE / count(*) AS avg_dow,
          round(coalesce(stddev_samp(isodow(transaction_date) - 1), 0), 4) AS std_dow,
          CAST(count(DISTINCT month(transaction_date)) AS INT) AS active_months
        FROM purchases WHERE {EV_PAST} GROUP BY 1""",
)
def time_habits(t):
    out = cu.header_features(t.purchases, EVENTS, measures=cu.time_measures(EVENTS), with_target=False)
    return out.select(
        KEY, "avg_purchase_hour", "weekend_transaction_pct", "avg_dow", F.round("std_dow", 4).alias("std_dow"), "active_months"
    )


@query("a_active_months", "header", f"SELECT customer_id, CAST(count(DISTINCT month(transaction_date)) AS INT) AS active_months FROM header WHERE {PAST} GROUP BY 1")
def active_months(t):
    when = F.when(SPEC.history(cu.TS), F.col(cu.TS))
    return cu.header_features(t.header, SPEC, measures=[cu.active_months(when).alias("active_months")], with_target=False)


@query(
    "a_weekend", "purchases",
    """SELECT customer_id, sum(CAST(isodow(transaction_date) >= 6 AS INT))::DOUBLE / count(*) AS weekend_ratio,
         CAST(sum(CAST(isodow(transaction_date) >= 6 AS INT))::DOUBLE / count(*) > 0.5 AS INT) AS is_weekend_shopper FROM purchases GROUP BY 1""",
)
def weekend(t):
    return weekend_share(t.purchases)


@query("a_rollup", "rollup", "SELECT transaction_id, line_total::DOUBLE AS line_total, quantity, num_products FROM rollup")
def rollup(t):
    return cu.transaction_rollup(t.lines).withColumn("line_total", F.col("line_total").cast("double"))


PROFILE_OUT = """customer_id, total_frequency, total_monetary, avg_order_value, round(std_order_value, 4) AS std_order_value, min_order, max_order,
  first_purchase, last_purchase, total_quantity, avg_quantity, total_products, avg_products_per_order, recency_days, customer_tenure_days,
  frequency_7d, monetary_7d, frequency_14d, monetary_14d, frequency_30d, monetary_30d, frequency_60d, monetary_60d, frequency_90d, monetary_90d,
  future_spend_30d, future_transactions_30d, will_purchase_30d"""


@query("a_customer13", "profile", f"SELECT {PROFILE_OUT} FROM profile")
def customer13(t):
    return order_profile(t).withColumn("std_order_value", F.round("std_order_value", 4))


@query("a_stores_visited", "header", f"SELECT customer_id, count(DISTINCT store_id) AS num_stores_visited FROM header WHERE {PAST} GROUP BY 1")
def stores_visited(t):
    return cu.stores_visited(t.header, SPEC)


# -- windows ---------------------------------------------------------------------------
def _gaps(table, past):
    return f"""WITH g AS (SELECT customer_id, {sql_days('transaction_date', 'lag(transaction_date) OVER (PARTITION BY customer_id ORDER BY transaction_date)')} AS gap
                   FROM {table} WHERE {past})
               SELECT customer_id, coalesce(sum(gap)::DOUBLE / nullif(count(gap), 0), 0) AS avg_days_between_purchases,
                      round(coalesce(stddev_samp(gap), 0), 4) AS std_days_between_purchases FROM g GROUP BY 1"""


@query("w_cadence", "header", _gaps("header", PAST))
def cadence(t):
    return cu.purchase_cadence(t.header, SPEC).withColumn("std_days_between_purchases", F.round("std_days_between_purchases", 4))


@query("w_cadence_events", "purchases", _gaps("purchases", EV_PAST))
def cadence_events(t):
    return cu.purchase_cadence(t.purchases, EVENTS).withColumn("std_days_between_purchases", F.round("std_days_between_purchases", 4))


@query(
    "w_gap_median_fill", "header",
    f"""WITH g AS (SELECT customer_id, {sql_days('transaction_date', 'lag(transaction_date) OVER (PARTITION BY customer_id ORDER BY transaction_date)')} AS gap FROM header WHERE {PAST}),
        m AS (SELECT customer_id, sum(gap)::DOUBLE / nullif(count(gap), 0) AS v FROM g GROUP BY 1)
        SELECT customer_id, round(coalesce(v, (SELECT quantile_cont(v, 0.5) FROM m)), 4) AS avg_gap_days FROM m""",
)
def gap_median_fill(t):
    return rounded(cu.average_gap(t.header, SPEC))


@query(
    "w_top_store", "header",
    f"""SELECT customer_id, store_id AS primary_store_id FROM (SELECT customer_id, store_id,
          row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, store_id) AS rn FROM header WHERE {PAST} GROUP BY 1, 2) WHERE rn = 1""",
)
def top_store(t):
    counts = history_rows(t.header, SPEC).groupBy(KEY, "store_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(KEY).agg(cu.most_frequent("n", "store_id").alias("primary_store_id"))


# -- full tables ---------------------------------------------------------------------------
def _full_sql():
    shares = ", ".join(
        f"round(coalesce(sum(line_item_amount) FILTER (WHERE product_category = '{c}'), 0)::DOUBLE / sum(line_item_amount)::DOUBLE, 4) AS pct_spend_{c.lower()}"
        for c in CATEGORIES
    )
    share_out = ", ".join(f"coalesce(pct_spend_{c.lower()}, 0) AS pct_spend_{c.lower()}" for c in CATEGORIES)
    hd = f"hour(transaction_date) AS h, isodow(transaction_date) - 1 AS d"
    windows = _windows_sql((30, 60, 90, 180, 365))
    window_out = ", ".join(
        f"frequency_{d}d, monetary_{d}d, avg_order_value_{d}d"
        for d in (30, 60, 90, 180, 365)
    )
    return f"""WITH base AS (SELECT customer_id, {LIFETIME}, {windows}, {TARGET} FROM header GROUP BY customer_id {HAS_PAST}),
      pl AS ({PAST_LINES}),
      basket AS (SELECT customer_id, count(DISTINCT product_category) AS unique_categories, count(DISTINCT product_id) AS unique_products,
                 sum(quantity) AS total_items_purchased, {shares} FROM pl GROUP BY 1),
      cat AS (SELECT customer_id, product_category, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, product_category) AS rn FROM pl GROUP BY 1, 2),
      v AS (SELECT customer_id, store_id, store_region, {hd} FROM header LEFT JOIN stores USING (store_id) WHERE {PAST}),
      st AS (SELECT customer_id, store_id, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, store_id) AS rn FROM v GROUP BY 1, 2),
      rg AS (SELECT customer_id, store_region, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, store_region) AS rn FROM v GROUP BY 1, 2),
      mh AS (SELECT customer_id, h, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, h) AS rn FROM v GROUP BY 1, 2),
      md AS (SELECT customer_id, d, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, d) AS rn FROM v GROUP BY 1, 2),
      vs AS (SELECT customer_id, count(DISTINCT store_id) AS unique_stores, count(DISTINCT store_region) AS unique_regions,
               sum(h)::DOUBLE / count(*) AS avg_purchase_hour, sum(CAST(d >= 5 AS INT))::DOUBLE / count(*) AS weekend_transaction_pct FROM v GROUP BY 1),
      gp AS ({_gaps('header', PAST)})
      SELECT b.customer_id, first_purchase_date, recency_days, frequency_total, monetary_total AS monetary_total, avg_order_value AS avg_order_value,
        max_order_value, min_order_value, std_order_value, {window_out},
        coalesce(unique_categories, 0) AS unique_categories, coalesce(unique_products, 0) AS unique_products,
        coalesce(total_items_purchased, 0) AS total_items_purchased, coalesce(cat.product_category, 'Unknown') AS top_category, {share_out},
        unique_stores, unique_regions, CAST(st.store_id AS VARCHAR) AS primary_store_id, rg.store_region AS primary_region,
        loyalty_status, total_loyalty_points, segment_id, greatest({sql_days(CUT, 'customer_since::TIMESTAMP')}, 0) AS tenure_days,
        avg_days_between_purchases AS avg_days_between_purchases, std_days_between_purchases, avg_purchase_hour AS avg_purchase_hour,
        CASE WHEN h >= 6 AND h < 12 THEN 'morning' WHEN h >= 12 AND h < 17 THEN 'afternoon' WHEN h >= 17 AND h < 21 THEN 'evening' ELSE 'night' END AS preferred_time_of_day,
        ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][CAST(d AS INT) + 1] AS preferred_day,
        weekend_transaction_pct AS weekend_transaction_pct, future_spend_30d AS future_spend_30d, future_transactions_30d, will_purchase_30d
      FROM base b LEFT JOIN basket USING (customer_id) LEFT JOIN cat ON cat.customer_id = b.customer_id AND cat.rn = 1
        LEFT JOIN st ON st.customer_id = b.customer_id AND st.rn = 1 LEFT JOIN rg ON rg.customer_id = b.customer_id AND rg.rn = 1
        LEFT JOIN mh ON mh.customer_id = b.customer_id AND mh.rn = 1 LEFT JOIN md ON md.customer_id = b.customer_id AND md.rn = 1
        LEFT JOIN vs ON vs.customer_id = b.customer_id LEFT JOIN gp ON gp.customer_id = b.customer_id
        LEFT JOIN customers c ON c.customer_id = b.customer_id"""


@query("j_feature_table", "header lines products stores customers", _full_sql())
def feature_table(t):
    out = fj.full_features(t.header, t.lines, t.products, t.stores, t.customers, FULL, CATEGORIES)
    noisy = [c for c in out.columns if c.startswith(("std_", "pct_"))]
    return out.withColumns({c: F.round(c, 4) for c in noisy})


@query(
    "e_features_right", "header customers lines products",
    f"""WITH h AS (SELECT *, transaction_date <= {CUT} AS past FROM header),
        gap AS (SELECT customer_id, {sql_days('transaction_date', 'lag(transaction_date) OVER (PARTITION BY customer_id ORDER BY transaction_date)')} AS gap FROM h WHERE past),
        gm AS (SELECT customer_id, sum(gap)::DOUBLE / nullif(count(gap), 0) AS v FROM gap GROUP BY 1),
        cat AS (SELECT customer_id, product_category, count(*) AS n FROM lines JOIN (SELECT transaction_id, customer_id FROM h WHERE past) USING (transaction_id)
                LEFT JOIN products USING (product_id) GROUP BY ALL),
        fav AS (SELECT customer_id, count(product_category) AS num_categories,
                  arg_min(product_category, (-n, product_category)) FILTER (WHERE product_category IS NOT NULL) AS top_category FROM cat GROUP BY 1)
        SELECT b.customer_id, recency_days, total_frequency, total_monetary, frequency_30d, frequency_60d, frequency_90d,
               monetary_30d, monetary_60d, monetary_90d, avg_order_value, num_stores_visited, is_weekend_shopper,
               CAST(dense_rank() OVER (ORDER BY loyalty_status) - 1 AS BIGINT) AS loyalty_status_encoded,
               CAST(dense_rank() OVER (ORDER BY segment_id) - 1 AS BIGINT) AS segment_id_encoded,
               {sql_days(CUT, 'customer_since::TIMESTAMP')} AS customer_tenure_days, future_spend_30d,
               round(coalesce(gm.v, (SELECT quantile_cont(v, 0.5) FROM gm)), 4) AS avg_days_between_purchases, total_loyalty_points,
               coalesce(num_categories, 1) AS num_categories,
               CAST(dense_rank() OVER (ORDER BY coalesce(top_category, 'Unknown')) - 1 AS BIGINT) AS top_category_encoded
        FROM (SELECT customer_id, {sql_days(CUT, 'max(transaction_date) FILTER (WHERE past)')} AS recency_days,
                count(*) FILTER (WHERE past) AS total_frequency, (sum(total_amount) FILTER (WHERE past))::DOUBLE AS total_monetary,
                """
    + ", ".join(
        f"count(*) FILTER (WHERE past AND transaction_date > {CUT} - INTERVAL {d} DAY) AS frequency_{d}d, "
        f"coalesce(sum(total_amount) FILTER (WHERE past AND transaction_date > {CUT} - INTERVAL {d} DAY), 0)::DOUBLE AS monetary_{d}d"
        for d in (30, 60, 90)
    )
    + f""", (sum(total_amount) FILTER (WHERE past))::DOUBLE / count(*) FILTER (WHERE past) AS avg_order_value,
                count(DISTINCT store_id) FILTER (WHERE past) AS num_stores_visited,
                CAST(avg(CAST(isodow(transaction_date) >= 6 AS INT)) FILTER (WHERE past) > 0.5 AS INT) AS is_weekend_shopper,
                coalesce(sum(total_amount) FILTER (WHERE transaction_date > {CUT} AND transaction_date <= {CUT} + INTERVAL 45 DAY), 0)::DOUBLE AS future_spend_30d
              FROM h GROUP BY customer_id HAVING count(*) FILTER (WHERE past) > 0) b LEFT JOIN customers c ON b.customer_id = c.customer_id
          LEFT JOIN gm ON gm.customer_id = b.customer_id LEFT JOIN fav ON fav.customer_id = b.customer_id""",
)
def features_right(t):
    out = fj.rfm_features(t.header, t.lines, t.products, t.customers, RIGHT45)
    return out.select(
        KEY, "recency_days", "total_frequency", "total_monetary", "frequency_30d", "frequency_60d", "frequency_90d",
        "monetary_30d", "monetary_60d", "monetary_90d", "avg_order_value", "num_stores_visited", "is_weekend_shopper",
        "loyalty_status_encoded", "segment_id_encoded", "customer_tenure_days", "future_spend_30d",
        F.round("avg_days_between_purchases", 4).alias("avg_days_between_purchases"), "total_loyalty_points", "num_categories",
        "top_category_encoded",
    )
