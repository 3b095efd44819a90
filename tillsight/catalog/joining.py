"""Lookups and star joins."""

from pyspark.sql import functions as F

from tillsight.catalog.registry import FUTURE, PAST, query, rounded
from tillsight.catalog.views import SPEC, customer_table
from tillsight.functions.ordering import attach, exact_quantiles
from tillsight.operators import customer as cu
from tillsight.operators import explore as ex
from tillsight.operators import joins as j
from tillsight.operators import routing as r
from tillsight.operators.periods import future_rows, history_rows, known_customers
from tillsight.operators.profiling import key_overlap
from tillsight.operators.splits import temporal_split


@query("j_line_product", "lines products", "SELECT line_item_id, l.product_id, product_category FROM lines l LEFT JOIN products USING (product_id)")
def line_product(t):
    return j.lines_with_category(t.lines, t.products).select("line_item_id", "product_id", "product_category")


@query(
    "j_header_lines_left", "header lines",
    "SELECT h.transaction_id, customer_id, line_item_id, quantity FROM header h LEFT JOIN lines USING (transaction_id)",
)
def header_lines_left(t):
    return j.header_with_lines(t.header, t.lines).select("transaction_id", "customer_id", "line_item_id", "quantity")


@query(
    "j_lines_history", "header lines",
    f"SELECT line_item_id, transaction_id, customer_id FROM lines JOIN (SELECT * FROM header WHERE {PAST}) USING (transaction_id)",
)
def lines_history(t):
    return j.lines_of_header(t.lines, history_rows(t.header, SPEC)).select("line_item_id", "transaction_id", "customer_id")


@query(
    "j_rollup_inner", "sales",
    "SELECT transaction_id, customer_id, line_total::DOUBLE AS line_total, quantity, num_products FROM sales",
)
def rollup_inner(t):
    out = cu.sales_with_lines(t.header, t.lines)
    return out.select("transaction_id", "customer_id", F.col("line_total").cast("double"), "quantity", "num_products")


@query("j_header_stores", "header stores", "SELECT transaction_id, h.store_id, store_region FROM header h LEFT JOIN stores USING (store_id)")
def header_stores(t):
    return j.header_with_region(t.header, t.stores).select("transaction_id", "store_id", "store_region")


@query("j_header_customers", "header customers", "SELECT transaction_id, customer_id, loyalty_status, segment_id FROM header JOIN customers USING (customer_id)")
def header_customers(t):
    out = j.sales_with_tier(t.header, t.customers, ("loyalty_status", "segment_id"))
    return out.select("transaction_id", "customer_id", "loyalty_status", "segment_id")


@query(
    "j_attributes", "cust customers",
    "SELECT customer_id, total_frequency, loyalty_status, segment_id FROM cust LEFT JOIN customers USING (customer_id)",
)
def attributes(t):
    out = j.with_attributes(customer_table(t), t.customers)
    return out.select("customer_id", "total_frequency", "loyalty_status", "segment_id")


@query(
    "j_target", "header",
    f"""SELECT b.customer_id, coalesce(x.future_spend_30d, 0) AS future_spend_30d
        FROM (SELECT DISTINCT customer_id FROM header WHERE {PAST}) b LEFT JOIN
             (SELECT customer_id, sum(total_amount)::DOUBLE AS future_spend_30d FROM header WHERE {FUTURE} GROUP BY 1) x USING (customer_id)""",
)
def target(t):
    spend = future_rows(t.header, SPEC).groupBy("customer_id").agg(cu.total("total_amount").alias("future_spend_30d"))
    return j.with_target(known_customers(t.header, SPEC), spend)


@query(
    "j_orphan_anti", "raw_lines accepted",
    """SELECT line_item_id, transaction_id FROM raw_lines l WHERE transaction_id IS NOT NULL
       AND NOT EXISTS (SELECT 1 FROM accepted a WHERE a.transaction_id = l.transaction_id)""",
)
def orphan_anti(t):
    accepted = r.accepted_header(r.tag_header(t.raw_header))
    return r.orphan_lines(t.raw_lines, accepted).select("line_item_id", "transaction_id")


@query(
    "j_matched_semi", "raw_lines accepted",
    "SELECT line_item_id, transaction_id FROM raw_lines WHERE transaction_id IN (SELECT transaction_id FROM accepted)",
)
def matched_semi(t):
    accepted = r.accepted_header(r.tag_header(t.raw_header))
    return r.matched_lines(t.raw_lines, accepted).select("line_item_id", "transaction_id")


@query(
    "j_customers_spend", "customers header",
    """SELECT c.customer_id, coalesce(s, 0) AS total_spend FROM customers c LEFT JOIN
       (SELECT customer_id, sum(total_amount)::DOUBLE AS s FROM header GROUP BY 1) x ON c.customer_id = x.customer_id""",
)
def customers_spend(t):
    return ex.spend_of_all_customers(t.customers, t.header)


@query(
    "j_scalar_broadcast", "header",
    """SELECT transaction_id, round(total_amount::DOUBLE / (SELECT quantile_cont(total_amount::DOUBLE, 0.99) FROM header), 4) AS share_of_p99 FROM header""",
)
def scalar_broadcast(t):
    rows = attach(t.header, exact_quantiles(t.header, "total_amount", {"q": 0.99}))
    return rounded(rows.select("transaction_id", (F.col("total_amount").cast("double") / F.col("_k.q")).alias("share_of_p99")))


@query(
    "u_overlap", "split",
    """SELECT count(*) AS shared_keys FROM (SELECT customer_id FROM split WHERE split = 'train' INTERSECT
       SELECT customer_id FROM split WHERE split = 'test')""",
)
def overlap(t):
    split = temporal_split(customer_table(t))
    return key_overlap(split.filter("split = 'train'"), split.filter("split = 'test'"), "customer_id")


@query(
    "u_buyers_and_events", "header purchases",
    "SELECT count(*) AS shared_keys FROM (SELECT customer_id FROM header INTERSECT SELECT customer_id FROM purchases)",
)
def buyers_and_events(t):
    return key_overlap(t.header, t.purchases, "customer_id")
