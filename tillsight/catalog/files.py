"""Readers and writers, checked by writing a table and reading it back."""

import uuid

from pyspark.sql import functions as F

from tillsight.catalog.registry import query, rounded
from tillsight.catalog.views import customer_table, scored
from tillsight.functions.columns import clip, round_even
from tillsight.models.evaluate import evaluate_models
from tillsight.models.scoring import describe_scores
from tillsight.operators import explore as ex
from tillsight.operators import routing as r
from tillsight.session import shared_folder
from tillsight.sources import files as io
from tillsight.sources.inference import infer_types, read_checked, typed


def _folder(t):
    return shared_folder(t.spark, f"tables-{uuid.uuid4().hex}")


@query(
    "io_csv_scan", "raw_header",
    "SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(customer_id AS VARCHAR) AS customer_id, store_id, transaction_date, total_amount::DOUBLE AS total_amount FROM raw_header",
)
def csv_scan(t):
    folder = _folder(t)
    raw = t.raw_header.withColumn("customer_phone", F.lit(None).cast("string"))
    io.write_table(raw, folder, "store_sales_header.csv", "csv")
    return io.read_raw(t.spark, folder, "store_sales_header").drop("customer_phone")


@query(
    "io_malformed_rows", "lines",
    """WITH p AS (SELECT line_item_id, CASE WHEN line_item_id % 50 = 3 THEN 'too few fields' WHEN line_item_id % 70 = 5 THEN 'too many fields'
         WHEN line_item_id % 90 = 7 THEN 'unbalanced quotes' END AS problem, quantity::DOUBLE AS quantity FROM lines)
       SELECT problem, count(*) AS lines, CASE WHEN problem IS NULL THEN sum(quantity) END AS quantity FROM p GROUP BY problem""",
)
def malformed_rows(t):
    """Lines written as text with planted broken ones; the types of the others are inferred."""
    n, cells = F.col("line_item_id"), ["line_item_id", "transaction_id", "product_id", "quantity"]
    whole = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cells])
    broken = F.when(n % 50 == 3, F.concat_ws(",", n.cast("string"), F.lit("x"))).when(n % 70 == 5, F.concat(whole, F.lit(",1")))
    lines = t.lines.select(F.coalesce(broken.when(n % 90 == 7, F.concat(n.cast("string"), F.lit(',"open,1,2'))), whole).alias("value"))
    folder = f"{_folder(t)}/lines"
    lines.write.text(folder)
    rows, rejects = read_checked(t.spark, folder, cells, header=False)
    good = typed(rows, infer_types(rows)).agg(F.lit(None).cast("string").alias("problem"), F.count("*").alias("lines"), F.sum(F.col("quantity").cast("double")).alias("quantity"))
    counts = rejects.groupBy("problem").agg(F.count("*").alias("lines")).withColumn("quantity", F.lit(None).cast("double"))
    return good.unionByName(counts)


@query("io_clean_sink", "accepted", "SELECT transaction_id, customer_id, store_id, transaction_date, total_amount::DOUBLE AS total_amount FROM accepted")
def clean_sink(t):
    accepted = r.accepted_header(r.tag_header(t.raw_header)).withColumn("total_amount", F.col("total_amount").cast("double"))
    return t.spark.read.parquet(io.write_clean({"store_sales_header": accepted}, _folder(t))["store_sales_header"])


@query("io_reject_sink", "tagged", "SELECT transaction_id, transaction_date, rejection_reason FROM tagged WHERE rejection_reason IS NOT NULL")
def reject_sink(t):
    paths = io.write_rejects({"store_sales_header": r.tag_header(t.raw_header)}, _folder(t))
    return t.spark.read.parquet(paths["store_sales_header"]).select("transaction_id", "transaction_date", "rejection_reason")


@query("io_derived_sink", "rfm", "SELECT * FROM rfm")
def derived_sink(t):
    return t.spark.read.parquet(io.write_table(ex.customer_rfm(t.header), _folder(t), "customer_rfm"))


@query(
    "io_predictions", "scored",
    """SELECT customer_id, s AS predicted_spend_30d, CASE WHEN s <= 0 THEN 'Zero' WHEN s <= 25 THEN 'Low' WHEN s <= 75 THEN 'Medium'
         WHEN s <= 200 THEN 'High' ELSE 'VIP' END AS spend_category, round(greatest(s - 42.93, 0), 4) AS prediction_range_low, round(s + 42.93, 4) AS prediction_range_high
       FROM (SELECT customer_id, round_even(predicted / 700 * 100, 0) / 100 AS s FROM scored)""",
)
def predictions(t):
    score = round_even(clip(F.col("predicted") / 700, low=0.0), 2).alias("predicted_spend_30d")
    out = describe_scores(scored(t).select("customer_id", score), 42.93)
    return rounded(t.spark.read.parquet(io.write_table(out, _folder(t), "predictions")))


CATALOGUE = ["recency_days", *[f"{m}_{d}d" for d in (30, 60, 90) for m in ("frequency", "monetary")]]


@query(
    "io_feature_catalogue", "cust",
    " UNION ALL ".join(f"SELECT 'rfm' AS feature_group, '{f}' AS feature, count({f}) AS filled FROM cust" for f in CATALOGUE),
)
def feature_catalogue(t):
    return io.feature_catalogue(customer_table(t))


@query(
    "io_metric_sink", "scored",
    " UNION ALL ".join(
        f"SELECT '{n}' AS model, round(avg(abs(future_spend_30d - {c})), 3) AS mae, round(sqrt(avg((future_spend_30d - {c}) ** 2)), 3) AS rmse FROM scored"
        for n, c in (("Recent", "predicted"), ("Lifetime", "amount"))
    ),
)
def metric_sink(t):
    board = evaluate_models(scored(t), "future_spend_30d", {"Recent": "predicted", "Lifetime": "amount"})
    written = t.spark.read.parquet(io.write_table(board, _folder(t), "model_comparison"))
    return written.select("model", F.round("mae", 3).alias("mae"), F.round("rmse", 3).alias("rmse"))
