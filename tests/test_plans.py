"""The physical plans are the ones meant for large data."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SMALL
from tillsight.catalog import ORACLES, QUERIES
from tillsight.operators import customer as cu
from tillsight.operators import joins as j
from tillsight.operators import routing as r
from tillsight.operators.periods import FeatureSpec
from tillsight.plans.feature_job import order_features
from tillsight.sources import files as io
from tillsight.sources.bindings import ORDER_CUTOFF

SPEC = FeatureSpec(ORDER_CUTOFF)


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("Initial Plan")[-1]


def test_single_pass_features_use_one_scan_and_one_shuffle(tables):
    measures = [*cu.lifetime_measures(SPEC), *cu.window_measures(SPEC), *cu.time_measures(SPEC)]
    text = plan(cu.header_features(tables.header, SPEC, measures=measures))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "Join" not in text


def test_cutoff_reaches_the_scan_and_columns_are_pruned(tables):
    text = plan(cu.header_features(tables.header, SPEC, with_target=False))
    assert "LessThan(o_orderdate,2001-01-01T00:00)" in text
    assert "o_orderstatus" not in text


def test_cadence_windows_over_days_not_purchases(tables):
    text = plan(cu.purchase_cadence(tables.header, SPEC))
    window, first_aggregate = text.index("Window"), text.rindex("HashAggregate")
    assert window < first_aggregate  # the aggregate by day feeds the window
    assert text.count("FileScan") == 1


def test_router_does_not_shuffle(tables):
    assert "Exchange" not in plan(r.tag_header(tables.raw_header))


def test_joins_carry_no_forced_broadcast(tables):
    logical = j.lines_with_category(tables.lines, tables.products)._jdf.queryExecution().analyzed().toString()
    assert "hint" not in logical.lower()


def test_skewed_join_is_split(spark, tables):
    """A customer with a third of all sales: the row-level join splits its partition."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "64",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        big = spark.range(0, 60000, 1, 16).select(
            F.col("id").alias("transaction_id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("customer_id")
        )
        customers = spark.range(997).select(F.col("id").alias("customer_id"), F.lit("Gold").alias("loyalty_status"))
        out = j.sales_with_tier(big, customers)
        assert len(out.collect()) == 60000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_headers_with_lines_sort_neither_side(spark):
    """Both parts hash the side with fewer rows; null and repeated keys are those of a left join."""
    header = spark.createDataFrame([(1, 7), (1, 8), (2, 9), (None, 5)], "transaction_id long, customer_id long")
    lines = spark.createDataFrame([(1, 10), (1, 11), (None, 12), (3, 13)], "transaction_id long, line_item_id long")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = j.header_with_lines(header, lines)
        assert "Sort" not in plan(out) and plan(out).count("ShuffledHashJoin") == 2
        found = sorted(map(str, out.collect()))
        assert found == sorted(map(str, header.join(lines, "transaction_id", "left").collect())) and len(found) == 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_sales_join_without_shuffle(spark, tables, tmp_path):
    header = io.write_bucketed(tables.header, "bucketed_header", "transaction_id", 4, str(tmp_path / "h"))
    lines = io.write_bucketed(tables.lines, "bucketed_lines", "transaction_id", 4, str(tmp_path / "l"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = j.lines_of_header(lines, header)
        assert "Exchange" not in plan(out)
        assert out.count() == j.lines_of_header(tables.lines, tables.header).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE bucketed_header")
        spark.sql("DROP TABLE bucketed_lines")


def test_feature_blocks_are_joined_without_new_shuffles(spark, tables):
    """Star join on large data: one shuffle per block, none for the joins."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        base = cu.header_features(tables.header, SPEC)
        cadence = cu.purchase_cadence(tables.header, SPEC)
        text = plan(base.join(cadence, "customer_id", "left"))
        alone = plan(base).count("Exchange") + plan(cadence).count("Exchange")
        assert text.count("Exchange") == alone and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("family", ["momentum32", "two_stage", "interaction"])
def test_feature_table_does_not_broadcast_customers_or_headers_of_visits(spark, tables, family):
    """Files of these tables may look small and their rows be many."""
    text = plan(order_features(tables.header, tables.lines, tables.customers, SPEC, family, coded=False))
    assert "ShuffledHashJoin [customer_id" in text and "SortMergeJoin [transaction_id" in text
    sent = [line for part in text.split("BroadcastExchange")[1:] for line in part.splitlines()[1:2]]
    assert not [line for line in sent if "c_custkey" in line]


def test_constants_are_computed_once(spark):
    df = QUERIES["a_hist50"](spark, SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedSubquery" in final or final.count("FileScan") <= 3


@pytest.mark.parametrize("name", ["j_feature_table", "c_clean_lines", "s_split_last", "v_auc", "a_corr", "m_threshold_grid"])
def test_no_python_workers_and_no_cartesian_product(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_library_has_no_local_checkpoint_cross_join_or_udf():
    words = ("localCheckpoint", "crossJoin", "pandas_udf", "F.udf", "toPandas")
    for folder, _, names in os.walk(os.path.join(ROOT, "tillsight")):
        for n in names:
            if n.endswith(".py"):
                text = open(os.path.join(folder, n)).read()
                assert not [w for w in words if w in text], n


def test_most_queries_have_an_oracle():
    assert len(ORACLES) > 100 and len(ORACLES) / len(QUERIES) > 0.75


@pytest.mark.parametrize("name", ["s_split_last", "s_split_first", "s_tscv", "s_validation_tail"])
def test_split_input_is_computed_once(spark, name):
    """The cut is searched in a written frame: the source is not read again."""
    assert "orders.parquet" not in plan(QUERIES[name](spark, SMALL))
