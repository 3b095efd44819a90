import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import by_key, values
from tillsight.functions import columns as fc
from tillsight.operators import cleaning as c
from tillsight.operators import profiling as p
from tillsight.operators import routing as r


def day(*x):
    return dt.datetime(*x)


DATES = [
    ("2023-01-15 10:30:00", day(2023, 1, 15, 10, 30)),
    ("2023-01-15 10:30", day(2023, 1, 15, 10, 30)),
    ("2023-01-15", day(2023, 1, 15)),
    ("2023/01/15", day(2023, 1, 15)),
    ("15/01/2023", day(2023, 1, 15)),
    ("01-15-2023", day(2023, 1, 15)),
    ("15-01-2023 10:30", day(2023, 1, 15, 10, 30)),
    ("15-01-2023", day(2023, 1, 15)),
    ("03-04-2023", day(2023, 3, 4)),
    ("1/2/2023", day(2023, 2, 1)),
    (" 2023-01-15\t", day(2023, 1, 15)),
    ("2023-1-5 7:03", day(2023, 1, 5, 7, 3)),
    ("2023-1-5 7:3:9", day(2023, 1, 5, 7, 3, 9)),
    ("2023-01-15T10:30:00", None),
    ("2023-01-15 10:30:00 UTC", None),
    ("2023-01", None),
    ("2023-02-30", None),
    ("12023-01-01", None),
    ("", None),
    ("garbage", None),
    (None, None),
]


def test_parse_date(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(DATES)], "id int, s string")
    got = by_key(df.select("id", fc.parse_date("s").alias("d")))
    assert [got[i]["d"] for i in range(len(DATES))] == [d for _, d in DATES]


def test_contacts(spark):
    rows = [(1, "a@b.co", "(123) 456-7890"), (2, "ab.co", "12345"), (3, "N/A", "unknown"), (4, None, None), (5, " x@y.org\n", "1234567890")]
    df = spark.createDataFrame(rows, "id int, e string, p string")
    got = values(df.select("id", fc.valid_email("e").alias("e"), fc.valid_phone("p").alias("p")), "id", "e", "p")
    assert got == [(1, True, True), (2, False, False), (3, False, False), (4, False, False), (5, True, True)]


def test_title_case(spark):
    df = spark.createDataFrame([("home & garden",), ("o'neil CO-OP",), ("ÉCLAIR",)], "s string")
    assert values(df.select(fc.title_case("s").alias("t")), "t") == [("Home & Garden",), ("O'Neil Co-Op",), ("Éclair",)]


def test_null_tokens(spark):
    df = spark.createDataFrame([("N/A", 1), (" null ", 2), ("NAN", 3), ("", 4), ("ok", 5), (None, 6)], "s string, n int")
    assert [x[0] for x in values(fc.null_tokens_to_null(df), "s")] == [None, None, None, None, "ok", None]


def test_days_between_floors(spark):
    df = spark.sql("SELECT timestamp_ntz'2023-01-01 14:00:00' a, timestamp_ntz'2023-01-03 00:00:00' b")
    assert values(df.select(fc.days_between("a", "b").alias("x"), fc.days_between("b", "a").alias("y")), "x", "y") == [(-2, 1)]


def test_stores(spark):
    rows = [(1, None, "Chicago", "N", "2019/03/09"), (2, "Miami Store", None, "S", "x"), (3, None, None, "E", None)]
    got = by_key(c.clean_stores(spark.createDataFrame(rows, "store_id int, store_name string, store_city string, store_region string, opening_date string")), "store_id")
    assert got[1]["store_name"] == "Chicago Store" and got[1]["opening_date"] == "2019-03-09"
    assert got[2]["store_city"] == "Miami" and got[2]["opening_date"] == "2018-01-01"
    assert got[3]["store_name"] is None and got[3]["store_city"] is None


PRODUCTS = "product_id string, product_name string, product_category string, unit_price double, current_stock_level double"


@pytest.fixture
def products(spark):
    rows = [
        ("a", "A", "Electronics ", -35.29, -5.0), ("b", None, "electronics", 2785.0, None), ("c", "C", "ELECTRONICS", -2785.0, 3.0),
        ("d", "D", "Electronics", None, 1.0), ("e", "E", None, None, 1.0), ("f", "F", "toys", 1000.0, 1.0), ("g", "G", "Toys", 10.0, 1.0),
    ]
    return spark.createDataFrame(rows, PRODUCTS)


def test_products(products):
    got = by_key(c.clean_products(products), "product_id")
    prices = {k: round(v["unit_price"], 4) for k, v in got.items()}
    assert prices["a"] == 35.29 and prices["b"] == 27.85 and prices["c"] == 27.85 and prices["f"] == 1000.0
    assert prices["d"] == 27.85  # median of 27.85, 27.85, 35.29
    assert prices["e"] == 27.85 + (35.29 - 27.85) * 0  # all-null category: median of all prices
    assert got["a"]["product_category"] == "Electronics" and got["e"]["product_category"] == "Unknown"
    assert got["a"]["current_stock_level"] == 0 and got["b"]["current_stock_level"] == 0
    assert got["b"]["product_name"] == "Product_b"


def test_product_audit_keeps_value_before_scaling(products):
    got = by_key(c.audit_products(products), "product_id")
    assert {k: v["unit_price"] for k, v in got.items()} == {"b": 2785.0, "c": 2785.0}
    assert got["b"]["product_name"] is None and got["b"]["rejection_reason"] == c.PRICE_AUDIT


def test_promotions(spark):
    rows = [(1, None, "2023-01-01", None, -0.1, None), (2, "p", "2023/02/01", "2023-03-01", 1.295, "X"), (3, "q", "2023-01-01", "2023-01-05", 1.0, "X"), (4, "r", "2023-01-01", "2023-01-05", None, "X")]
    df = spark.createDataFrame(rows, "promotion_id int, promotion_name string, start_date string, end_date string, discount_percentage double, applicable_category string")
    got = by_key(c.clean_promotions(df), "promotion_id")
    assert [got[i]["discount_percentage"] for i in (1, 2, 3, 4)] == [0.0, 0.5, 1.0, 0.1]
    assert got[1]["end_date"] == "2023-01-31" and got[1]["applicable_category"] == "ALL"
    audit = by_key(c.audit_promotions(df), "promotion_id")
    assert {k: v["discount_percentage"] for k, v in audit.items()} == {1: -0.1, 2: 1.295}


def test_customers_and_rules(spark):
    df = spark.createDataFrame(
        [("c", None, "bad", " gold", None, "01/02/2023", None, "123", "garbage"), ("d", "X", "x@y.org", None, 5.0, None, "S1", "0123456789", "2020-01-01")],
        "customer_id string, first_name string, email string, loyalty_status string, total_loyalty_points double, last_purchase_date string, segment_id string, customer_phone string, customer_since string",
    )
    got = by_key(c.clean_customers(df), "customer_id")
    assert got["c"] == {
        "customer_id": "c", "first_name": "Unknown", "email": None, "loyalty_status": "Gold", "total_loyalty_points": 0.0,
        "last_purchase_date": "2023-02-01", "segment_id": "NR", "customer_phone": None, "customer_since": None,
    }
    assert got["d"]["loyalty_status"] == "Bronze" and got["d"]["email"] == "x@y.org"
    rules = spark.createDataFrame([(6, None, None)], "rule_id int, rule_name string, bonus_points int")
    assert values(c.clean_rules(rules), "rule_name", "bonus_points") == [("Rule_6", 0)]


def test_line_amounts_with_unknown_and_duplicate_products(spark):
    prices = spark.createDataFrame([("a", 3.0), ("a", 5.0), ("n", None)], "product_id string, unit_price double")
    lines = spark.createDataFrame([(1, "a", 2.0, None), (2, "z", 2.0, None), (3, "a", 2.0, 9.5), (4, "n", 1.0, None)], "id int, product_id string, quantity double, line_item_amount double")
    got = by_key(c.impute_line_amount(lines, prices))
    assert {k: v["line_item_amount"] for k, v in got.items()} == {1: 6.0, 2: 40.0, 3: 9.5, 4: 20.0}


HEADER = "transaction_id string, customer_id string, store_id string, transaction_date string, total_amount double"


@pytest.fixture
def header(spark):
    rows = [
        ("t1", "c1", "s1", "2023-01-01 10:00:00", 5.0), ("t2", None, "s1", "x", None), ("t3", "c1", "s1", "x", -1.0),
        ("t4", "c1", "s1", "2023-01-01", -1.0), ("t5", "c1", "s1", "2023-01-01", None), ("t6", "c2", None, "01-15-2023", 0.0),
    ]
    return spark.createDataFrame(rows, HEADER)


def test_header_router_first_reason_wins(header):
    got = by_key(r.tag_header(header), "transaction_id")
    names = {v: k for k, v in r.HEADER_REASONS.items()}
    assert {k: names.get(v["rejection_reason"]) for k, v in got.items()} == {
        "t1": None, "t2": "no_customer", "t3": "bad_date", "t4": "negative", "t5": "no_amount", "t6": None,
    }


def test_header_outputs_partition_the_input(header):
    tagged = r.tag_header(header)
    assert r.accepted_header(tagged).count() + r.rejected(tagged).count() == header.count()
    assert values(r.accepted_header(tagged, as_text=True).orderBy("transaction_id"), "transaction_date", "store_id") == [
        ("2023-01-01 10:00:00", "s1"), ("2023-01-15 00:00:00", "UNKNOWN"),
    ]
    # Rejects carry the raw date text.
    assert ("t3", "x") in values(r.rejected(tagged), "transaction_id", "transaction_date")


def test_line_router(spark, header):
    rows = [(1, None, "p", 1.0), (2, "t3", "p", 1.0), (3, "t1", "p", 0.0), (4, "t1", "p", -1.0), (5, "t1", "p", None), (6, "t1", None, 1.0), (7, "t1", "p", 2.0), (8, "nope", None, 0.0)]
    lines = spark.createDataFrame(rows, "line_item_id int, transaction_id string, product_id string, quantity double")
    accepted = r.accepted_header(r.tag_header(header))
    tagged = r.tag_lines(lines, accepted)
    names = {v: k for k, v in r.LINE_REASONS.items()}
    got = {k: names.get(v["rejection_reason"]) for k, v in by_key(tagged, "line_item_id").items()}
    assert got == {1: "no_transaction", 2: "orphan", 3: "zero", 4: "negative", 5: "no_quantity", 6: "no_product", 7: None, 8: "orphan"}
    assert r.accepted_lines(tagged).columns == lines.columns
    assert r.orphan_lines(lines, accepted).count() == 2 and r.matched_lines(lines, accepted).count() == 5


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert sorted(values(p.missing_profile(df, "t"), "column_name", "missing", "missing_pct")) == [("a", 1, 33.33), ("b", 2, 66.67)]
    assert values(p.null_total({"t": df}), "null_cells") == [(3,)]


def test_outlier_fences_are_strict(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 5, 100)] + [(None,)], "x double")
    got = dict(values(p.detect_outliers(df, "x"), "x", "is_outlier"))
    assert got[100.0] is True and got[5.0] is False and got[None] is False


def test_rule_errors(spark):
    row = {n: 1.0 for n, _, _ in p.FEATURE_RANGES}
    bad = {**row, "recency_days": -1.0, "avg_order_value": 10001.0, "num_stores_visited": 16.0}
    df = spark.createDataFrame([row, bad])
    got = values(p.validate_features(df).orderBy("recency_days"), "errors", "is_valid")
    assert got[0][0] == ["recency_days below 0", "avg_order_value above 10000", "num_stores_visited above 15"]
    assert got[1] == ([], True)


def test_required_columns(spark):
    df = spark.range(1)
    assert p.missing_columns(df, ["id", "x"]) == ["x"]
    with pytest.raises(ValueError, match="x"):
        p.require_columns(df, ["x"])


def test_day_parts(spark):
    df = spark.range(24).select(fc.day_part(F.col("id")).alias("p"))
    assert [x[0] for x in values(df, "p")] == ["night"] * 6 + ["morning"] * 6 + ["afternoon"] * 5 + ["evening"] * 4 + ["night"] * 3
