"""The kept state against the full queries."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillsight.operators import customer as cu
from tillsight.operators.periods import FeatureSpec
from tillsight.operators.upkeep import fold, fold_days, state_measures

SCHEMA = "transaction_id long, customer_id long, transaction_date timestamp_ntz, total_amount decimal(18,2), store_id string"
START = dt.datetime(2000, 1, 1)


def sales(days=60, n=600, seed=2):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        # One customer owns a third of the rows.
        who = 1 if i % 3 == 0 else rng.choice([None, *range(2, 30)])
        at = START + dt.timedelta(days=rng.randrange(days), seconds=rng.randrange(86400))
        out.append((i, who, at, None if i % 50 == 7 else Decimal(rng.randrange(1, 100000)) / 100, "S"))
    return out


@pytest.fixture(scope="module")
def header(spark):
    return spark.createDataFrame(sales(), SCHEMA).repartition(4)


def full(header, spec):
    wide = cu.header_features(header, spec, with_target=False)
    return wide.join(cu.purchase_cadence(header, spec), "customer_id")


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    a, b = (sorted(x.select(sorted(x.columns)).collect(), key=lambda r: r["customer_id"]) for x in (a, b))
    assert len(a) == len(b) > 0
    for x, y in zip(a, b):
        for c in x.asDict():
            if isinstance(x[c], float):
                assert x[c] == pytest.approx(y[c], rel=1e-9, abs=1e-6 if c.startswith("std_order") else 1e-9), c
            else:
                assert x[c] == y[c], (c, x, y)


def day(i):
    return f"{START + dt.timedelta(days=i):%Y-%m-%d}"


def test_thirty_folded_days_are_the_full_query(header):
    spec = FeatureSpec(day(60), lookbacks=(7, 14, 20))
    state = fold_days(header, [day(30), *[day(i) for i in range(31, 61)]], keep=20)
    same(state_measures(state, spec), full(header, spec))
    # Earlier cutoffs inside the kept days follow from the same state.
    early = FeatureSpec(day(54), lookbacks=(7, 14))
    same(state_measures(state, early), full(header, early))


def test_one_fold_is_all_folds(header):
    spec = FeatureSpec(day(45), lookbacks=(10, 30))
    same(state_measures(fold_days(header, [day(45)], keep=30), spec), full(header, spec))


def test_late_rows_inside_the_kept_days_count(spark, header):
    spec = FeatureSpec(day(50), lookbacks=(10, 20))
    delayed = header.filter(F.col("transaction_id") % 4 == 0)
    state = None
    held = header.filter(F.col("transaction_id") % 4 != 0)
    state, none = fold(state, held.filter(F.col("transaction_date") < day(40)), day(40), keep=25)
    assert none.count() == 0
    state, late = fold(state, delayed.unionByName(held.filter(F.col("transaction_date") >= day(40))), day(50), keep=25)
    # The state kept the days from day 15 on; older rows are handed back, not lost.
    assert {r["transaction_id"] for r in late.collect()} == {
        r["transaction_id"] for r in delayed.filter(F.col("customer_id").isNotNull() & (F.col("transaction_date") < day(15))).collect()
    }
    rest = header.join(late.select("transaction_id"), "transaction_id", "left_anti")
    same(state_measures(state, spec), full(rest, spec))


def test_days_without_sales_and_empty_tables(header):
    state = fold_days(header.filter(F.col("transaction_date") < day(10)), [day(20), day(40), day(60)], keep=15)
    spec = FeatureSpec(day(60), lookbacks=(5, 15))
    same(state_measures(state, spec), full(header.filter(F.col("transaction_date") < day(10)), spec))
    nothing = fold_days(header.limit(0), [day(5), day(6)])
    assert state_measures(nothing, spec).count() == 0


def test_state_rows_hold_no_more_than_the_kept_days(header):
    state = fold_days(header, [day(60)], keep=12)
    assert state.agg(F.max(F.size("days"))).first()[0] <= 12
