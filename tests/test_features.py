import datetime as dt
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import by_key, values
from tillsight.operators import bins as b
from tillsight.operators import customer as cu
from tillsight.operators import derived as d
from tillsight.operators import explore as ex
from tillsight.operators import splits as s
from tillsight.operators.periods import FeatureSpec, future_rows, history_rows
from tillsight.plans import feature_job as fj
from tillsight.sources.bindings import CATEGORIES, ORDER_CUTOFF
from tillsight.sources.schemas import PRESETS, TARGETS

HEADER = "transaction_id long, customer_id string, store_id string, transaction_date timestamp_ntz, total_amount double"
CUT = dt.datetime(2025, 1, 1)
SPEC = FeatureSpec("2025-01-01")


def make_header(spark, rows):
    return spark.createDataFrame([(i, c, st, t, float(a)) for i, (c, st, t, a) in enumerate(rows)], HEADER)


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 sales; one customer owns a third of them, half of those on one day."""
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        customer = "hot" if i % 3 == 0 else f"c{rnd.randrange(300)}"
        when = CUT - dt.timedelta(seconds=rnd.randrange(1, 500 * 86400))
        if customer == "hot" and i % 2 == 0:
            when = dt.datetime(2024, 11, 29) + dt.timedelta(seconds=rnd.randrange(86400))
        if i % 40 == 1:
            when = CUT + dt.timedelta(days=rnd.randrange(45))
        rows.append((customer, f"s{rnd.randrange(6)}", when, rnd.randrange(1, 50000) / 100))
    rows.append((None, "s1", CUT - dt.timedelta(days=1), 5.0))
    return rows, make_header(spark, rows).repartition(6)


def test_window_bounds(spark):
    one = dt.timedelta(days=1)
    times = [CUT - 30 * one, CUT - 30 * one - dt.timedelta(seconds=1), CUT, CUT + 30 * one, CUT + 29 * one]
    df = make_header(spark, [("c", "s", t, 1) for t in times])
    left, right = SPEC, FeatureSpec("2025-01-01", bounds="right")
    ids = lambda x: sorted(r[0] for r in x.select("transaction_id").collect())
    assert ids(history_rows(df, left)) == [0, 1] and ids(history_rows(df, right)) == [0, 1, 2]
    assert ids(future_rows(df, left)) == [2, 4] and ids(future_rows(df, right)) == [3, 4]
    assert ids(df.filter(left.lookback("transaction_date", 30))) == [0]
    assert ids(df.filter(right.lookback("transaction_date", 30))) == [2]


def test_header_features_with_hot_customer(skewed):
    rows, header = skewed
    got = by_key(cu.header_features(header, SPEC), "customer_id")
    past = defaultdict(list)
    for c, _, t, a in rows:
        if c is not None and t < CUT:
            past[c].append((t, a))
    assert set(got) == set(past)
    for c, sales in past.items():
        row, amounts = got[c], [a for _, a in sales]
        assert row["frequency_total"] == len(sales)
        assert row["monetary_total"] == pytest.approx(sum(amounts))
        assert row["std_order_value"] == pytest.approx(np.std(amounts, ddof=1) if len(sales) > 1 else 0.0)
        assert row["recency_days"] == (CUT - max(t for t, _ in sales)).days
        for n in SPEC.lookbacks:
            inside = [a for t, a in sales if t >= CUT - dt.timedelta(days=n)]
            assert row[f"frequency_{n}d"] == len(inside)
            assert row[f"avg_order_value_{n}d"] == pytest.approx(np.mean(inside) if inside else 0.0)
        ahead = [a for k, _, t, a in rows if k == c and CUT <= t < CUT + dt.timedelta(days=30)]
        assert row["future_spend_30d"] == pytest.approx(sum(ahead)) and row["will_purchase_30d"] == int(bool(ahead))
        f = [row[f"frequency_{n}d"] for n in SPEC.lookbacks]
        assert f == sorted(f) and f[-1] <= row["frequency_total"]


def test_cadence_with_hot_customer(skewed):
    rows, header = skewed
    got = by_key(cu.purchase_cadence(header, SPEC), "customer_id")
    times = defaultdict(list)
    for c, _, t, _ in rows:
        if c is not None and t < CUT:
            times[c].append(t)
    for c, ts in times.items():
        ts.sort()
        gaps = [(y - x).days for x, y in zip(ts, ts[1:])]
        assert got[c]["avg_days_between_purchases"] == pytest.approx(np.mean(gaps) if gaps else 0.0)
        assert got[c]["std_days_between_purchases"] == pytest.approx(np.std(gaps, ddof=1) if len(gaps) > 1 else 0.0)


def test_cadence_edges(spark):
    t = dt.datetime(2024, 1, 1, 20)
    h = dt.timedelta(hours=1)
    rows = [("one", t)] + [("two", t), ("two", t + 20 * h)] + [("three", t), ("three", t + 30 * h), ("three", t + 100 * h)]
    got = by_key(cu.purchase_cadence(make_header(spark, [(c, "s", x, 1) for c, x in rows])), "customer_id")
    assert (got["one"]["avg_days_between_purchases"], got["two"]["avg_days_between_purchases"]) == (0.0, 0.0)
    assert got["three"]["avg_days_between_purchases"] == 1.5 and got["three"]["std_days_between_purchases"] == pytest.approx(np.std([1, 2], ddof=1))
    filled = by_key(cu.average_gap(make_header(spark, [(c, "s", x, 1) for c, x in rows])), "customer_id")
    assert filled["one"]["avg_gap_days"] == 0.75


def test_habits(skewed):
    rows, header = skewed
    got = by_key(cu.header_features(header, SPEC, measures=cu.time_measures(SPEC), with_target=False), "customer_id")
    hours, days, months = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for c, _, t, _ in rows:
        if c is not None and t < CUT:
            hours[c][t.hour] += 1
            days[c][t.weekday()] += 1
            months[c].add(t.month)
    for c in hours:
        assert got[c]["most_common_hour"] == min(h for h, n in hours[c].items() if n == max(hours[c].values()))
        assert got[c]["most_common_dow"] == min(x for x, n in days[c].items() if n == max(days[c].values()))
        assert got[c]["active_months"] == len(months[c])


def test_top_value_ties_and_unknown_categories(spark):
    t = CUT - dt.timedelta(days=1)
    header = make_header(spark, [("tie", "s", t, 1), ("unknown", "s", t, 1), ("empty", "s", t, 1)])
    lines = spark.createDataFrame(
        [(0, "b", 1.0, 30.0), (0, "a", 1.0, 10.0), (1, "zzz", 2.0, 5.0)],
        "transaction_id long, product_id string, quantity double, line_item_amount double",
    )
    products = spark.createDataFrame([("a", "Apples & Co"), ("b", "Books")], "product_id string, product_category string")
    got = by_key(cu.basket_features(lines, header, products, SPEC, ["Apples & Co", "Books"]), "customer_id")
    assert got["tie"]["top_category"] == "Apples & Co"
    assert got["tie"]["pct_spend_apples_&_co"] == 0.25 and got["tie"]["pct_spend_books"] == 0.75
    assert got["unknown"]["top_category"] is None and got["unknown"]["unique_products"] == 1 and got["unknown"]["pct_spend_books"] == 0.0
    assert "empty" not in got


def test_stores_with_hot_customer(spark, skewed):
    rows, header = skewed
    stores = spark.createDataFrame([(f"s{i}", f"r{i % 2}") for i in range(5)], "store_id string, store_region string")
    got = by_key(cu.store_features(header, stores, SPEC), "customer_id")
    counts = defaultdict(Counter)
    for c, st, t, _ in rows:
        if c is not None and t < CUT:
            counts[c][st] += 1
    for c, k in counts.items():
        assert got[c]["unique_stores"] == len(k)
        assert got[c]["primary_store_id"] == min(x for x, n in k.items() if n == max(k.values()))
        regions = Counter()
        for st, n in k.items():
            if st != "s5":
                regions[f"r{int(st[1]) % 2}"] += n
        assert got[c]["unique_regions"] == len(regions)
        assert got[c]["primary_region"] == (min(x for x, n in regions.items() if n == max(regions.values())) if regions else None)


def test_full_table_has_56_columns_and_no_leak(tables):
    spec = FeatureSpec(ORDER_CUTOFF)
    t = tables
    full = fj.full_features(t.header, t.lines, t.products, t.stores, t.customers, spec, CATEGORIES)
    assert len(full.columns) == 56 - 11 + len(CATEGORIES)
    later = t.header.filter(F.col("transaction_date") >= ORDER_CUTOFF).withColumn("total_amount", F.col("total_amount") * 3)
    changed = t.header.filter(F.col("transaction_date") < ORDER_CUTOFF).unionByName(later.withColumn("total_amount", F.col("total_amount").cast("decimal(18,2)")))
    features = [c for c in full.columns if c not in TARGETS]
    other = fj.full_features(changed, t.lines, t.products, t.stores, t.customers, spec, CATEGORIES)
    quoted = [f"`{c}`" for c in features]
    assert full.select(*quoted).exceptAll(other.select(*quoted)).count() == 0
    shares = [c for c in full.columns if c.startswith("pct_spend")]
    sums = full.select(sum(F.col(f"`{c}`") for c in shares).alias("s")).filter("s > 0 AND abs(s - 1) > 1e-9")
    assert sums.count() == 0


@pytest.mark.parametrize("family", ["momentum32", "two_stage", "interaction", "velocity"])
def test_order_families(tables, family):
    spec = FeatureSpec(ORDER_CUTOFF, lookbacks=(7, 14, 30, 60, 90))
    df = fj.order_features(tables.header, tables.lines, tables.customers, spec, family)
    assert set(PRESETS[family]) <= set(df.columns)
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in PRESETS[family]]).first().asDict()
    assert not any(nulls.values()), nulls


def test_preset_sizes():
    assert {k: len(v) for k, v in PRESETS.items() if k in ("base51", "rfm19", "momentum32")} == {"base51": 51, "rfm19": 19, "momentum32": 32}


def test_tiers_and_buckets(spark):
    xs = [0.0, 0.01, 25.0, 75.0, 200.0, 200.01, 99.99, 100.0, 300.0, 500.0, 1000.0, 1000.01]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = {r["x"]: r for r in df.select("x", d.score_tier("x").alias("s"), d.value_tier("x").alias("v"), d.spend_bucket("x").alias("b")).collect()}
    assert [got[x]["s"] for x in xs[:6]] == ["Zero", "Low", "Low", "Medium", "High", "VIP"]
    assert [got[x]["v"] for x in (0.0, 99.99, 100.0, 300.0, 500.0)] == ["Inactive", "Low Value", "Medium Value", "Medium-High Value", "High Value"]
    assert [got[x]["b"] for x in (0.0, 0.01, 100.0, 500.0, 1000.0, 1000.01)] == [0, 1, 1, 2, 3, 4]


def test_tenure_variants(spark):
    df = spark.sql("SELECT timestamp_ntz'2025-02-01' since UNION ALL SELECT null")
    got = values(df.select(d.tenure(SPEC, "since", clipped=True).alias("a"), d.tenure(SPEC, "since", fill=365).alias("b")).orderBy("b"), "a", "b")
    assert got == [(0, -31), (None, 365)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)], "x double")
    got = dict(values(b.histogram(df, "x", 5), "bin", "rows"))
    assert got == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}
    flat = spark.createDataFrame([(3.0,)] * 4, "x double")
    assert values(b.histogram(flat, "x", 5), "bin", "rows") == [(2, 4)]


def test_skewness_and_correlation(spark):
    rnd = random.Random(5)
    xs = [rnd.lognormvariate(0, 1) for _ in range(200)]
    n, m = len(xs), np.mean(xs)
    g1 = np.mean((xs - m) ** 3) / np.mean((xs - m) ** 2) ** 1.5
    df = spark.createDataFrame([(x, 2 * x + rnd.random()) for x in xs] + [(1.0, None)], "x double, y double")
    got = ex.skewness(df.filter("y IS NOT NULL"), "x").first()["skewness"]
    assert got == pytest.approx(g1 * np.sqrt(n * (n - 1)) / (n - 2))
    pairs = {(r["x"], r["y"]): r["corr"] for r in ex.correlations(df, ["x", "y"]).collect()}
    ys = [r["y"] for r in df.filter("y IS NOT NULL").collect()]
    assert pairs[("x", "y")] == pairs[("y", "x")] == pytest.approx(np.corrcoef(xs, ys)[0, 1])


def test_temporal_split_with_a_hot_day(spark):
    rnd = random.Random(2)
    rows = [(i, dt.datetime(2024, 5, 5) if i % 3 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randrange(300 * 86400))) for i in range(1001)]
    df = spark.createDataFrame(rows, "customer_id long, last_purchase timestamp_ntz").repartition(5)
    split = s.temporal_split(df)
    counts = dict(split.groupBy("split").count().collect())
    assert counts == {"train": 800, "test": 201}
    edge = split.agg(F.max(F.when(F.col("split") == "train", F.col("last_purchase"))).alias("a"), F.min(F.when(F.col("split") == "test", F.col("last_purchase"))).alias("b")).first()
    assert edge["a"] <= edge["b"]
    again = s.temporal_split(df.repartition(3))
    assert split.exceptAll(again).count() == 0


@pytest.mark.parametrize("n", [7, 23, 60])
def test_time_series_folds(spark, n):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i // 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "customer_id long, last_purchase timestamp_ntz")
    got = s.time_series_folds(df).groupBy("fold", "role").agg(F.count(F.lit(1)).alias("n"), F.max("last_purchase").alias("hi"), F.min("last_purchase").alias("lo")).collect()
    size = n // 6
    by = {(r["fold"], r["role"]): r for r in got}
    for fold in range(5):
        assert by[(fold, "test")]["n"] == size
        assert by[(fold, "train")]["n"] == n - (5 - fold) * size
        assert by[(fold, "train")]["hi"] <= by[(fold, "test")]["lo"]


def test_oversample(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0)], "customer_id int, future_spend_30d double")
    assert dict(s.oversample(df).groupBy("customer_id").count().collect()) == {1: 1, 2: 4}


def test_rfm_and_summary(spark, skewed):
    rows, header = skewed
    rfm = ex.customer_rfm(header)
    last = max(t for _, _, t, _ in rows) + dt.timedelta(days=1)
    got = by_key(rfm, "customer_id")
    hot = [(t, a) for c, _, t, a in rows if c == "hot"]
    assert got["hot"]["recency"] == (last - max(t for t, _ in hot)).days and got["hot"]["frequency"] == len(hot)
    one = ex.activity_summary(rfm).first()
    spend = [r["monetary"] for r in got.values()]
    assert one["customers"] == len(got) and one["high_value"] == sum(x > np.quantile(spend, 0.9) for x in spend)
