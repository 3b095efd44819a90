"""Stateful streams against the batch queries."""

import datetime as dt
import random
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillsight.operators import customer as cu
from tillsight.operators.periods import FeatureSpec
from tillsight.operators.routing import REASON, tag_header, tag_lines
from tillsight.streaming.state import lookback_stream, route_lines_stream

START = dt.datetime(2000, 1, 1)
HEADER = "transaction_id long, customer_id long, transaction_date timestamp, total_amount decimal(18,2)"


def files(spark, rows, schema, parts, folder):
    """One file a batch, in order."""
    for i, part in enumerate(parts):
        spark.createDataFrame([rows[k] for k in part], schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.fixture(scope="module")
def utc_rows():
    rng = random.Random(8)
    rows = []
    for i in range(240):
        at = START + dt.timedelta(days=i / 4, seconds=rng.randrange(3600))
        rows.append((i, 1 if i % 3 == 0 else rng.randrange(2, 9), at, None if i % 40 == 3 else Decimal(rng.randrange(100, 99999)) / 100))
    rows.append((900, None, START, Decimal(5)))
    return rows


def test_lookbacks_after_every_batch(spark, utc_rows, tmp_path):
    rows = utc_rows
    order = list(range(len(rows) - 1))
    # Within a batch rows come in any order, and some a batch too late but before the watermark.
    parts = [order[i : i + 40] for i in range(0, 240, 40)]
    for i in range(1, 6):
        parts[i].append(parts[i - 1].pop(-2))
    parts[2].append(240)
    late = (901, 1, START + dt.timedelta(days=2), Decimal(77))
    table = [*rows, late]
    parts[4].append(241)  # older than the watermark: not counted
    stream = files(spark, table, HEADER, parts, str(tmp_path / "in"))
    seen = []

    def keep(batch, batch_id):
        seen.append([r.asDict() for r in batch.collect()])

    query = lookback_stream(stream, (7, 20), "2 days").writeStream.foreachBatch(keep).outputMode("update")
    query.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    done = [rows[k] for part in parts for k in part if k < 241]
    frame = spark.createDataFrame(done, HEADER).withColumn("transaction_date", F.col("transaction_date").cast("timestamp_ntz"))
    now, checked = {}, 0
    for batch in seen:
        now.update({r["customer_id"]: r for r in batch})
        cutoff = max(r["cutoff"] for r in batch) if batch else None
        if cutoff is None or cutoff <= dt.date(2000, 1, 1):
            continue
        spec = FeatureSpec(str(cutoff), lookbacks=(7, 20))
        want = {r["customer_id"]: r for r in cu.header_features(frame, spec, measures=cu.window_measures(spec, order_values=False), with_target=False).collect()}
        for who, r in now.items():
            w = want.get(who)
            got = [r[c] for c in ("frequency_7d", "monetary_7d", "frequency_20d", "monetary_20d")]
            assert got == ([w[c] for c in ("frequency_7d", "monetary_7d", "frequency_20d", "monetary_20d")] if w else [0, 0, 0, 0]), (cutoff, who)
            checked += 1
        assert set(want) <= set(now)
    assert checked > 30 and len({r["cutoff"] for b in seen for r in b}) >= 5


LINES = "line_item_id long, transaction_id long, product_id long, quantity int, arrived timestamp"
RAW = "transaction_id long, customer_id long, transaction_date string, total_amount double, store_id string, arrived timestamp"


def test_lines_meet_headers_of_another_stream(spark, tmp_path):
    rng = random.Random(9)
    header, lines = [], []
    for i in range(120):
        at = START + dt.timedelta(minutes=5 * i)
        header.append((i, None if i % 10 == 4 else i % 7, "junk" if i % 15 == 6 else "2000-01-01 10:00:00", -1.0 if i % 20 == 9 else 5.0, "S", at))
        for k in range(3):
            # Early and late lines, all within the wait.
            lines.append((10 * i + k, None if (i + k) % 11 == 5 else i, None if k == 2 and i % 9 == 1 else 3, [1, 0, -2, None, 4][(i + k) % 5],
                          at + dt.timedelta(minutes=rng.randrange(-50, 50))))
    header.append((5, 5, "2000-01-01 10:00:00", 5.0, "S", header[5][-1]))  # a repeated header
    lines += [(5001, 777, 3, 1, START + dt.timedelta(minutes=200)), (5002, 3, 3, 1, START + dt.timedelta(minutes=400))]  # no header; hours after it
    tail = START + dt.timedelta(days=3)
    header.append((9999, 1, "2000-01-01 10:00:00", 1.0, "S", tail))
    lines.append((9999, 9999, 1, 1, tail))
    lines.sort(key=lambda r: r[-1])
    header.sort(key=lambda r: r[-1])
    cut = lambda rows, n: [range(i, min(i + n, len(rows))) for i in range(0, len(rows), n)]
    # The streams move at their own pace, a few files behind each other.
    left = files(spark, lines, LINES, cut(lines, 60), str(tmp_path / "lines"))
    right = files(spark, header, RAW, cut(header, 20), str(tmp_path / "header"))
    out = str(tmp_path / "out")
    route_lines_stream(left, right, out, "1 hour", name=f"route-{uuid.uuid4().hex}").awaitTermination()
    batch = tag_lines(spark.createDataFrame([r for r in lines if r[0] != 5002], LINES), tag_header(spark.createDataFrame(header, RAW)).filter("rejection_reason IS NULL"))
    want = {r["line_item_id"]: r[REASON] for r in batch.collect()} | {5002: "Transaction was rejected"}
    got = [(r["line_item_id"], r[REASON]) for r in spark.read.parquet(f"{out}/rejected/*").collect()]
    got += [(r["line_item_id"], None) for r in spark.read.parquet(f"{out}/accepted/*").collect()]
    assert len(got) == len(dict(got)), "a line is routed once"
    # The last arrivals wait for the watermark; all others are routed as the batch does.
    assert {k: v for k, v in want.items() if k != 9999} == {k: v for k, v in got if k != 9999}
