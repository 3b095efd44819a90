"""Stateful steps on unbounded input: look-backs per customer, and lines joined with headers."""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tillsight.operators.routing import accepted_lines, rejected, tag_header, tag_matched
from tillsight.session import shared_folder
from tillsight.sources.files import write_table

EPOCH = dt.date(1970, 1, 1)
DAY_MS = 86_400_000


def lookback_stream(header: DataFrame, lookbacks: Sequence[int] = (30, 60, 90), delay: str = "1 day", amount: str = "total_amount") -> DataFrame:
    """Look-back counts and sums of every customer as of the watermark's day, as a stream of updates.

    The state of a customer is one bucket per day (purchases, hundredths of the currency) inside
    the longest look-back. A customer's row is emitted when its rows arrive and, by a timer,
    on every day on which one of its buckets enters or leaves a look-back, so the last row of each
    customer is the batch query's row at that cutoff. Rows older than the watermark are not
    counted. Amounts are added as whole hundredths, so order does not matter.
    """
    names = [f"{m}_{d}d" for d in lookbacks for m in ("frequency", "monetary")]
    schema = "customer_id long, cutoff date, " + ", ".join(f"{n} {'long' if n.startswith('f') else 'double'}" for n in names)
    longest = max(lookbacks)

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        days, counts, cents = (list(x) for x in state.get) if state.exists else ([], [], [])
        buckets = {d: [n, c] for d, n, c in zip(days, counts, cents)}
        for batch in batches:
            for day, n, c in zip(batch["day"], batch["n"], batch["cents"]):
                own = buckets.setdefault(int(day), [0, 0])
                own[0] += int(n)
                own[1] += int(c)
        # The watermark is 0 before the first batch is done: nothing lies before the cutoff then.
        cutoff = state.getCurrentWatermarkMs() // DAY_MS
        buckets = {d: x for d, x in buckets.items() if d >= cutoff - longest}
        row = [key[0], EPOCH + dt.timedelta(days=cutoff)]
        for length in lookbacks:
            inside = [x for d, x in buckets.items() if cutoff - length <= d < cutoff]
            row += [sum(x[0] for x in inside), sum(x[1] for x in inside) / 100]
        if buckets:
            order = sorted(buckets)
            state.update((order, [buckets[d][0] for d in order], [buckets[d][1] for d in order]))
            # A bucket counts from the day after it on, and leaves a look-back some days later.
            changes = [d + 1 + wait for d in order for wait in (0, *lookbacks) if d + 1 + wait > cutoff]
            state.setTimeoutTimestamp(min(changes) * DAY_MS)
        else:
            state.remove()
        yield pd.DataFrame([row], columns=["customer_id", "cutoff", *names])

    # The rows of a customer and day travel as they are: what is late is decided by their own time.
    day = F.date_diff(F.col("transaction_date").cast("date"), F.lit(EPOCH))
    cents = F.coalesce(F.round(F.col(amount).cast("decimal(28,4)") * 100), F.lit(0)).cast("long")
    rows = header.filter("customer_id IS NOT NULL").withColumn("transaction_date", F.col("transaction_date").cast("timestamp"))
    rows = rows.withWatermark("transaction_date", delay)
    rows = rows.select(F.col("customer_id").cast("long"), "transaction_date", day.alias("day"), F.lit(1).cast("long").alias("n"), cents.alias("cents"))
    return rows.groupBy("customer_id").applyInPandasWithState(
        update, schema, "days array<long>, counts array<long>, cents array<long>", "update", GroupStateTimeout.EventTimeTimeout
    )


def tagged_lines_stream(lines: DataFrame, header: DataFrame, wait: str = "1 hour", arrived: str = "arrived") -> DataFrame:
    """Raw lines with their ``rejection_reason``, joined with the accepted headers of another stream.

    Both carry the time at which they arrived. A line meets the header of its transaction if the two
    arrive within ``wait`` of each other, whichever comes first; a line whose header has not come by
    then is an orphan, and rows later than the watermark count as never seen. Lines
    without a transaction take no part in the join, where they would be one hot key.
    """
    accepted = tag_header(header).filter("rejection_reason IS NULL AND transaction_id IS NOT NULL")
    accepted = accepted.select(F.col("transaction_id").alias("_id"), F.col(arrived).alias("_arrived")).withWatermark("_arrived", wait)
    accepted = accepted.dropDuplicatesWithinWatermark(["_id"])
    lines = lines.withWatermark(arrived, wait)
    near = F.expr(f"transaction_id = _id AND _arrived >= {arrived} - INTERVAL {wait} AND _arrived <= {arrived} + INTERVAL {wait}")
    met = lines.filter("transaction_id IS NOT NULL").join(accepted, near, "left_outer")
    met = met.select(*lines.columns, F.when(F.col("_id").isNotNull(), True).alias("_accepted"))
    without = lines.filter("transaction_id IS NULL").withColumn("_accepted", F.lit(None).cast("boolean"))
    return tag_matched(met.unionByName(without))


def route_lines_stream(lines: DataFrame, header: DataFrame, folder: str, wait: str = "1 hour", arrived: str = "arrived", name: str = "route_lines") -> StreamingQuery:
    """Splits the lines into accepted and rejected files, batch by batch; a repeated batch replaces its own."""

    def split(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        write_table(accepted_lines(batch), f"{folder}/accepted", f"batch={batch_id}")
        write_table(rejected(batch), f"{folder}/rejected", f"batch={batch_id}")
        batch.unpersist()

    return (
        tagged_lines_stream(lines, header, wait, arrived)
        .writeStream.foreachBatch(split)
        .option("checkpointLocation", shared_folder(lines.sparkSession, name))
        .trigger(availableNow=True)
        .start()
    )


# Its functions travel to the executors by value, so a cluster needs no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
