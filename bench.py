"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores. Every query is run in full
into Spark's no-op sink, once to warm up and then BENCH_RUNS (default 3) times, of which
the median counts. The five look-backs run in turn with their literal form.
Boosted and forest models run in the correctness and test runs only: their named presets
grow hundreds of trees.
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from pyspark.sql import functions as F

from tillsight import build_session
from tillsight.catalog import QUERIES
from tillsight.sources.bindings import ORDER_CUTOFF, Tables

HEADLINES = [
    "a_rfm_target", "a_windows", "a_customer13", "a_category_share_pivot", "a_stores", "a_category_revenue",
    "a_monthly", "a_describe", "a_corr", "a_hist50", "j_feature_table", "j_rollup_inner", "w_cadence",
    "f_route_header", "f_route_lines", "c_price_impute", "c_clean_lines", "q_iqr_outliers", "q_missing_profile",
    "e_momentum", "s_split_last", "s_tscv", "m_threshold_grid", "v_auc", "v_regression", "sc_batch",
]


def literal_windows(spark, folder):
    """The five look-backs written as filter, group and merge, for comparison
    with the single-pass a_windows."""
    header = Tables(spark, folder).header
    cutoff = F.lit(ORDER_CUTOFF).cast("timestamp_ntz")
    past = header.filter(F.col("transaction_date") < cutoff)
    out = past.select("customer_id").distinct()
    for days in (30, 60, 90, 180, 365):
        start = cutoff - F.expr(f"INTERVAL '{days}' DAY")
        part = past.filter(F.col("transaction_date") >= start).groupBy("customer_id")
        out = out.join(part.agg(F.count("transaction_id").alias(f"frequency_{days}d")), "customer_id", "left")
        spend = part.agg(F.sum("total_amount").alias(f"m{days}"), F.avg("total_amount").alias(f"a{days}"))
        out = out.join(spend, "customer_id", "left")
    return out.fillna(0)


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs_of = {name: (lambda name=name: QUERIES[name](spark, folder)) for name in HEADLINES}
    times = {}
    for name, run in runs_of.items():
        if name == "a_windows":
            continue
        timed(run)
        times[name] = round(median(timed(run) for _ in range(runs)), 3)
    pair = {"a_windows": runs_of["a_windows"], "literal": lambda: literal_windows(spark, folder)}
    found = {k: [] for k in pair}
    for turn in range(runs + 1):
        for k, run in pair.items():
            seconds = timed(run)
            if turn:
                found[k].append(seconds)
    times["a_windows"], literal = (round(median(found[k]), 3) for k in pair)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus), "a_windows_literal_form": literal,
            }
        )
    )


if __name__ == "__main__":
    main()
