"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one
JSON line. Pairs ending in ``_naive`` are the plain one-window form of the query
before them, for comparison; they are not part of ``value``."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from millrace.plans import QUERIES  # noqa: E402
from millrace.plans.evaluation import coded_events  # noqa: E402
from millrace.runtime import build_session  # noqa: E402

HEADLINE = (
    "m1_naive_bayes", "m1_accuracy", "a1_accuracy", "a2_warmup_accuracy", "a3_ewma",
    "a5_mae_outputs", "a5_mae_progress", "a7_confusion", "a7_running_confusion", "c1_snapshot_asof",
    "c4_flag_chain", "g2_rolling_maxby", "j1_gather", "k4_progress", "m2_majority",
    "m10_keyed_majority", "m4_linear_scan", "m10_keyed_linear", "m6_hoeffding", "m9_hoeffding_nominal",
    "m12_mlp", "p5_onehot", "p7_norms", "p12_expand", "w1_sliding_members", "w2_flatten",
    "w5_count_window", "w7_watermark_stream", "w8_late_audit",
)


def naive_majority(spark, sf, keys=()):
    """The same counts in one window over everything (or over a key)."""
    w = Window.partitionBy(*keys).orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
    counts = {f"c{c}": F.sum((F.col("code") == c).cast("int")).over(w) for c in range(5)}
    return coded_events(spark, sf).withColumns(counts)


def run(fn, spark, sf) -> float:
    start = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        cpus,
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["g1_keyed_count"], spark, sf)  # start-up is not a query
    times = {}
    for name in HEADLINE:
        times[name] = run(QUERIES[name], spark, sf)
    total = round(sum(times.values()), 3)
    times["m2_majority_naive"] = run(naive_majority, spark, sf)
    times["m10_keyed_majority_naive"] = run(
        lambda s, d: naive_majority(s, d, ["user_id"]), spark, sf
    )
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
