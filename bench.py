"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Each query runs once to warm up, then three times; the median counts. A run covers
everything from building the query, staged tables included, to writing all result rows
to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from curvemill.session import local_session
from curvemill.standin import catalog

HEADLINES = [
    "scenario_loss", "loss_with_quantile", "loss_by_class", "net_exposure",
    "hedged_net_exposure", "hedged_class_losses", "first_order_loss", "gamma_up_down",
    "second_order_loss", "total_loss", "latest_snapshot", "newest_dimension_row",
    "newest_rate_per_date", "unpivot_curve", "forward_fill", "calendar_columns",
]


def run(name: str, spark, folder: str) -> float:
    started = time.perf_counter()
    catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(name, spark, folder)
        seconds[name] = round(statistics.median(run(name, spark, folder) for _ in range(3)), 3)
    spark.stop()
    print(json.dumps({"metric": "headline queries, median of 3 warm runs, total",
                      "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))[2:]}))


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINES)
