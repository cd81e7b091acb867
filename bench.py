"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query is run
twice, planning and writing of intermediate tables included, and the second time counts:
the first also pays for starting the JVM's compiled code.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.queries import QUERIES
from tidemark.session import local_session, release

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "prep_events",
    "labels_all_splits",
    "order_labels",
    "kind_features_7",
    "count_features_7",
    "vts_stats_7",
    "two_level_stats_7",
    "features_long_set_1",
    "features_long_set_2",
    "features_long_baseline",
    "blend_predictions",
    "composite_score",
)

# all splits of the line items, and the 645 columns side by side: run once, and listed apart from the total
WIDE = ("order_features_set_1", "sample_wide")


def timed(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    taken = time.perf_counter() - start
    release(spark)
    return taken


def main() -> None:
    spark = local_session(CPUS, "tidemark-bench")
    seconds = {}
    for name in HEADLINE:
        timed(spark, name)
        seconds[name] = round(timed(spark, name), 3)
    wide = {name: round(timed(spark, name), 3) for name in WIDE}
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "wide": wide, "sf": SF_DIR.rsplit("sf", 1)[-1], "cpus": CPUS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
