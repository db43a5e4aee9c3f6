"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line: ``{"metric", "value", "unit", "queries", "sf"}``;
``value`` is the sum of the per-query wall times.  Each query runs to
completion through the ``noop`` sink (full execution, nothing collected),
after one warm-up run of the flagship on the smallest data set so JVM start
and code generation are not charged to the first query.

Environment: ``BENCH_SF_DIR``, ``BENCH_CPUS``, ``BENCH_SHUFFLE_PARTITIONS``
(default twice the cores; AQE coalesces), ``BENCH_DRIVER_MEMORY``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablesift.plans import catalog  # noqa: E402
from tablesift.session import build_session, checkpoint_dir  # noqa: E402

HEADLINE = [
    "ind_unary",
    "ind_strict",
    "attribute_profile",
    "attribute_overlap",
    "ind_implied",
    "ind_nary",
    "lcs_best",
    "lcs_pairs",
    "group_top",
    "top_k",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        app_name="tablesift-bench",
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, 2 * cpus))),
        driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
    )
    checkpoint_dir(spark)
    qs = catalog.queries()
    smoke = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(smoke):
        run(qs["ind_unary"](spark, smoke))
    times = {}
    for name in names:
        t0 = time.perf_counter()
        run(qs[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total_wall",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
