"""Time the headline queries; prints one line of JSON."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from trenchbook.plans import queries as q  # noqa: E402
from trenchbook.plans.session import session  # noqa: E402

HEADLINE = [
    "rollup_context", "rollup_context_asu", "pottery_parents", "phases_context_asu",
    "finds_context_asu", "geo_contexts", "check_unique", "classify_parents", "master_context",
    "counts_context_asu", "layer_phase_pottery", "pottery_violations", "polygon_features",
    "publish_table",
]


def seconds(frame) -> float:
    """Time to compute every row and column of a frame."""
    start = time.perf_counter()
    frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    repeats = int(os.environ.get("BENCH_REPEATS", "5"))
    spark = session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    site = q.site(spark, sf_dir)

    # The shared tables, built once from the raw tables; cold, since a run builds them once.
    # Each table's own time: those it is made from come first.
    times = {}
    for name in ("bag", "context", "flotation", "sample", "find", "context_again"):
        start = time.perf_counter()
        site.raw(name)
        times[f"stage_{name}"] = round(time.perf_counter() - start, 3)
    for name in ("master", "index", "samples", "finds", "pottery", "geo", "again", "again_keys", "bag_keys",
                 "phased_asu", "phased", "rolled_asu", "rolled"):
        start = time.perf_counter()
        getattr(site, name)()
        times[f"stage_{name}"] = round(time.perf_counter() - start, 3)
    shared = round(sum(times.values()), 3)

    for name in HEADLINE:
        run = [seconds(q.QUERIES[name](site)) for _ in range(repeats + 1)][1:]
        times[name] = round(statistics.median(run), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "shared_tables_cold": shared,
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
