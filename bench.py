"""Headline queries on the bench tables; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  Every query runs to completion into a
sink that keeps nothing; the best of two runs counts, so that code generation is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark import build_session  # noqa: E402
from tidemark.plans.queries import load_all  # noqa: E402

HEADLINE = (
    "flow_totals",
    "partial_merge_equals_direct",
    "daily_from_events",
    "table_profile",
    "duplicate_keys",
    "screen_spikes",
    "ratio_outliers",
    "top_partners_series",
    "overlapping_streams",
    "concentration_shares",
    "dedup_gap",
    "anomalies_diff",
    "season_totals",
    "national_series",
    "bootstrap_interval",
    "block_bootstrap_trend",
    "pct_of_own_mean",
    "exceedance_curve",
    "rolling_min7",
    "chain_index",
    "index_first_common_year",
    "latest_row",
    "paired_classes",
    "grouping_sets_report",
    "two_level_medians",
    "error_sum",
    "key_linkage_report",
    "allocate_classes",
    "inventory_merge",
    "page_links",
    "keyword_tags",
    "keyword_context",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_driver_memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry = load_all()
    names = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            registry[name].run(spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    print(
        json.dumps(
            {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": Path(sf).name}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
