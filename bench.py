"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kpiweave.session import local_session  # noqa: E402
from verification.registry import QUERIES  # noqa: E402

HEADLINE = [
    "m1_mart_daily_kpi",
    "m2_mart_funnel",
    "m3_mart_retention",
    "m4_mart_revenue",
    "q1_dau_new_returning",
    "q4_funnel_overall",
    "q6_classic_retention",
    "q7_retention_curve",
    "q8_monthly_arppu",
    "q10_user_tier_revenue",
    "q11_volume_zscore",
    "q12_high_value_txn",
    "q13_error_surge",
    "x1_export_daily_kpi",
    "x4_export_txn_summary",
    "k1_weekly_active_senders",
    "k2_signup_conversion_7d",
    "d18_unique",
    "d36_schema_compliance",
    "d40_quality_report",
]
#: the plans that a review found heaviest; timed beside the headline, not in its total
WORST = [
    "b4_time_to_convert",
    "k20_kpi_vs_target",
    "d31_export_validation",
    "w6_stream_alerts",
    "w7_incremental_daily_kpi",
    "s9_time_ordered_write",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = sys.argv[1:] or [*HEADLINE, *WORST]
    unknown = [key for key in chosen if key not in QUERIES]
    if unknown:
        raise SystemExit(f"not registered: {', '.join(unknown)}")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for key in chosen:
        taken = []
        try:
            # The first run compiles the generated code; the median of all runs counts.
            for _ in range(RUNS):
                start = time.perf_counter()
                QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
                taken.append(time.perf_counter() - start)
        except Exception as error:  # the others are timed and printed all the same
            failed[key] = f"{type(error).__name__}: {error}"[:200]
            continue
        times[key] = round(statistics.median(taken), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_seconds",
                "value": round(sum(t for k, t in times.items() if k not in WORST), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                **({"failed": failed} if failed else {}),
            }
        )
    )


if __name__ == "__main__":
    main()
