"""Time the headline queries; prints one JSON line. Reads BENCH_SF_DIR and BENCH_CPUS."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from marketgrain.queries import catalog  # noqa: E402
from marketgrain.session import local_session  # noqa: E402

HEADLINE = (
    "a1_daily_aggregate", "a3b_total_revenue", "a4_monthly_revenue", "a5_seasonal_revenue", "a6_top_categories",
    "a7_price_distribution", "a8_top_items", "a9_weekend_vs_weekday", "a10_category_prices_since", "a14_summary",
    "s25_daily_report", "a15_describe", "a25_loss_impact", "j1_daily_left_wholesale", "j3_category_totals_on_rows",
    "w1_lags", "w2_rolling", "w3_targets", "w8_row_split", "f1_all_features", "f2_feature_table", "v6_outliers",
    "v8_quality_score", "d2_statistical_drift", "d3_ks", "d4_psi", "t1_decompose", "t3_acf", "m7_metrics", "h1_alerts",
    "h9_latency_histogram", "w13_ema", "r1_metric_windows", "r7_streaming_daily", "r8_sessions", "m3_linear_model",
)


def run(spark, name: str, folder: str) -> float:
    """Seconds to compute every row and column; nothing is collected."""
    start = time.perf_counter()
    catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    run(spark, "a3a_total_records", folder)
    # the better of two runs: the first one also compiles the plan's code
    seconds = {name: round(min(run(spark, name, folder) for _ in range(2)), 3) for name in HEADLINE}
    scale = folder.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
