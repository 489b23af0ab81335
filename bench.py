"""Time the headline queries: `BENCH_SF_DIR` names the tables, `BENCH_CPUS` the local cores.

Each query runs once cold and twice warm into a sink that reads every row; the better warm time counts.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from loadcast.plans.catalog import QUERIES  # noqa: E402
from loadcast.session import build_session  # noqa: E402

HEADLINE = (
    "make_features", "weather_category", "numeric_features", "calendar_features", "merge_power_weather",
    "daily_peak", "land_if_absent", "unprocessed_dates", "watermark_advance", "date_parse", "numeric_coerce",
    "feature_versions", "latest_features", "latest_approved", "one_hot", "ordinal_encode", "train_matrix",
    "split_by_date", "split_by_ratio", "split_by_ratio_area", "regression_metrics_by_month",
    "correlation_pairs", "feature_histogram", "histogram_auto", "feature_kde", "parse_requests",
    "format_predictions", "power_csv_parse", "weather_csv_parse", "score_batch", "stream_daily_peak",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cores}]", spark__driver__memory="16g", spark__sql__shuffle__partitions=cores,
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        cold[name], warm[name] = round(times[0], 3), round(min(times[1:]), 3)
    print(json.dumps({
        "metric": "headline queries, warm", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "cores": int(cores), "sf": Path(sf_dir).name,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
