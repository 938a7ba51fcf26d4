"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

import pyspark

from stridecast.session import build_session
from workload import all_queries

HEADLINE = {
    "ingest": "ingest_date_bounds",
    "profile": "q2_non_null_counts",
    "daily_sort": "o1_sort_by_date_parts",
    "to_message": "f16_to_message",
    "parse_messages": "f3_flatten_message",
    "kpis": "g1_kpis",
    "threshold_grid": "g5_threshold_grid",
    "series_by_model": "g7_series_by_model",
    "histogram": "g8_histogram",
    "box_stats": "g9_box_stats",
    "box_points": "g10_box_points",
    "risk_zones": "g12_risk_zones",
    "metric_trends": "g13_metric_trends",
    "heatmap": "g14_heatmap",
    "train": "m2_linear_regression",
    "evaluate": "m8_holdout",
    "score_batch": "t1_score_batch",
    "score_stream": "k5_micro_batch_sink",
    "window_metrics": "t5_window_metrics",
    "window_stream": "t6_watermark",
    "promote": "t9_promote_rows",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("OFF")
    queries = all_queries()
    n_rows = queries["q1_row_count"](spark, sf_dir).first()["n_rows"]
    seconds = {}
    for label, name in HEADLINE.items():
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[label] = round(time.perf_counter() - started, 3)
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "mobility_rows": n_rows,
        "cores": int(cpus),
        "spark": pyspark.__version__,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
