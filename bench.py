"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: table folder (default sf0.1); BENCH_CPUS: local cores.
"""

from __future__ import annotations

import json
import os
import time

from loghelm.plans.queries import QUERIES, polled_times
from loghelm.session import build_session
from loghelm.streaming.cadence import latency

HEADLINE = (
    "template_report",
    "parsed_fields",
    "sanitized_documents",
    "hashed_template_vectors",
    "labelled_lines",
    "preprocessing_summary",
    "context_windows",
    "line_score_thresholds",
    "detected_lines",
    "detector_quality",
    "rule_reports",
    "analysis_prompts",
    "replayed_threshold",
    "metrics_at_incident",
    "fitted_forest",
    "fitted_centers",
    "fitted_axes",
    "fitted_detections",
    "live_alerts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "loghelm-bench",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["template_report"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up the JVM
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    polls = latency(polled_times(spark, sf_dir)).drop("query").first().asDict()
    total = round(sum(times.values()), 3)
    lines = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "log_lines": lines,
                "live_polls": {key: round(value, 1) for key, value in polls.items()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
