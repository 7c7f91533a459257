"""Runs the headline queries at ``$BENCH_SF_DIR`` and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from feedmill.plans import catalog, views
from feedmill.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
#: Queries that only exercise tiny inputs or repeat another one's plan are left out.
HEADLINE = (
    "validation_by_source",
    "validate_pages",
    "normalize_documents",
    "normalized_sample",
    "etl_clean",
    "etl_counters",
    "dq_text_reviews",
    "dq_pass_rates",
    "segments",
    "byte_truncate",
    "batches",
    "language_by_document",
    "sentiment_summary",
    "top_entities",
    "top_key_phrases",
    "nlp_results",
    "review_prompts",
    "model_batch",
    "ocr_text",
    "parse_notifications",
    "output_keys",
    "quality_scores",
    "feedback_reports",
    "metric_points",
    "metric_rollup",
    "dashboard_5min",
    "alarm_low_quality",
    "read_csv_roundtrip",
    "read_csv_salvage",
    "call_reports",
    "read_csv_order",
    "write_clean",
    "stream_validate",
    "stream_metrics",
    "stream_dedup",
)


def main() -> None:
    spark = local_session(CPUS, app="feedmill-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # The test tables are files of one row group each, i.e. one task.
    spark.conf.set(views.PARTITIONS, CPUS)
    # Start the JVM's compiler and the Python workers on what most queries share.
    for name in ("normalize_documents", "validation_by_source", "nlp_results"):
        catalog.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
