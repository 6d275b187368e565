"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local cores. Each query is
planned and run to the end (no-op sink) twice after a warm-up of the session; the
better time counts.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from hushline.session import configure  # noqa: E402

HEADLINE = (
    "redact_calls", "output_rows", "audit_rows", "audit_summary", "redact_turns", "turns_with_context",
    "transcript_context", "detect_person", "detect_phone", "detect_gazetteer_names", "redact_documents",
    "parse_transcripts", "flatten_transcript", "merge_spans", "setting_quality", "setting_winners",
)


def run(df) -> float:
    start = time.perf_counter()
    df().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="bench-")
    spark = (
        configure(SparkSession.builder)
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.local.dir", work)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from hushline.plans.catalogue import queries
    from hushline.sources.calls import call_transcripts

    every = queries()
    call_transcripts(spark, sf_dir).count()
    times = {}
    for name in HEADLINE:
        once = run(lambda: every[name](spark, sf_dir))
        again = run(lambda: every[name](spark, sf_dir)) if once < 60 else once
        times[name] = round(min(once, again), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    calls = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    per_minute = round(calls / times["output_rows"] * 60)
    spark.stop()
    shutil.rmtree(work, ignore_errors=True)
    print(json.dumps({
        "metric": "total_seconds_of_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "calls": calls,
        "calls_per_minute": per_minute,
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
