"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. ``value`` is the end-to-end job (clean, write,
enrich, write, all report tables) on the venue table derived from
``customer``; ``queries`` holds per-query wall times (each forced to run
completely with the ``noop`` sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from recordforge.plans.batch import run_job  # noqa: E402
from recordforge.plans.catalog import QUERIES, loaded  # noqa: E402
from recordforge.session import build_session, scratch_path  # noqa: E402

HEADLINE = [
    "dedup_exact",
    "fuzzy_pairs",
    "fuzzy_pairs_name",
    "fuzzy_clusters",
    "clean_pipeline",
    "enrich_pipeline",
    "score_weighted",
    "report_labels",
]


def force(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": str(max(8, 2 * int(cpus)))},
    )
    # warm-up on the smallest tables: JVM JIT, Python workers, generated code
    # (compiled classes are cached by source text, as on a long-lived cluster)
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir):
        for name in HEADLINE:
            force(QUERIES[name](spark, warm_dir))
    force(QUERIES["norm_nulls"](spark, sf_dir))
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        force(QUERIES[name](spark, sf_dir))
        times[name] = round(time.time() - t0, 3)
    raw = loaded(spark, sf_dir)
    rows = raw.count()
    t0 = time.time()
    reports = run_job(spark, raw, scratch_path(spark, "bench-job"))
    for df in reports.values():
        df.collect()
    job = round(time.time() - t0, 3)
    times["pipeline_job"] = job
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "pipeline_job_sec",
                "value": job,
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "rows_in": rows,
                "rows_per_sec": round(rows / job, 1) if job else None,
                "baseline_rows_per_sec": round(1072 / 1.84, 1),
            }
        )
    )


if __name__ == "__main__":
    main()
