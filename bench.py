"""Time the headline queries; one JSON line on stdout."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from applytrail.session import local_session  # noqa: E402
from checks.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "mail_milestones", "unify_applications", "application_funnel", "funnel_counts", "job_funnel_outcome3",
    "stage_flows", "outcome_flows", "stage_timeline_day", "latest_status", "attach_latest_status",
    "mail_table", "saved_jobs", "normalise_dump", "feature_matrix", "skill_frequency", "company_role_clean",
    "html_to_text", "ascii_fold", "match_candidates", "match_score", "store_upsert_read",
)
# the fuzzy search over whole tables takes minutes at the larger scale; asked for by name
HEAVY = ("best_match", "match_store", "resolve")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    spark = local_session("bench", cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    # start the JVM's code paths and the Python workers before the clock runs
    for warm in ("job_groups", "similarity"):
        QUERIES[warm](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cores, "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
