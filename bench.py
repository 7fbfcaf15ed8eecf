"""Times the headline queries: `python bench.py`, settings BENCH_SF_DIR and BENCH_CPUS.

Prints one JSON line.  Every query is run whole into the no-op sink, twice; the better run counts.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from contract.queries import QUERIES
from veilpost.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "pii_mask", "pii_coverage", "semantic_mask", "parse_mail", "heuristic_verdict", "screen_mail",
    "audit_status", "token_spans", "quality_metrics", "alpha_sweep", "pr_curve", "knn_top2",
    "indicator_match", "fewshot_build", "kb_build", "resume_pending", "screen_with_context",
    "cached_verdict", "apply_overrides", "attach_scores", "benchmark_batch", "tfidf_retrieval", "screen_stream",
]


def run_once(spark, name: str) -> float:
    start = time.time()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.time() - start


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    mails = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    took = {}
    for name in sys.argv[1:] or HEADLINE:
        took[name] = round(min(run_once(spark, name) for _ in range(2)), 3)
        print(f"{name} {took[name]}", file=sys.stderr, flush=True)
    total = round(sum(took.values()), 3)
    result = {
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": took,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "mails": mails,
    }
    if "screen_mail" in took:
        result["mails_per_sec_screened"] = round(mails / took["screen_mail"], 1)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
