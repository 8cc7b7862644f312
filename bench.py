"""Time the headline queries. Prints one JSON line; takes BENCH_SF_DIR and BENCH_CPUS."""

from __future__ import annotations

import json
import os
import time

from proofmark.plans import catalog
from proofmark.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))

HEADLINE = [
    "gate_verdict", "traffic_health", "daily_rollup", "rate_limit", "turn_pairs", "session_summary",
    "latest_assessment", "judge_human_pairs", "cohens_kappa", "scorer_metrics", "merge_records",
    "dataset_as_of", "synth_evals", "question_diversity", "chunk_documents", "score_correctness",
    "score_relevance", "score_groundedness", "score_guidelines", "score_safety", "score_tool_efficiency",
    "score_knowledge_retention", "apply_guardrails", "monitor_batch", "vector_topk", "vector_topk_lsh",
    "predict_local", "stream_health_tumbling",
]


def run_all(df) -> None:
    """Compute every row and column, keep none."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, "bench")
    run_all(spark.read.parquet(f"{SF_DIR}/events.parquet"))
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(REPEATS):
            started = time.perf_counter()
            run_all(catalog.QUERIES[name](spark, SF_DIR))
            took = time.perf_counter() - started
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total of best times", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "cpus": int(CPUS), "repeats": REPEATS,
    }))


if __name__ == "__main__":
    main()
