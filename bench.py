"""Time the headline queries in full, three times each, and print one JSON line with the medians.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the number of local cores. Every query computes
all of its rows and hands them to a sink that discards them. ``ingest`` is the derivation of the ratings
table, and ``fit`` that of the statistics and normalized ratings, which the other queries read; both are done once. ``user_norm``, ``preprocessed_ratings`` and ``item_raters`` include their share of
that work again. Names as arguments restrict the run to those queries.
"""

from __future__ import annotations

import json
import os
import sys
from statistics import median
from time import perf_counter

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kindred.plans.registry import QUERIES, model  # noqa: E402
from kindred.session import local_session  # noqa: E402
from kindred.sources.testdata import load  # noqa: E402

HEADLINE = [
    "ratings_scan",
    "user_norm",
    "preprocessed_ratings",
    "item_raters",
    "cosine_similarity",
    "jaccard_similarity",
    "overlap_stats",
    "predict_cosine",
    "mae_cosine",
    "mae_comparison",
    "similarity_report",
    "knn_k30",
    "predict_knn_k30",
    "knn_mae_sweep",
    "knn_report",
    "recommend_report",
]


RUNS = 3


def timed(action) -> float:
    start = perf_counter()
    action()
    return round(perf_counter() - start, 3)


def warm_up(spark, small_dir: str) -> None:
    """Load and compile the JVM's classes on the smallest tables, so that the first query does not pay for it."""
    if os.path.isdir(small_dir):
        for name in ("similarity_report", "knn_report", "recommend_report"):
            QUERIES[name](spark, small_dir).collect()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cpus, memory=os.environ.get("BENCH_MEMORY", "16g"))
    warm_up(spark, os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    tables = load(spark, sf_dir)
    seconds = {"ingest": timed(lambda: tables.split_ratings), "fit": timed(model(tables).fit)}
    for name in sys.argv[1:] or HEADLINE:
        run = lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # noqa: B023, E731
        seconds[name] = median(timed(run) for _ in range(RUNS))
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
