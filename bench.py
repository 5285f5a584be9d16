"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from kindred.session import local_session  # noqa: E402
from suite import QUERIES  # noqa: E402

HEADLINE = (
    "denoise",
    "doc_embedding",
    "keyword_report",
    "rank_fusion",
    "knn_top20",
    "dup_decision",
    "silhouette",
    "standardize",
    "covariance",
    "batch_related",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    # Start the JVM compiler and the Python workers on other queries.
    for warm in ("light_clean", "k_choice", "nearest_centroid"):
        QUERIES[warm](spark, sf).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
