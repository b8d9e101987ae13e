"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores,
BENCH_RUNS the timed runs per query (the median counts, after one warm-up).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from playtide.plans.queries import registry  # noqa: E402
from playtide.session import local_session  # noqa: E402

HEADLINE = (
    "stream_ingest",
    "clean_events",
    "song_rankings",
    "velocity",
    "user_features_v2",
    "user_features_monitor",
    "interaction_matrix_orders",
    "training_set_orders",
    "session_sequences",
    "anomaly_scores",
    "ks_drift",
    "decode_ids",
    "hit_rate_at_k",
    "als_rmse",
    "als_lookup",
    "churn_evaluation",
    "stream_velocity",
    "stream_session_sequences",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "bench", partitions=int(cores))
    timings = {}
    for name in wanted:
        query, seconds = registry()[name], []
        for run in range(runs + 1):
            start = time.perf_counter()
            query(spark, folder).write.format("noop").mode("overwrite").save()
            if run:
                seconds.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(seconds), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm median, summed",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(os.path.normpath(folder)),
                "cores": int(cores),
            }
        )
    )


if __name__ == "__main__":
    main()
