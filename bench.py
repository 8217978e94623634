"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starloom.plans import registry  # noqa: E402
from starloom.session import local_session  # noqa: E402

HEADLINE = [
    "c1_item_stats",
    "c3_quality_summary",
    "e1_item_neighbours",
    "e1_user_neighbours",
    "e2_item_knn_recommendations",
    "e4_temporal_split",
    "f5_item_knn_predictions",
    "f7_all_items_predictions",
    "f14_bias_baseline",
    "g10_content_cosine",
    "g12_similar_items",
    "g15_profile_recommendations",
    "h4_grid_errors",
    "h8_d7_hybrid_lists",
    "i7_blocked_requests",
    "j4_ranking_summary",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or [n for n in HEADLINE if n in registry.QUERIES]
    # start the Python workers and code generation before the clock runs
    registry.QUERIES["e2_item_knn_recommendations"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.time()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "headline query time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
