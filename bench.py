"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.plans import registry  # noqa: E402
from tillroll.session import build_session  # noqa: E402

HEADLINES = (
    "visit_basic",
    "visit_ratios",
    "line_with_visit_totals",
    "encode_department",
    "vocab_fineline",
    "fineline_counts_long",
    "dept_counts_share",
    "dept_return_units",
    "dept_repeat_lines",
    "dept_pairs",
    "sparse_features",
    "visit_features_wide",
    "visit_folds",
    "knn_topk",
    "knn_vote",
    "class_distances",
    "stack_test",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    registry.load()
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry.QUERIES["visit_flags"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the JVM's engines
    took: dict[str, float] = {}
    for name in HEADLINES:
        start = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
