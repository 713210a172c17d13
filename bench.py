"""Times headline queries on warm runs and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from storkline.plans.queries import QUERIES  # noqa: E402
from storkline.session import build_session  # noqa: E402

HEADLINES = [
    "split_summary", "engineer_features", "describe_numeric", "target_stats", "missing_patterns",
    "corr_matrix", "yearly_trend", "kde", "box_stats_by_category", "expectations", "sample_n",
    "psi", "ks_drift", "cross_file_duplicates", "standardize", "baseline_mean", "ridge", "gbt",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        for _ in ("cold", "warm"):
            start = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "total_warm_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name,
    }))


if __name__ == "__main__":
    main()
