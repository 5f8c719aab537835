"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and
cores. Every query is run once to warm the JVM on the small data set, then timed with
its full result written to Spark's no-op sink. ``--all`` times every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cohortloom.plans.queries import QUERIES  # noqa: E402
from cohortloom.session import build_session  # noqa: E402

HEADLINE = [
    "disease_patients", "control_cohort", "screening_cohort", "clean_diags", "clean_labs",
    "outlier_bounds", "numeric_window", "feature_matrix", "rule_labels", "performance",
    "attrition", "prevalence_lift", "lab_stats_per_test", "mann_whitney", "significance_select",
]


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = list(QUERIES) if "--all" in sys.argv[1:] else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    small = Path(folder).parent / "sf0.001"
    if small.exists():
        for name in ("rule_labels", "performance"):
            timed(spark, name, str(small))
    seconds = {name: timed(spark, name, folder) for name in names}
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
