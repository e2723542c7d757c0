"""Headline queries on one machine; prints one JSON line.

Each query runs once unmeasured and once measured, so that the figure is the
work of the query and not the start of the JVM.
"""

from __future__ import annotations

import json
import os
import time

from ledgerflow.checks import job_queries, operator_queries  # noqa: F401 - registers the queries
from ledgerflow.checks.registry import QUERIES
from ledgerflow.config import session

HEADLINE = (
    "submission_outcome",
    "validate_date",
    "propagate_error",
    "effective_join",
    "mine_cost",
    "enrich_by_type",
    "assign_ids",
    "apply_updates",
    "first_per",
    "stamp_worklist",
    "escalate",
    "paid",
    "direct_actions",
    "seed_disputes",
    "nonseed_disputes",
    "dispute_job",
    "prov_job",
    "map_job",
)


# Whole folder runs; timed once, beside the total, which has the queries of earlier rounds only.
FOLDER = ("review_folder_snapshot",)


def timed(spark, sf: str, name: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - begin, 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split()
    seconds = {}
    for _ in ("warm-up", "measured"):
        for name in names:
            seconds[name] = timed(spark, sf, name)
    print(
        json.dumps(
            {
                "metric": "total query time, second run",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "folder_runs": {name: timed(spark, sf, name) for name in FOLDER} if "BENCH_QUERIES" not in os.environ else {},
                "sf": os.path.basename(sf.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
