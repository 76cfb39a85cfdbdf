"""Time the headline queries; prints one JSON line.

Each query is run once and its whole result is written to Spark's no-op sink. One
small query runs before, untimed, so that the first figure is not that of the start
of the JVM.
"""

from __future__ import annotations

import json
import os
import time

from propfold.plans.queries import registered
from propfold.session import build_session

HEADLINE = [
    "pivot_events",
    "pivot_orders",
    "pivot_documents",
    "pivot_all_schemas",
    "validate_events",
    "validate_events_gated",
    "refused_properties",
    "discover_event_schemas",
    "discover_properties",
    "observed_properties",
    "normalize_texts",
    "clean_declared_values",
    "clean_cast_integer",
    "email_validity_texts",
    "promote_user_properties",
    "consolidate_user_property",
    "migrate_identified_users",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "propfold-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.log.level": "ERROR",
        },
    )
    queries, seconds = registered(), {}
    queries["normalize_names"](spark, folder).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(folder).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
