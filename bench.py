"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Each query runs to completion through the ``noop``
sink (every row computed, nothing shipped to the driver). ``stg_build`` is
the one-off write of the staging table that the models read; the models'
times exclude it, as in the original pipeline where staging is a table.
``stg_punctuality`` times the whole lazy plan from the raw tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "fct_delay_over_years",
    "int_scheduled_flights",
    "fct_airport_least_delays_by_year",
    "fct_country_delay_by_year",
    "fct_recent_avg_delay_airlines",
    "fct_recent_airport_delays",
    "dq_report",
    "stg_punctuality",
    "manifest_dedupe",
    "link_extract",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))

    from tarmac.plans.materialize import build_staging
    from tarmac.plans.registry import queries
    from tarmac.session import local_session

    spark = local_session(cpus)
    qs = queries()

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    # Warm the JVM (class loading, codegen caches) on the smallest input.
    run(qs["fct_delay_over_years"](spark, "/root/testdata/sf0.001"))

    times: dict[str, float] = {}
    t0 = time.perf_counter()
    build_staging(spark, sf_dir, force=True)
    times["stg_build"] = round(time.perf_counter() - t0, 3)
    for name in HEADLINE:
        t0 = time.perf_counter()
        run(qs[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
