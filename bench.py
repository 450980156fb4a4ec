"""Bench: the reference's workload at $BENCH_SF_DIR on local[$BENCH_CPUS].

The reference builds its seven marts as tables and then answers metric
queries over them.  The bench times the same three phases:

1. ``stage_sources``: land the 18 CRM sources (derived from the test
   tables) as parquet tables;
2. ``build_<mart>``: build each mart from the staged sources and write it;
3. one entry per metric/report query over the published marts, executed
   through the ``noop`` sink (all rows and columns computed, nothing
   collected to the driver).

The whole sequence runs once untimed (code generation and JIT warm-up,
which a long-running cluster job pays once) and is then timed on a second,
complete run into fresh folders.  ``value`` is the sum of every phase.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

REPORTS = (
    "flagship",
    "pipeline_by_account_segment",
    "pipeline_by_account_owner",
    "pipeline_by_month",
    "pipeline_cumulative_by_month",
    "activity_scorecard",
    "activities_by_week",
    "pipeline_vs_activity_by_account",
    "star_opportunities",
    "star_activities",
    "dq_unique",
    "dq_relationships_pipeline",
    "dq_relationships_activities",
)


def run_once(spark, sf_dir: str) -> dict[str, float]:
    from dimstar.params import TEST_PARAMS
    from dimstar.plans.publish import run_folder, stage_sources, write_tables
    from dimstar.queries import MART_QUERIES, flagship_over, marts
    from dimstar.sources.fixture import fixture_sources

    times: dict[str, float] = {}
    t0 = time.perf_counter()
    src = stage_sources(spark, fixture_sources(spark, sf_dir), row_group_bytes=4 * 1024 * 1024)
    times["stage_sources"] = time.perf_counter() - t0

    folder = run_folder(spark, "marts")
    published = {}
    built = marts(src, TEST_PARAMS)
    for name in built:
        t0 = time.perf_counter()
        published.update(write_tables(spark, built, [name], folder))
        times[f"build_{name}"] = time.perf_counter() - t0

    for name in REPORTS:
        fn = flagship_over if name == "flagship" else MART_QUERIES[name]
        t0 = time.perf_counter()
        fn(published).write.format("noop").mode("overwrite").save()
        times[name] = time.perf_counter() - t0
    return {k: round(v, 3) for k, v in times.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from dimstar.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus))
    run_once(spark, sf_dir)
    times = run_once(spark, sf_dir)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "stage_build_and_report_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
