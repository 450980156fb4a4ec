"""Write condensed physical plans of the headline jobs to PLANS.md.

The sources are landed as tables first, and broadcast joins are disabled,
so the plans show what a cluster runs over large source tables: every exchange, join, aggregate and window-limit, and what
reaches each parquet scan.  Usage: python tools/plans.py [sf_dir] [out.md]
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

KEEP = re.compile(r"(Exchange|Join|Aggregate|WindowGroupLimit|Window |Union|Scan parquet|Expand|Sort \[|"
                  r"CartesianProduct|NestedLoop|EvalPython|TakeOrdered)")

JOBS = {
    "F1 EDH lines (opportunity side with the quote, line fan-out, offering)": ("opportunity_lines", "edh_opportunity_lines"),
    "F1 ACS lines (screening, anti join to EDH, line fan-out, FX)": ("opportunity_lines", "acs_opportunity_lines"),
    "F2 activities (two task shuffles per branch)": ("activities", "fct_blended_opportunity_activities"),
    "D2 accounts (conform-union)": ("dims", "dim_unified_account"),
    "W1 latest quote (top-1 before and after the shuffle)": ("opportunity_lines", "latest_quote"),
}


def condensed(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\], ", "", line)
        line = re.sub(r"DataFilters: \[[^\]]*\], ", "", line)
        line = re.sub(r"FileScan parquet \[[^\]]*\]", "FileScan parquet", line)
        line = re.sub(r", Format: Parquet|, PartitionFilters: \[\]|Batched: true, ", "", line)
        out.append(line.rstrip()[:400])
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    target = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    import importlib

    from dimstar.params import TEST_PARAMS
    from dimstar.plans.metrics import metric_query
    from dimstar.plans.publish import stage_sources
    from dimstar.queries import _ctx, marts, star_dims
    from dimstar.session import local_session

    spark = local_session(8, 16)
    # Land the sources as tables first: production plans start from source tables,
    # not from the test-data mapping.
    fixture, p = _ctx(spark, sf_dir)
    src = stage_sources(spark, fixture)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    parts = ["# Physical plans (broadcast disabled, as for cluster-sized tables)\n",
             f"Generated by `tools/plans.py` from {sf_dir}; operator lines only.\n"]
    for title, (module, fn) in JOBS.items():
        mod = importlib.import_module(f"dimstar.plans.{module}")
        f = getattr(mod, fn)
        df = f(src) if fn in ("latest_quote", "dim_unified_account") else f(src, p)
        parts.append(f"## {title}\n\n```\n{condensed(df._jdf.queryExecution().executedPlan().toString())}\n```\n")
    m = marts(src, TEST_PARAMS)
    q = metric_query(m["fct_blended_opportunities"], ["total_pipeline_acv_usd"],
                     ["account__account_segment"], dims=star_dims(m))
    plan = condensed(q._jdf.queryExecution().executedPlan().toString())
    parts.append("## Metric by a dimension attribute (fact reduced to FK grain before the join)\n\n"
                 f"```\n{plan}\n```\n")
    with open(target, "w") as fh:
        fh.write("\n".join(parts))


if __name__ == "__main__":
    main()
