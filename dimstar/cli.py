"""Command line: build the marts (like ``dbt build``) and ask metrics (like ``dbt sl query``).

    python -m dimstar.cli build --sources ROOT [--fixture] --out FOLDER [--as-of YYYY-MM-DD]
    python -m dimstar.cli query --marts FOLDER --metrics a,b --group-by x,y [--order-by=-a] [--where SQL]
    python -m dimstar.cli saved --marts FOLDER NAME [--definitions FILE.json]
    python -m dimstar.cli sql --marts FOLDER "SELECT ... FROM fct_blended_opportunities ..."
    python -m dimstar.cli list

``build`` lands the 18 sources as typed tables (one parquet folder each under
ROOT, or the test tables with ``--fixture``), writes the seven marts as a run
under FOLDER and publishes that run as a whole (the one before is kept), runs
every data test, appends the failing rows to ``FOLDER/dq_failure_log`` and
exits with status 1 when a test of severity ``error`` fails (``warn`` tests
only report).  ``query`` evaluates metrics over published marts, ``saved`` a
metric query kept under a name, and ``sql`` runs an ad-hoc statement over them
(marts as views under their own names); all print the result or write it with
``--output``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

from pyspark.sql import SparkSession


def _session(master: str | None) -> SparkSession:
    """Cluster session (settings sized by ``configure``), or a local one for ``--master local[N]``."""
    from dimstar.session import configure, local_session

    if master and master.startswith("local"):
        cores = master[len("local["):-1] if "[" in master else "1"
        return local_session(cores)
    builder = SparkSession.builder.appName("dimstar")
    if master:
        builder = builder.master(master)
    return configure(builder.getOrCreate())


def _params(args):
    from dimstar.params import TEST_PARAMS, Params

    base = TEST_PARAMS if args.fixture else Params()
    changes = {}
    if args.as_of:
        changes["as_of"] = dt.date.fromisoformat(args.as_of)
    if args.tenant:
        changes["tenant_pattern"] = args.tenant
    return base.with_(**changes)


def build(args) -> int:
    from dimstar.plans import quality as Q
    from dimstar.plans.publish import expire_runs, publish_run, stage_extracts
    from dimstar.queries import marts
    from dimstar.sources.fixture import fixture_sources

    spark = _session(args.master)
    src, unreadable = (fixture_sources(spark, args.sources), []) if args.fixture else stage_extracts(spark, args.sources)
    published = publish_run(spark, marts(src, _params(args), materialize=args.materialize), args.out)
    expire_runs(spark, args.out)
    for source, column, values in sorted(unreadable):
        print(f"UNREADABLE {source}.{column} values={values}")
    log = Q.failure_log(spark, Q.ALL_TESTS, published, os.path.join(args.out, "dq_failure_log"))
    summary = Q.summary_of_log(Q.ALL_TESTS, log).orderBy("test_name").collect()
    failed = 0
    for r in summary:
        state = "PASS" if r["failures"] == 0 else ("WARN" if r["severity"] == "warn" else "FAIL")
        failed += state == "FAIL"
        print(f"{state:4s} {r['test_name']} failures={r['failures']} records={r['failing_records']}")
    return 1 if failed else 0


def query(args) -> int:
    from dimstar.plans.metrics import dimensions_of, metric_query
    from dimstar.plans.publish import published
    from dimstar.queries import facts_of, star_dims

    spark = _session(args.master)
    m = published(spark, args.marts)
    metrics = [x for x in args.metrics.split(",") if x]
    facts = facts_of(m)
    if args.list_dimensions:
        print("\n".join(dimensions_of(metrics, star_dims(m))))
        return 0
    out = metric_query(facts, metrics, [g for g in (args.group_by or "").split(",") if g], dims=star_dims(m),
                       where=args.where or None,
                       order_by=[o for o in (args.order_by or "").split(",") if o])
    if args.output:
        out.write.mode("overwrite").parquet(args.output)
    else:
        out.show(args.show, truncate=False)
    return 0


def saved(args) -> int:
    """A saved query, the library's or one of a JSON file, over the published marts."""
    from dimstar.plans.publish import published
    from dimstar.plans.saved import SAVED_QUERIES, load_saved
    from dimstar.queries import facts_of, star_dims

    spark = _session(args.master)
    known = load_saved(spark, args.definitions) if args.definitions else SAVED_QUERIES
    if args.name not in known:
        print(f"no saved query {args.name}; known: {', '.join(sorted(known))}", file=sys.stderr)
        return 2
    m = published(spark, args.marts)
    out = known[args.name].run(facts_of(m), star_dims(m))
    if args.output:
        out.write.mode("overwrite").parquet(args.output)
    else:
        out.show(args.show, truncate=False)
    return 0


def sql(args) -> int:
    """Ad-hoc SQL over the published marts, registered as views under their own names."""
    from dimstar.plans.publish import published, register_views

    spark = _session(args.master)
    register_views(published(spark, args.marts))
    out = spark.sql(args.query)
    if args.output:
        out.write.mode("overwrite").parquet(args.output)
    else:
        out.show(args.show, truncate=False)
    return 0


def list_metrics(args) -> int:
    """Metrics with their model, kind and definition; the group-by roles of each model."""
    from dimstar.plans.metrics import METRICS, MODELS
    from dimstar.plans.saved import SAVED_QUERIES

    for m in METRICS.values():
        what = m.measure or (f"{m.numerator} / {m.denominator}" if m.kind == "ratio" else ", ".join(m.inputs))
        print(f"{m.name:36s} {m.model:32s} {m.kind:10s} {what}\n    {m.label}: {m.description}")
    for model in MODELS.values():
        roles = ", ".join(f"{e.role}{'' if e.active else ' (inactive)'}" for e in model.edges)
        print(f"{model.name}: metric_time__<day|week|month|quarter|year> over {model.time_dimension}; roles: {roles}")
    for q in SAVED_QUERIES.values():
        print(f"saved query {q.name}: {q.description}")
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="dimstar")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--sources", required=True)
    b.add_argument("--fixture", action="store_true", help="derive the sources from the test tables")
    b.add_argument("--out", required=True)
    b.add_argument("--as-of")
    b.add_argument("--tenant", help="word of the tenant's own mail domain; marks internal activities (not with --fixture: required)")
    b.add_argument("--materialize", action="store_true",
                   help="write F1's opportunity side as a table before the lines are joined (a lineage cut)")
    q = sub.add_parser("query")
    q.add_argument("--marts", required=True)
    q.add_argument("--metrics", required=True)
    q.add_argument("--group-by")
    q.add_argument("--order-by")
    q.add_argument("--where")
    q.add_argument("--list-dimensions", action="store_true", help="print the names these metrics can be grouped by")
    q.add_argument("--output", help="write the whole result here as parquet")
    q.add_argument("--show", type=int, default=50, help="rows to print without --output (default 50)")
    sub.add_parser("list")
    v = sub.add_parser("saved")
    v.add_argument("--marts", required=True)
    v.add_argument("name")
    v.add_argument("--definitions", help="JSON file with saved queries of your own")
    v.add_argument("--output", help="write the whole result here as parquet")
    v.add_argument("--show", type=int, default=50, help="rows to print without --output (default 50)")
    a = sub.add_parser("sql")
    a.add_argument("--marts", required=True)
    a.add_argument("query")
    a.add_argument("--output", help="write the whole result here as parquet")
    a.add_argument("--show", type=int, default=50, help="rows to print without --output (default 50)")
    for sp in (b, q, v, a):
        sp.add_argument("--master", help="e.g. local[8]; default: the cluster's")
    args = p.parse_args(argv)
    if args.cmd == "build" and not (args.fixture or args.tenant):
        p.error("build needs --tenant: without it, internal mail would count as customer activity")
    return {"build": build, "query": query, "saved": saved, "sql": sql, "list": list_metrics}[args.cmd](args)


if __name__ == "__main__":
    sys.exit(main())
