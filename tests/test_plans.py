"""Plan properties: no cartesian products, no Python evaluation, pushed filters, top-1 before shuffle."""

import pytest

from conftest import SF_SMALL
from dimstar.queries import REGISTRY


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Queries that write tables are run for it: their last plan reads what was written.
@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_cartesian_no_python(spark, name):
    p = plan_of(REGISTRY[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_dims_use_anti_join(spark):
    for name in ("dim_unified_account", "dim_unified_contact", "dim_unified_employee", "dim_unified_opportunity"):
        assert "LeftAnti" in plan_of(REGISTRY[name](spark, SF_SMALL)), name


def test_latest_quote_limits_before_shuffle(spark):
    p = plan_of(REGISTRY["latest_quote"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_filters_and_columns_reach_the_scan(spark):
    df = REGISTRY["opportunities_in_window"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in p and "GreaterThanOrEqual(o_orderdate,1997-02-01T00:00)" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_metric_reduces_fact_before_dimension_join(spark):
    from dimstar.plans.metrics import metric_query
    from dimstar.queries import _marts, star_dims

    m = _marts(spark, SF_SMALL)
    q = metric_query(m["fct_blended_opportunities"], ["total_pipeline_acv_usd"], ["account__account_segment"],
                     dims=star_dims(m))
    plan = q._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    join_at = next(i for i, line in enumerate(lines) if "Join LeftOuter" in line and "__account__key" in line)
    below = "\n".join(lines[join_at:])
    # The fact side of the dimension join is already an aggregate on the foreign key.
    assert "Aggregate [account_csn" in below


def test_tasks_shuffled_once_per_key(spark):
    from dimstar.params import TEST_PARAMS
    from dimstar.plans import activities as A
    from dimstar.queries import _ctx

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src, _ = _ctx(spark, SF_SMALL)
        p = plan_of(A.edh_activities(src, TEST_PARAMS))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # The task stream: one exchange by opportunity, one by contact; lookups are joined at their own grain.
    assert p.count("Exchange hashpartitioning(opportunity_number#") == 1
    assert p.count("Exchange hashpartitioning(end_customer_contact_csn#") == 1


def test_line_lookups_come_after_the_opportunity_join(spark):
    """No exchange on offering or currency below the join of lines to opportunities."""
    from dimstar.params import TEST_PARAMS
    from dimstar.plans import opportunity_lines as P
    from dimstar.queries import _ctx

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src, _ = _ctx(spark, SF_SMALL)
        for fn, key in ((P.edh_opportunity_lines, "offering_id"), (P.acs_opportunity_lines, "currency_iso_code")):
            lines = plan_of(fn(src, TEST_PARAMS)).splitlines()
            depth = {i: len(x) - len(x.lstrip(" :|+-*()0123456789")) for i, x in enumerate(lines)}
            at = [i for i, x in enumerate(lines) if f"Exchange hashpartitioning({key}#" in x]
            assert at, key
            for i in at:
                # Below the exchange comes the join that has matched the lines already.
                below = []
                for j in range(i + 1, len(lines)):
                    if depth[j] <= depth[i]:
                        break
                    below.append(lines[j])
                assert any("Join" in x and "Inner" in x for x in below), key
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_exchange_carries_the_task_text(spark):
    from dimstar.params import TEST_PARAMS
    from dimstar.plans import activities as A
    from dimstar.queries import _ctx

    def nodes(plan):
        yield plan
        for i in range(plan.children().size()):
            yield from nodes(plan.children().apply(i))

    src, _ = _ctx(spark, SF_SMALL)
    joins = [n for n in nodes(A.edh_activities(src, TEST_PARAMS)._jdf.queryExecution().optimizedPlan())
             if n.nodeName() == "Join"]
    assert joins
    for join in joins:
        assert "task_description" not in [join.output().apply(i).name() for i in range(join.output().size())]


def test_row_tests_share_a_scan(spark):
    from dimstar.plans import quality as Q
    from dimstar.queries import _marts

    m = {k: spark.createDataFrame([], v.schema) for k, v in _marts(spark, SF_SMALL).items()}
    tests = Q.NOT_NULL_TESTS + Q.ACCEPTED_TESTS
    plan = Q.summary(tests, m)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") <= 2 * len({t.model for t in tests}) * 2


def _scans(df, column):
    """Relations in the plan that read the column."""
    return sum(1 for line in plan_of(df).splitlines() if ("Scan" in line or "FileScan" in line) and f"{column}#" in line)


@pytest.fixture(scope="module")
def staged(spark):
    from dimstar.plans.publish import stage_sources
    from dimstar.queries import _ctx

    return stage_sources(spark, _ctx(spark, SF_SMALL)[0])


def test_lines_and_quotes_are_scanned_once(spark, staged):
    from dimstar.params import TEST_PARAMS
    from dimstar.plans import opportunity_lines as P

    edh, acs = P.edh_opportunity_lines(staged, TEST_PARAMS), P.acs_opportunity_lines(staged, TEST_PARAMS)
    assert _scans(edh, "line_item_number") == 1 and _scans(edh, "quote_number") == 1 and _scans(edh, "offering_id") == 2
    assert _scans(acs, "est_annualized_amount_c") == 1 and plan_of(edh).count("Window [") == 1


def test_foreign_keys_are_counted_before_they_are_shuffled(spark, staged):
    from dimstar.params import TEST_PARAMS
    from dimstar.plans import quality as Q
    from dimstar.plans.publish import write_tables
    from dimstar.queries import marts

    m = write_tables(spark, marts(staged, TEST_PARAMS))
    plan = plan_of(Q._orphans(list(Q.ACTIVITY_REL_TESTS), m))
    fact = [line for line in plan.splitlines() if "FileScan" in line and "ownerid#" in line]
    assert len(fact) == 1  # five foreign keys, one pass
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "ownerid#" in line and "FileScan" in line)
    above = [line for line in lines[:at] if "Exchange" in line or "partial_count" in line]
    assert "partial_count" in above[-1]  # the first step over the fact is the partial count
    # All tests: a mart is read for its row tests, its foreign keys and its unique key, and as a parent.
    every = plan_of(Q.all_failing_rows(Q.ALL_TESTS, m))
    assert sum("FileScan" in x and "activity_id#" in x for x in every.splitlines()) == 1
    row_tests = plan_of(Q.all_failing_rows(Q.NOT_NULL_TESTS + Q.ACCEPTED_TESTS, m))
    assert sum("FileScan" in x for x in row_tests.splitlines()) == len({t.model for t in Q.NOT_NULL_TESTS + Q.ACCEPTED_TESTS})
