"""Operators: conform-union, skew-safe left join, latest per key, data quality, metrics."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows_of
from dimstar.operators import conform_union, latest_per_key, one_to_many_left_join
from dimstar.plans import quality as Q
from dimstar.plans.metrics import metric_query


def test_conform_union_uses_whole_authority(spark):
    authority = spark.createDataFrame([("A", 1), ("B", 0), (None, 1)], "k string, active int")
    primary = authority.where("active = 1 AND k IS NOT NULL").select("k", F.lit("P").alias("src"))
    secondary = spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "k string").select("k", F.lit("S").alias("src"))
    out = conform_union(primary, secondary, "k", authority, "k")
    # B is filtered out of the primary but still blocks the secondary (trap 1); NULL key survives.
    assert rows_of(out, "k", "src") == sorted([("A", "P"), ("C", "S"), (None, "S")], key=repr)


def test_one_to_many_left_join_equals_left_join(spark):
    parents = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4), ("a", 5)], "pk string, pv int")
    children = spark.createDataFrame([("a", 10), ("a", 11), ("b", 20), (None, 30), ("z", 40)] + [("a", 100 + i)
                                     for i in range(50)], "ck string, cv int")
    got = one_to_many_left_join(parents, children, "pk", "ck")
    want = parents.join(children, F.col("pk") == F.col("ck"), "left")
    assert rows_of(got, "pk", "pv", "ck", "cv") == rows_of(want, "pk", "pv", "ck", "cv")


def test_one_to_many_left_join_lookup(spark):
    parents = spark.createDataFrame([("a", 1), ("b", 2)], "pk string, pv int")
    children = spark.createDataFrame([("a", 10)], "ck string, cv int")
    extra = spark.createDataFrame([(10, "x"), (11, "y")], "ek int, ev string")
    got = one_to_many_left_join(parents, children, "pk", "ck",
                                lookup=lambda d: d.join(extra, F.col("cv") == F.col("ek"), "left"))
    assert rows_of(got, "pk", "cv", "ev") == [("a", 10, "x"), ("b", None, None)]


def test_latest_per_key_quotes(spark):
    d = dt.date
    q = spark.createDataFrame([
        ("O1", "Q1", d(2024, 1, 1)), ("O1", "Q2", d(2024, 1, 1)), ("O1", "Q0", None),   # tie on date -> Q2
        ("O2", "Q5", None), ("O2", "Q7", None),                                       # all undated -> Q7
        ("O3", "Q9", None), ("O3", "Q1", d(2020, 5, 5)),                               # dated beats undated
    ], "o string, qn string, qd date")
    out = latest_per_key(q, ["o"], [F.col("qd").isNull().asc(), F.col("qd").desc_nulls_last(),
                                    F.col("qn").desc_nulls_last()])
    assert rows_of(out, "o", "qn") == [("O1", "Q2"), ("O2", "Q7"), ("O3", "Q1")]


def test_country_rule_three_valued(spark):
    rows = [(m, c) for m in (True, False) for c in (0, 1, None)]
    df = spark.createDataFrame(rows, "matched boolean, is_closed int")
    kept = df.where(~(F.col("matched") & (F.col("is_closed") == 0)))
    # matched & open -> drop; matched & NULL closed -> drop (trap 5); unmatched -> keep.
    assert rows_of(kept, "matched", "is_closed") == sorted([(True, 1), (False, 0), (False, 1), (False, None)], key=repr)


def test_data_quality_planted_failures(spark):
    dim = spark.createDataFrame([("k1", "EDH"), ("k1", "EDH"), (None, "ACS"), ("k3", "XYZ")], "key string, source_system string")
    fact = spark.createDataFrame([("f1", "k1"), ("f2", "k9"), ("f3", None)], "id string, fk string")
    marts = {"d": dim, "f": fact}
    tests = [Q.DataTest("u", "unique", "d", "key"), Q.DataTest("n", "not_null", "d", "key"),
             Q.DataTest("a", "accepted_values", "d", "source_system", values=("EDH", "ACS")),
             Q.DataTest("r", "relationships", "f", "fk", "warn", (), "d", "key")]
    got = {r["test_name"]: (r["failures"], r["failing_records"]) for r in Q.summary(tests, marts).collect()}
    assert got == {"u": (1, 2), "n": (1, 1), "a": (1, 1), "r": (1, 1)}
    clean = {"d": spark.createDataFrame([("k1", "EDH")], "key string, source_system string"),
             "f": spark.createDataFrame([("f1", "k1")], "id string, fk string")}
    assert all(r["failures"] == 0 for r in Q.summary(tests, clean).collect())


def test_metric_ratio_zero_and_null_denominator(spark):
    f2 = spark.createDataFrame([
        ("a1", "S1", 1, 1, 30), ("a2", "S1", 1, 0, 10),
        ("a3", "S2", 0, 0, 20),                 # zero attempts -> NULL ratio
    ], "activity_id string, source_system string, call_attempt_outbound int, call_connected_outbound int, "
       "calldurationinseconds int")
    out = {r["source_system"]: r for r in metric_query(
        f2, ["call_connect_rate", "avg_call_duration_seconds", "total_activities"], ["source_system"]).collect()}
    assert out["S1"]["call_connect_rate"] == 0.5 and out["S1"]["avg_call_duration_seconds"] == 20.0
    assert out["S2"]["call_connect_rate"] is None and out["S2"]["avg_call_duration_seconds"] is None
    assert out["S1"]["total_activities"] == 2


def test_metric_preaggregation_equals_join_then_aggregate(spark):
    fact = spark.createDataFrame([
        ("EDH_SFDC", "O1", "L1", "A1", 10.0), ("EDH_SFDC", "O1", "L2", "A1", 5.0),
        ("EDH_SFDC", "O2", "L1", "A2", 7.0), ("ACS_SFDC", None, "L9", "A2", 1.0), ("ACS_SFDC", "O3", None, None, None),
    ], "source_system string, opportunity_number string, line_item_number string, account_csn string, "
       "acv double").select("*", F.col("acv").cast("decimal(28,8)").alias("line_item_acv_usd"))
    dim = spark.createDataFrame([("A1", "Territory"), ("A2", "Named"), ("A2", "Dup")], "account_csn string, account_segment string")
    got = metric_query(fact, ["total_pipeline_acv_usd", "opportunity_count"], ["account__account_segment"],
                       dims={"account": dim})
    joined = fact.join(dim.withColumnRenamed("account_csn", "k"), F.col("account_csn") == F.col("k"), "left")
    want = joined.groupBy(F.col("account_segment").alias("account__account_segment")).agg(
        F.round(F.sum("line_item_acv_usd"), 2).cast("double").alias("total_pipeline_acv_usd"),
        F.countDistinct(F.concat("source_system", F.lit("|"), "opportunity_number")).alias("opportunity_count"))
    cols = ("account__account_segment", "total_pipeline_acv_usd", "opportunity_count")
    assert rows_of(got, *cols) == rows_of(want, *cols)


def test_materialized_parents_give_the_same_rows(spark):
    from conftest import SF_SMALL
    from dimstar.params import TEST_PARAMS
    from dimstar.plans import opportunity_lines as OL
    from dimstar.queries import _ctx

    src, _ = _ctx(spark, SF_SMALL)
    cols = ("source_system", "opportunity_number", "line_item_number", "line_item_acv_usd", "quote_number")
    lazy = OL.fct_blended_opportunities(src, TEST_PARAMS)
    cut = OL.fct_blended_opportunities(src, TEST_PARAMS, materialize=True)
    assert rows_of(cut, *cols) == rows_of(lazy, *cols)


def test_gap_fill_at_month_grain(spark):
    from dimstar.params import TEST_PARAMS
    from dimstar.plans.dims import time_spine

    f2 = spark.createDataFrame([("a1", "EDH", dt.date(2024, 1, 20), 1), ("a2", "EDH", dt.date(2024, 3, 2), 0)],
                               "activity_id string, source_system string, activity_created_date date, "
                               "call_attempt_outbound int")
    spine = time_spine(spark, TEST_PARAMS).where("date_day BETWEEN DATE'2024-01-01' AND DATE'2024-04-30'")
    got = metric_query(f2, ["total_activities", "outbound_call_attempts"], ["metric_time__month"], spine=spine)
    assert rows_of(got, "metric_time__month", "total_activities", "outbound_call_attempts") == [
        (dt.date(2024, 1, 1), 1, 1), (dt.date(2024, 2, 1), 0, 0), (dt.date(2024, 3, 1), 1, 0), (dt.date(2024, 4, 1), 0, 0)]


def test_staged_sources_give_the_same_marts(spark):
    from conftest import SF_SMALL
    from dimstar.params import TEST_PARAMS
    from dimstar.plans.publish import stage_sources
    from dimstar.queries import _ctx, marts

    src, _ = _ctx(spark, SF_SMALL)
    staged = stage_sources(spark, src)
    for name, f in staged.items():
        assert [(x.name, x.dataType) for x in f.schema] == [(x.name, x.dataType) for x in src[name].schema], name
    a, b = marts(src, TEST_PARAMS), marts(staged, TEST_PARAMS)
    for name in ("fct_blended_opportunities", "fct_blended_opportunity_activities", "dim_unified_account"):
        cols = sorted(a[name].columns)
        assert rows_of(a[name], *cols) == rows_of(b[name], *cols), name


def test_publish_layout_and_views(spark):
    import os

    from dimstar.plans.publish import register_views, run_folder, table_path, write_tables

    folder = run_folder(spark, "test_publish")
    contacts = spark.createDataFrame([("K-1", "EDH")], "contact_csn string, source_system string")
    other = spark.createDataFrame([(1,)], "x int")
    out = write_tables(spark, {"dim_unified_contact": contacts, "scratch": other}, folder=folder)
    assert table_path(folder, "dim_unified_contact") == os.path.join(folder, "private", "dim_unified_contact")
    assert table_path(folder, "scratch") == os.path.join(folder, "scratch")
    assert out["dim_unified_contact"].columns == ["contact_csn", "source_system"]
    names = register_views(out, suffix="_t")
    assert spark.sql(f"SELECT count(*) FROM {names['dim_unified_contact']}").first()[0] == 1


def test_cumulative_metric_matches_running_total_query(spark):
    import pytest

    from conftest import SF_SMALL
    from dimstar.queries import REGISTRY, _marts

    m = _marts(spark, SF_SMALL)
    got = metric_query(m["fct_blended_opportunities"], ["total_pipeline_acv_usd", "cumulative_pipeline_acv_usd"],
                       ["source_system", "metric_time__month"])
    want = REGISTRY["pipeline_cumulative_by_month"](spark, SF_SMALL)
    a = rows_of(got, "source_system", "metric_time__month", "total_pipeline_acv_usd", "cumulative_pipeline_acv_usd")
    b = rows_of(want, "source_system", "close_month", "monthly_acv_usd", "cumulative_acv_usd")
    assert a == b
    with pytest.raises(ValueError):
        metric_query(m["fct_blended_opportunities"], ["cumulative_pipeline_acv_usd"], ["source_system"])


def test_salted_left_join_equals_left_join(spark):
    from dimstar.operators import hot_keys, salted_left_join

    parents = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4), ("a", 5), ("d", 6)], "pk string, pv int")
    children = spark.createDataFrame([("a", 10), ("a", 10), ("b", 20), (None, 30), ("z", 40), ("d", 7)]
                                     + [("a", 100 + i) for i in range(50)], "ck string, cv int")
    extra = spark.createDataFrame([(10, "x"), (11, "y"), (120, "z")], "ek int, ev string")
    look = lambda d: d.join(extra, F.col("cv") == F.col("ek"), "left")
    want = parents.join(children, F.col("pk") == F.col("ck"), "left")
    assert hot_keys(children, "ck", least=10, share=1.0) == ["a"] and hot_keys(children, "ck") == []
    for hot in ([], ["a"], ["a", "d"]):
        got = salted_left_join(parents, children, "pk", "ck", hot, salts=8)
        assert rows_of(got, "pk", "pv", "ck", "cv") == rows_of(want, "pk", "pv", "ck", "cv")
        got = salted_left_join(parents, children, "pk", "ck", hot, look, salts=8)
        assert rows_of(got, "pk", "pv", "cv", "ev") == rows_of(look(want), "pk", "pv", "cv", "ev")
