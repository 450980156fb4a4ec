"""Metric requests: exact sums, distinct counts by dimension, dimension filters, running totals, both facts."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dimstar.plans.metrics import METRICS, dimensions_of, metric_query

D = dt.date


@pytest.fixture(scope="module")
def pipeline(spark):
    rows = [("S", "O1", "A1", D(2024, 1, 10), "0.004", "0.002"), ("S", "O2", "A2", D(2024, 1, 20), "1.0", "0.5"),
            ("S", "O3", None, D(2024, 3, 5), "2.0", None)]
    df = spark.createDataFrame(rows, "source_system string, opportunity_number string, account_csn string, "
                                     "opportunity_projected_close_date date, acv string, weighted string")
    return df.select("*", F.col("acv").cast("decimal(28,8)").alias("line_item_acv_usd"),
                     F.col("weighted").cast("decimal(32,10)").alias("line_item_weighted_acv_usd"),
                     F.lit(1.0).alias("quantity"))


@pytest.fixture(scope="module")
def activities(spark):
    rows = [("T1", "A1", 1), ("T1", "A1", 1), ("T2", "A9", 0), ("T3", None, 1)]
    return spark.createDataFrame(rows, "activity_id string, account_csn string, call_attempt_outbound int")


@pytest.fixture(scope="module")
def dims(spark):
    return {"account": spark.createDataFrame([("A1", "Large"), ("A2", "Small"), ("A9", "Small")],
                                             "account_csn string, account_segment string")}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_sums_under_a_cent(pipeline):
    one = pipeline.where("opportunity_number = 'O1'")
    got = metric_query(one, ["total_pipeline_acv_usd", "pipeline_confidence_ratio", "acv_per_opportunity"], ["source_system"])
    assert rows(got) == [("S", 0.004, 0.5, 0.004)]


def test_distinct_count_alone_by_dimension(activities, dims):
    got = metric_query(activities, ["total_activities"], ["account__account_segment"], dims=dims)
    assert rows(got) == [("Large", 1), ("Small", 1), (None, 1)]


def test_filter_on_a_dimension(pipeline, dims):
    def ask(keys, where):
        return rows(metric_query(pipeline, ["opportunity_count"], keys, dims=dims, where=where))

    assert ask([], "account__account_segment = 'Small'") == [(1,)]
    assert ask(["account__account_segment"], "account__account_segment <> 'not__a_role'") == [("Large", 1), ("Small", 1)]
    assert ask(["source_system"], "account__account_segment IS NULL AND quantity > 0") == [("S", 1)]


def test_running_totals_go_on_over_empty_periods(spark, pipeline):
    spine = spark.createDataFrame([(D(2024, m, 1),) for m in range(1, 7)], "date_day date")
    got = metric_query(pipeline, ["total_pipeline_acv_usd", "cumulative_pipeline_acv_usd", "trailing_3_pipeline_acv_usd"],
                       ["metric_time__month"], spine=spine)
    assert [r[1:] for r in rows(got)] == [(1.004, 1.004, 1.004), (0.0, 1.004, 1.004), (2.0, 3.004, 3.004),
                                          (0.0, 3.004, 2.0), (0.0, 3.004, 2.0), (0.0, 3.004, 0.0)]
    # Without the spine a trailing window still counts periods, not rows.
    got = metric_query(pipeline, ["trailing_3_pipeline_acv_usd"], ["metric_time__month"])
    assert [r[1] for r in rows(got)] == [1.004, 3.004]


def test_metrics_of_both_facts(pipeline, activities):
    facts = {"blended_opportunities": pipeline, "blended_opportunity_activities": activities}
    names = ["total_activities", "opportunity_count"]
    assert rows(metric_query(facts, names, ["account_csn"])) == [("A1", 1, 1), ("A2", None, 1), ("A9", 1, None), (None, 1, 1)]
    assert rows(metric_query(facts, names)) == [(3, 3)]
    with pytest.raises(ValueError):
        metric_query(pipeline, names)


def test_names_and_texts(dims):
    assert "account__account_segment" in dimensions_of(["total_activities", "opportunity_count"], dims)
    assert all(m.label and m.description for m in METRICS.values())


def test_values_on_load(spark):
    from dimstar.sources.catalog import SOURCE_COLUMNS, rejects, typed

    def raw(name, **values):
        cols = SOURCE_COLUMNS[name]
        return spark.createDataFrame([tuple(values.get(c) for c in cols)], ", ".join(f"{c} string" for c in cols))

    assert typed("edh_exchange_rate", raw("edh_exchange_rate", exchange_rate="0.0000392")).first()["exchange_rate"] == Decimal("0.0000392")
    for word, flag in (("true", 1), ("False", 0), ("Y", 1), ("1", 1), ("0", 0), (None, None)):
        assert typed("edh_account", raw("edh_account", is_visible=word)).first()["is_visible"] == flag
    bad = raw("edh_exchange_rate", exchange_rate="n/a", effective_start_date="2024-01-01")
    assert {(r[1], r[2]) for r in rejects("edh_exchange_rate", bad).collect()} == {("exchange_rate", 1), ("effective_start_date", 0)}
    wide = spark.sql("SELECT 'EUR' AS from_currency_code, DATE'2024-01-01' AS effective_start_date, 0.00003921234BD AS exchange_rate")
    wide = wide.select(*[F.col(c) if c in wide.columns else F.lit(None).cast("string").alias(c) for c in SOURCE_COLUMNS["edh_exchange_rate"]])
    assert typed("edh_exchange_rate", wide).first()["exchange_rate"] == Decimal("0.00003921234")


def test_empty_mart_is_published(spark):
    from dimstar.plans.publish import write_tables

    df = spark.createDataFrame([], "source_system string, n int")
    back = write_tables(spark, {"some_mart": df})["some_mart"]
    assert back.columns == df.columns and back.count() == 0


# --- distinct counts over periods, two keys, one filter for two facts -----------------

def _deals(spark):
    """Opportunities of two systems, seen in several months, some without a date."""
    import random

    rnd = random.Random(4)
    rows = []
    for _ in range(400):
        month = rnd.choice([None, 1, 1, 2, 5, 6, 9, 12])
        rows.append((rnd.choice("ST"), f"O{rnd.randint(1, 60)}", None if month is None else D(2024, month, rnd.randint(1, 28)), rnd.choice([1.0, 2.0, 5.0])))
    rows += [("S", None, D(2024, 2, 2), 1.0), ("T", "O1", D(2023, 6, 1), 1.0)]
    df = spark.createDataFrame(rows, "source_system string, opportunity_number string, opportunity_projected_close_date date, quantity double")
    return rows, df.select("*", F.col("quantity").cast("decimal(28,8)").alias("line_item_acv_usd"), F.lit(None).cast("decimal(32,10)").alias("line_item_weighted_acv_usd"))


def _month(d):
    return None if d is None else d.year * 12 + d.month


def test_running_and_trailing_distinct_counts(spark):
    rows_, df = _deals(spark)
    got = metric_query(df, ["opportunity_count", "cumulative_opportunity_count", "trailing_3_opportunity_count"],
                       ["metric_time__month", "source_system"]).collect()
    assert len(got) == len({(_month(r[2]), r[0]) for r in rows_})
    for r in got:
        at = _month(r["metric_time__month"])
        own = [(o, _month(d)) for s, o, d, _ in rows_ if s == r["source_system"] and o is not None]
        now = {o for o, m in own if m == at}
        # Rows without a date come before all periods.
        before = {o for o, m in own if m is None or (at is not None and m <= at)}
        last = {o for o, m in own if m is not None and at is not None and at - 3 < m <= at} if at is not None else now
        assert (r["opportunity_count"], r["cumulative_opportunity_count"], r["trailing_3_opportunity_count"]) == (len(now), len(before), len(last))


def test_series_of_every_key_go_on_over_empty_periods(spark):
    rows_, df = _deals(spark)
    spine = spark.createDataFrame([(D(2024, m, 1),) for m in range(1, 13)] + [(D(2025, 1, 1),), (D(2025, 2, 1),)], "date_day date")
    names = ["opportunity_count", "cumulative_opportunity_count", "trailing_3_opportunity_count", "cumulative_pipeline_acv_usd", "trailing_3_pipeline_acv_usd"]
    got = metric_query(df, names, ["source_system", "metric_time__month"], spine=spine).collect()
    assert len(got) == 28
    for r in got:
        at = _month(r["metric_time__month"])
        own = [(o, _month(d), q) for s, o, d, q in rows_ if s == r["source_system"] and d is not None and d.year == 2024]
        count = lambda a: len({o for o, m, _ in own if o is not None and a <= m <= at})
        acv = lambda a: sum(q for _, m, q in own if a <= m <= at)
        assert [r[n] for n in names] == [count(at), count(0), count(at - 2), acv(0), acv(at - 2)]


def test_null_keys_have_a_series(spark):
    df = spark.createDataFrame([(None, "O1", D(2024, 1, 5)), ("S", "O2", D(2024, 3, 5))], "source_system string, opportunity_number string, opportunity_projected_close_date date")
    df = df.select("*", F.lit(1).cast("decimal(28,8)").alias("line_item_acv_usd"))
    spine = spark.createDataFrame([(D(2024, m, 1),) for m in (1, 2, 3)], "date_day date")
    got = metric_query(df, ["cumulative_pipeline_acv_usd"], ["metric_time__month", "source_system"], spine=spine)
    assert rows(got) == sorted([(D(2024, m, 1), s, v) for s, vs in ((None, (1.0, 1.0, 1.0)), ("S", (0.0, 0.0, 1.0))) for m, v in zip((1, 2, 3), vs)], key=repr)


def test_distinct_changes_merge_overlapping_stretches(spark):
    from dimstar.plans.metrics import distinct_changes

    ids = spark.createDataFrame([("a", 1), ("a", 1), ("a", 3), ("a", 9), ("b", 2)], "v string, p bigint")
    got = {r["p"]: r["change"] for r in distinct_changes(ids, [], "p", "v", 3).collect()}
    assert got == {1: 1, 2: 1, 5: -1, 6: -1, 9: 1, 12: -1}
    plan = distinct_changes(ids, [], "p", "v", 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_split_conjuncts():
    from dimstar.plans.metrics import split_conjuncts

    assert split_conjuncts("a = 1 AND b BETWEEN 1 AND 2 and c IN ('x AND y', 'it''s')") == ["a = 1", "b BETWEEN 1 AND 2", "c IN ('x AND y', 'it''s')"]
    assert split_conjuncts("(a = 1 AND b = 2) AND CASE WHEN a AND b THEN 1 END = 1") == ["(a = 1 AND b = 2)", "CASE WHEN a AND b THEN 1 END = 1"]
    assert split_conjuncts("a = 1 OR b = 2 AND c = 3") == ["a = 1 OR b = 2 AND c = 3"]
    assert split_conjuncts("`x AND y` = 1 AND brand = 'AND'") == ["`x AND y` = 1", "brand = 'AND'"]


def test_one_filter_for_two_facts(pipeline, activities, dims):
    facts = {"blended_opportunities": pipeline, "blended_opportunity_activities": activities}
    names = ["total_activities", "opportunity_count"]

    def ask(where):
        return rows(metric_query(facts, names, ["account_csn"], dims=dims, where=where))

    assert ask("quantity > 0 AND call_attempt_outbound = 1") == [("A1", 1, 1), ("A2", None, 1), (None, 1, 1)]
    assert ask("opportunity_number = 'O2' AND account__account_segment = 'Small'") == [("A2", None, 1), ("A9", 1, None)]
    assert ask("quantity > 100 AND account_csn IS NOT NULL") == [("A1", 1, None), ("A9", 1, None)]
    with pytest.raises(ValueError, match="no_such_column"):
        ask("quantity > 0 AND no_such_column = 1")
    with pytest.raises(ValueError):
        ask("quantity > 0 OR call_attempt_outbound = 1")
