"""A key holding a third of the rows is split by AQE in the skew-safe join shapes."""

import contextlib

from pyspark.sql import functions as F

from dimstar.operators import latest_per_key, one_to_many_left_join


@contextlib.contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _hot(spark, n=120_000):
    children = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"), (F.col("id") % 4000).cast("string")))
        .alias("ck"), F.col("id").alias("cv"))
    parents = spark.range(5000).select(
        F.when(F.col("id") == 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"), F.col("id").cast("string"))).alias("pk"),
        F.col("id").alias("pv"))
    return parents, children


def test_hot_child_key_is_split(spark):
    with conf(spark, **SMALL_SKEW):
        parents, children = _hot(spark)
        df = one_to_many_left_join(parents, children, "pk", "ck")
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        want = parents.join(children, F.col("pk") == F.col("ck"), "left").count()
        assert len(rows) == want


def test_hot_key_top1_limits_before_shuffle(spark):
    with conf(spark, **SMALL_SKEW):
        _, children = _hot(spark)
        top = latest_per_key(children, ["ck"], [F.col("cv").desc()])
        assert top.where(F.col("ck") == "HOT").first()["cv"] == max(
            r for r in range(120_000) if r % 3 == 0)
        assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_activity_fact_with_a_hot_opportunity(spark):
    from conftest import rows_of
    from dimstar.params import TEST_PARAMS
    from dimstar.plans import activities as A
    from dimstar.queries import _ctx

    src, _ = _ctx(spark, "/root/testdata/sf0.01")
    tasks = src.edh_opportunity_task
    # AQE splits a hot reduce partition at map-output boundaries, so the task
    # table must come from several map tasks, as a multi-file table does (the
    # test files are a single row group each).
    hot = tasks.withColumn(
        "opportunity_number",
        F.when(F.substring("task_id", -1, 1).isin("1", "4", "7"), F.lit("A-1")).otherwise(F.col("opportunity_number"))
    ).repartition(8)
    skewed = src.replace(edh_opportunity_task=hot)
    cols = ("activity_id", "opportunity_number", "new_activity_type", "call_attempt_outbound")
    want = rows_of(A.fct_blended_opportunity_activities(skewed, TEST_PARAMS), *cols)
    with conf(spark, **SMALL_SKEW):
        df = A.fct_blended_opportunity_activities(skewed, TEST_PARAMS)
        got = rows_of(df, *cols)
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    assert got == want
    assert sum(1 for r in got if r[1] == "A-1") > len(got) // 4


def test_salted_join_deals_a_hot_child_key_over_tasks(spark):
    from dimstar.operators import hot_keys, salted_left_join

    with conf(spark, **{**SMALL_SKEW, "spark.sql.adaptive.skewJoin.enabled": "false"}):
        parents, children = _hot(spark)
        hot = hot_keys(children, "ck", least=20_000, share=0.05)
        assert hot == ["HOT"]

        def largest(df):
            return max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("t")).count().collect())

        want = parents.join(children, F.col("pk") == F.col("ck"), "left")
        got = salted_left_join(parents, children, "pk", "ck", hot)
        assert got.count() == want.count()
        assert largest(want) > 40_000 and largest(got) < 30_000


def test_fact_with_a_hot_opportunity_of_lines(spark):
    from conftest import rows_of
    from dimstar.operators import joins
    from dimstar.params import TEST_PARAMS
    from dimstar.plans import opportunity_lines as P
    from dimstar.queries import _ctx

    src, _ = _ctx(spark, "/root/testdata/sf0.001")
    lines = src.edh_opportunity_line_item
    top = P.edh_opportunity_lines(src, TEST_PARAMS).first()["opportunity_number"]
    hot = lines.withColumn("opportunity_number", F.when(F.xxhash64("line_item_number") % 3 == 0, F.lit(top)).otherwise(F.col("opportunity_number")))
    skewed = src.replace(edh_opportunity_line_item=hot)
    cols = ("opportunity_number", "line_item_number", "line_item_acv_usd", "offering_name")
    want = rows_of(P.edh_opportunity_lines(skewed, TEST_PARAMS), *cols)
    old = joins.hot_keys.__defaults__
    joins.hot_keys.__defaults__ = (100, 1.0, 5)
    try:
        df = P.edh_opportunity_lines(skewed, TEST_PARAMS)
        assert "__salt" in df._jdf.queryExecution().optimizedPlan().toString()
        assert rows_of(df, *cols) == want
    finally:
        joins.hot_keys.__defaults__ = old
