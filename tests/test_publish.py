"""Runs published as a whole, facts ordered by date in their files, unreadable values counted while landing."""

import glob
import os
import tempfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows_of
from dimstar.plans.publish import expire_runs, manifests, publish_run, published, stage_extracts, write_tables


def frames(spark, n):
    return {name: spark.createDataFrame([(n, name)], "x int, source_system string") for name in ("dim_date", "dim_unified_contact", "other")}


def seen(spark, folder):
    return {name: {r["x"] for r in df.collect()} for name, df in published(spark, folder).items()}


def test_a_run_that_fails_changes_nothing(spark):
    folder = tempfile.mkdtemp(prefix="dimstar-runs-")
    publish_run(spark, frames(spark, 1), folder)
    old = published(spark, folder)
    bad = frames(spark, 2)
    bad["other"] = bad["other"].withColumn("x", F.raise_error(F.lit("the third mart fails")).cast("int"))
    with pytest.raises(Exception, match="third mart fails"):
        publish_run(spark, bad, folder)
    assert seen(spark, folder) == {"dim_date": {1}, "dim_unified_contact": {1}, "other": {1}}
    publish_run(spark, frames(spark, 3), folder)
    assert seen(spark, folder) == {"dim_date": {3}, "dim_unified_contact": {3}, "other": {3}}
    # Who reads the old run goes on reading it.
    assert [r["x"] for r in old["dim_date"].collect()] == [1]
    # The run that failed goes with the first clean-up; the newest two stay.
    assert len(os.listdir(os.path.join(folder, "runs"))) == 3
    assert len(expire_runs(spark, folder)) == 1 and len(manifests(spark, folder)) == 2
    publish_run(spark, frames(spark, 4), folder)
    assert len(expire_runs(spark, folder, keep=1)) == 2 and seen(spark, folder)["other"] == {4}


def test_tables_without_a_manifest(spark):
    folder = tempfile.mkdtemp(prefix="dimstar-runs-")
    write_tables(spark, {"dim_date": frames(spark, 7)["dim_date"]}, folder=folder)
    assert {r["x"] for r in published(spark, folder, ["dim_date"])["dim_date"].collect()} == {7}


def test_date_filters_skip_row_groups(spark):
    """Few row groups of a fact hold a month of it."""
    from dimstar.plans.metrics import metric_query

    days = spark.range(60_000).select(
        F.concat(F.lit("O"), F.col("id").cast("string")).alias("opportunity_number"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.xxhash64("id") % 365 + 365).cast("int") % 365).alias("opportunity_projected_close_date"),
        F.col("id").cast("decimal(28,8)").alias("line_item_acv_usd"), F.lit("EDH_SFDC").alias("source_system")).repartition(2)
    name = "fct_blended_opportunities"
    where = "opportunity_projected_close_date BETWEEN DATE'2024-03-01' AND DATE'2024-03-31'"

    def groups(folder):
        hit = total = 0
        for file in glob.glob(f"{folder}/**/*.parquet", recursive=True):
            meta = pq.ParquetFile(file).metadata
            at = meta.schema.names.index("opportunity_projected_close_date")
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(at).statistics
                total += 1
                hit += str(stats.min) <= "2024-03-31" and str(stats.max) >= "2024-03-01"
        return hit, total

    folder, plain = (tempfile.mkdtemp(prefix="dimstar-order-") for _ in range(2))
    back = write_tables(spark, {name: days}, folder=folder, row_group_bytes=16_000)[name]
    days.write.mode("overwrite").option("parquet.block.size", 16_000).parquet(plain)
    hit, total = groups(folder)
    assert total >= 20 and hit <= total / 5
    assert groups(plain)[0] == groups(plain)[1]
    month = metric_query(back, ["total_pipeline_acv_usd", "opportunity_count"], ["metric_time__month"], where=where)
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(opportunity_projected_close_date)" in plan
    want = days.where(where).count()
    assert [r["opportunity_count"] for r in month.collect()] == [want]


def test_unreadable_values_are_counted_while_landing(spark):
    from dimstar.queries import _ctx
    from dimstar.sources.catalog import load_rejects

    src, _ = _ctx(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="dimstar-extracts-")
    for name, df in src.items():
        text = df.select([F.col(c).cast("string").alias(c) for c in df.columns])
        if name == "edh_exchange_rate":
            text = text.withColumn("exchange_rate", F.when(F.col("from_currency_code") == "EUR", "n/a").otherwise(F.col("exchange_rate")))
        text.write.mode("overwrite").parquet(f"{root}/{name}")
    staged, found = stage_extracts(spark, root)
    assert sorted(found) == sorted((r["source"], r["column"], r["rejected"]) for r in load_rejects(spark, root).collect())
    assert any(r[:2] == ("edh_exchange_rate", "exchange_rate") and r[2] > 0 for r in found)
    cols = ("opportunity_number", "line_item_number")
    assert rows_of(staged["edh_opportunity_line_item"], *cols) == rows_of(src["edh_opportunity_line_item"], *cols)
