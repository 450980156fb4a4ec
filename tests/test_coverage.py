"""dq_coverage: each mart is computed once, and large joins drop rows before they are shuffled."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows_of
from dimstar import queries as Q
from dimstar import session as S
from dimstar.plans.publish import write_counted

SCAN = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    frames = {
        "dim_date": spark.range(7).select(F.col("id").alias("x")),
        "other": spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "x int, source_system string"),
        "none": spark.createDataFrame([], "x int, source_system string"),
        "filtered": spark.range(50).where("id < 0"),
        "joined": spark.range(50).join(spark.range(0, 90, 2), "id").where("id % 7 = 0"),
    }
    tables, rows = write_counted(spark, frames, folder=str(tmp_path / "all"))
    assert rows == {"dim_date": 7, "other": 3, "none": 0, "filtered": 0, "joined": 4}
    assert {n: df.count() for n, df in tables.items()} == rows
    assert all(tables[n].dtypes == frames[n].dtypes for n in frames)
    tables, rows = write_counted(spark, frames, ["other"], str(tmp_path / "one"))
    assert list(tables) == ["other"] and rows == {"other": 3}


def test_coverage_computes_a_mart_once(spark, monkeypatch):
    computed = spark.sparkContext.accumulator(0)

    def seen(x):
        computed.add(1)
        return x % 3 != 0

    keep = F.udf(seen, "boolean")
    marts = {"dim_date": spark.range(30).where(keep("id")), "empty": spark.range(0)}
    monkeypatch.setattr(Q, "_marts", lambda spark, sf_dir: marts)
    out = Q.dq_coverage(spark, "nowhere")
    assert rows_of(out, "model", "transform_rows", "publish_rows") == [("dim_date", 20, 20), ("empty", 0, 0)]
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string", "bigint", "bigint"]
    assert computed.value == 30


def test_runtime_filters_hold_for_a_write_only(spark):
    assert all(spark.conf.get(k, None) is None for k in S.RUNTIME_FILTERS)
    spark.conf.set(SCAN, "3g")  # a session's own setting wins
    try:
        with S.runtime_filters(spark):
            now = {k: spark.conf.get(k) for k in S.RUNTIME_FILTERS}
        assert now == S.RUNTIME_FILTERS | {SCAN: "3g"}
        assert spark.conf.get(SCAN) == "3g"
    finally:
        spark.conf.unset(SCAN)
    assert all(spark.conf.get(k, None) is None for k in S.RUNTIME_FILTERS)


def test_lines_are_filtered_before_the_shuffle(spark, monkeypatch):
    """Of both line streams, lines outside the window's opportunities are dropped by a Bloom filter; the rows are the same."""
    monkeypatch.setitem(S.RUNTIME_FILTERS, SCAN, "1b")  # as if the tables were large
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f1 = Q._marts(spark, SF_SMALL)[Q.F1]
        columns = f1.columns
        plain = f1.select("*")
        assert "bloom_filter_agg" not in plain._jdf.queryExecution().optimizedPlan().toString()
        with S.runtime_filters(spark):
            filtered = f1.select("*")
            plan = filtered._jdf.queryExecution().optimizedPlan().toString()
            got = rows_of(filtered, *columns)
        for prefix in ("A-", "S-"):
            assert any("might_contain" in line and f"concat({prefix}, cast(l_orderkey" in line and "l_returnflag" not in line
                       for line in plan.splitlines()), prefix
        assert got and got == rows_of(plain, *columns)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
