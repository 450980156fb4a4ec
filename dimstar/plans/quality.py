"""Data tests: each test is a DataFrame of failing rows; zero rows = pass.

``failing_rows`` builds the rows for one test, ``summary`` counts them per
test (one row per test, also when it passes), and ``failure_log`` appends
a run's failing rows to a log table under the shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimstar.functions import rules as R


@dataclass(frozen=True)
class DataTest:
    name: str
    kind: str  # unique | not_null | accepted_values | relationships
    model: str
    column: str
    severity: str = "error"
    values: tuple[str, ...] = ()
    to_model: str | None = None
    to_column: str | None = None


def _t(kind, model, column, name=None, **kw):
    suffix = {"unique": "unique", "not_null": "not_null", "accepted_values": "values", "relationships": "fk"}[kind]
    return DataTest(name or f"{model}_{column}_{suffix}", kind, model, column, **kw)


FCT_P, FCT_A = "fct_blended_opportunities", "fct_blended_opportunity_activities"
UNIQUE_TESTS = (
    _t("unique", "dim_date", "date_day"),
    _t("unique", "dim_unified_account", "account_csn"),
    _t("unique", "dim_unified_employee", "employee_id"),
    _t("unique", "dim_unified_contact", "contact_csn"),
    _t("unique", "dim_unified_opportunity", "opportunity_number"),
)
NOT_NULL_TESTS = tuple(_t("not_null", t.model, t.column) for t in UNIQUE_TESTS) + (
    _t("not_null", FCT_P, "opportunity_number"),
    _t("not_null", FCT_A, "activity_id"),
)
ACCEPTED_TESTS = (
    _t("accepted_values", FCT_P, "source_system", values=(R.PIPELINE_EDH, R.PIPELINE_ACS)),
    _t("accepted_values", FCT_A, "source_system", values=(R.ACTIVITY_EDH, R.ACTIVITY_ACS)),
    _t("accepted_values", "dim_unified_account", "source_system", values=(R.DIM_EDH, R.DIM_ACS)),
    _t("accepted_values", "dim_unified_employee", "source_system", values=(R.DIM_EDH, R.DIM_ACS)),
    _t("accepted_values", "dim_unified_contact", "source_system", values=(R.DIM_EDH, R.DIM_ACS)),
    _t("accepted_values", "dim_unified_opportunity", "source_system", values=(R.PIPELINE_EDH, R.PIPELINE_ACS)),
)


def _rel(model, column, to_model, to_column, name):
    return DataTest(name, "relationships", model, column, "warn", (), to_model, to_column)


PIPELINE_REL_TESTS = (
    _rel(FCT_P, "opportunity_number", "dim_unified_opportunity", "opportunity_number",
         f"{FCT_P}_opportunity_number_fk"),
    _rel(FCT_P, "account_csn", "dim_unified_account", "account_csn", f"{FCT_P}_account_csn_fk"),
    _rel(FCT_P, "opportunity_owner_id", "dim_unified_employee", "employee_id", f"{FCT_P}_opportunity_owner_fk"),
    _rel(FCT_P, "opportunity_projected_close_date", "dim_date", "date_day", f"{FCT_P}_projected_close_date_fk"),
)
ACTIVITY_REL_TESTS = (
    _rel(FCT_A, "account_csn", "dim_unified_account", "account_csn", f"{FCT_A}_account_csn_fk"),
    _rel(FCT_A, "ownerid", "dim_unified_employee", "employee_id", f"{FCT_A}_ownerid_fk"),
    _rel(FCT_A, "account_contact_csn", "dim_unified_contact", "contact_csn", f"{FCT_A}_account_contact_csn_fk"),
    _rel(FCT_A, "opportunity_number", "dim_unified_opportunity", "opportunity_number",
         f"{FCT_A}_opportunity_number_fk"),
    _rel(FCT_A, "activity_created_date", "dim_date", "date_day", f"{FCT_A}_activity_created_date_fk"),
)
ALL_TESTS = UNIQUE_TESTS + NOT_NULL_TESTS + ACCEPTED_TESTS + PIPELINE_REL_TESTS + ACTIVITY_REL_TESTS


def failing_rows(test: DataTest, marts: Mapping[str, DataFrame]) -> DataFrame:
    """Failing rows as (failing_key string, n_records bigint); orphans by key, with the number of their records."""
    df = marts[test.model]
    c = F.col(test.column)
    if test.kind == "unique":
        return (df.where(c.isNotNull()).groupBy(c.alias("k")).agg(F.count(F.lit(1)).alias("n_records"))
                .where(F.col("n_records") > 1)
                .select(F.col("k").cast("string").alias("failing_key"), "n_records"))
    if test.kind == "not_null":
        return df.where(c.isNull()).select(F.lit(None).cast("string").alias("failing_key"),
                                           F.lit(1).cast("bigint").alias("n_records"))
    if test.kind == "accepted_values":
        return (df.where(~c.isin(*test.values)).groupBy(c.alias("k")).agg(F.count(F.lit(1)).alias("n_records"))
                .select(F.col("k").cast("string").alias("failing_key"), "n_records"))
    if test.kind == "relationships":
        return _orphans([test], marts).select("failing_key", "n_records")
    raise ValueError(test.kind)


def _row_failures(tests: Sequence[DataTest], df: DataFrame) -> DataFrame:
    """(test_name, severity, failing_key, n_records) of a mart's row tests, from one pass over it.

    Each row gives the tests that it fails: as many output rows, mostly none.
    A missing value is a failing record of its own; other values are grouped.
    """
    hits = []
    for t in tests:
        c, null = F.col(t.column), t.kind == "not_null"
        hits.append(F.when(c.isNull() if null else ~c.isin(*t.values), F.struct(
            F.lit(t.name).alias("test_name"), F.lit(t.severity).alias("severity"),
            (F.lit(None) if null else c).cast("string").alias("failing_key"), F.lit(null).alias("__single"))))
    rows = df.select(F.inline(F.array_compact(F.array(*hits))))
    own = F.when(F.col("__single"), F.monotonically_increasing_id()).alias("__own")
    return rows.select("test_name", "severity", "failing_key", own).groupBy("test_name", "severity", "failing_key", "__own") \
        .agg(F.count(F.lit(1)).alias("n_records")).drop("__own")


def _orphans(tests: Sequence[DataTest], marts: Mapping[str, DataFrame]) -> DataFrame:
    """(test_name, severity, failing_key, n_records) of one mart's foreign keys, from one pass over it.

    All its keys are counted within the tasks first, so a hot key is one row
    by the time anything is shuffled, and the anti join sees keys, not facts.
    """
    df = marts[tests[0].model]
    keys = [F.when(F.col(t.column).isNotNull(), F.struct(
        F.lit(t.name).alias("test_name"), F.lit(t.severity).alias("severity"),
        F.col(t.column).cast("string").alias("failing_key"))) for t in tests]
    counted = df.select(F.inline(F.array_compact(F.array(*keys)))).groupBy("test_name", "severity", "failing_key") \
        .agg(F.count(F.lit(1)).alias("n_records"))
    parents = None
    for t in tests:
        own = marts[t.to_model].select(F.lit(t.name).alias("__test"), F.col(t.to_column).cast("string").alias("__key"))
        own = own.where(F.col("__key").isNotNull()).distinct()
        parents = own if parents is None else parents.unionByName(own)
    same = (F.col("test_name") == F.col("__test")) & (F.col("failing_key") == F.col("__key"))
    return counted.join(parents, same, "left_anti")


def _by_model(tests: Sequence[DataTest], *kinds: str) -> dict[str, list[DataTest]]:
    found: dict[str, list[DataTest]] = {}
    for t in tests:
        if t.kind in kinds:
            found.setdefault(t.model, []).append(t)
    return found


def _orphan_counts(tests: Sequence[DataTest], marts: Mapping[str, DataFrame]) -> DataFrame:
    """The summary rows of one mart's foreign keys: every orphan record is a failure."""
    sums = [F.coalesce(F.sum(F.when(F.col("test_name") == t.name, F.col("n_records"))), F.lit(0)).cast("bigint").alias(f"n{i}")
            for i, t in enumerate(tests)]
    rows = [F.struct(F.lit(t.name).alias("test_name"), F.lit(t.kind).alias("test_kind"), F.lit(t.severity).alias("severity"),
                     F.col(f"n{i}").alias("failures"), F.col(f"n{i}").alias("failing_records")) for i, t in enumerate(tests)]
    return _orphans(tests, marts).agg(*sums).select(F.inline(F.array(*rows)))


def _scan_counts(tests: Sequence[DataTest], df: DataFrame) -> DataFrame:
    """The summary rows of a mart's not_null and accepted_values tests, from one aggregate over it."""
    aggs = []
    for i, t in enumerate(tests):
        c = F.col(t.column)
        bad = c.isNull() if t.kind == "not_null" else ~c.isin(*t.values)
        aggs.append(F.count_if(bad).alias(f"n{i}"))
        if t.kind == "accepted_values":
            aggs.append(F.countDistinct(F.when(bad, c)).alias(f"k{i}"))
    rows = [F.struct(F.lit(t.name).alias("test_name"), F.lit(t.kind).alias("test_kind"),
                     F.lit(t.severity).alias("severity"),
                     F.col(f"n{i}" if t.kind == "not_null" else f"k{i}").alias("failures"),
                     F.col(f"n{i}").alias("failing_records")) for i, t in enumerate(tests)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def summary(tests: Sequence[DataTest], marts: Mapping[str, DataFrame]) -> DataFrame:
    """One row per test: (test_name, test_kind, severity, failures, failing_records).

    Tests that look at one row at a time share one scan of their mart, and so
    do its foreign keys.
    """
    parts = []
    for t in tests:
        if t.kind == "unique":
            rows = failing_rows(t, marts)
            parts.append(rows.agg(F.count(F.lit(1)).alias("failures"),
                                  F.coalesce(F.sum("n_records"), F.lit(0)).cast("bigint").alias("failing_records"))
                         .select(F.lit(t.name).alias("test_name"), F.lit(t.kind).alias("test_kind"),
                                 F.lit(t.severity).alias("severity"), "failures", "failing_records"))
    parts += [_scan_counts(ts, marts[model]) for model, ts in _by_model(tests, "not_null", "accepted_values").items()]
    parts += [_orphan_counts(ts, marts) for ts in _by_model(tests, "relationships").values()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def summary_of_log(tests: Sequence[DataTest], log: DataFrame) -> DataFrame:
    """The same summary from a run's written failing rows; tests without any read 0."""
    names = log.sparkSession.createDataFrame([(t.name, t.kind, t.severity) for t in tests],
                                             "test_name string, test_kind string, severity string")
    found = log.groupBy("test_name").agg(F.count(F.lit(1)).alias("failures"), F.sum("n_records").alias("failing_records"))
    # Orphans are logged by key, and counted by record.
    found = found.withColumn("failures", F.when(F.col("test_name").isin([t.name for t in tests if t.kind == "relationships"]),
                                                F.col("failing_records")).otherwise(F.col("failures")))
    return names.join(found, "test_name", "left").select(
        "test_name", "test_kind", "severity", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"),
        F.coalesce("failing_records", F.lit(0)).cast("bigint").alias("failing_records"))


def all_failing_rows(tests: Sequence[DataTest], marts: Mapping[str, DataFrame]) -> DataFrame:
    """(test_name, severity, failing_key, n_records) of all tests: a pass per mart for its row tests, one for its foreign keys."""
    parts = [failing_rows(t, marts).select(F.lit(t.name).alias("test_name"), F.lit(t.severity).alias("severity"),
                                           "failing_key", "n_records") for t in tests if t.kind == "unique"]
    parts += [_row_failures(ts, marts[model]) for model, ts in _by_model(tests, "not_null", "accepted_values").items()]
    parts += [_orphans(ts, marts) for ts in _by_model(tests, "relationships").values()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def failure_log(spark: SparkSession, tests: Sequence[DataTest], marts: Mapping[str, DataFrame],
                log_root: str, run_id: str | None = None) -> DataFrame:
    """Append this run's failing rows to ``log_root`` (partitioned by run) and read them back."""
    run_id = run_id or uuid.uuid4().hex
    # Each run writes its own partition folder, so concurrent or retried runs
    # never share an output directory; readers see runs as a run_id column.
    rows, folder = all_failing_rows(tests, marts), f"{log_root.rstrip('/')}/run_id={run_id}"
    rows.write.mode("overwrite").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)
