"""Publishing: write models as tables under the shared folder, read them back.

This is the table materialisation of the marts (and a lineage cut: a
query over a published table starts from the files, not from the sources).
Tables go under ``spark.checkpoint.dir`` (the cluster's shared, durable
folder), one sub-folder per run so concurrent runs never overwrite each
other; marts carrying ``source_system`` are partitioned by it.

``publish_run`` replaces a folder's marts as a whole: a run writes tables of
its own, and only when all are written does it add a manifest that names
them.  Readers follow the newest manifest, so they see the marts of one run,
the old or the new one, whatever becomes of a run half-way.

Facts are written in the order of their date within each file.  A row
group's smallest and largest date are then close together, and a report
with a date filter skips the other row groups.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimstar.session import runtime_filters, shared_folder
from dimstar.sources.catalog import SOURCE_COLUMNS, Sources, load_sources, reject_counts, typed


def run_folder(spark: SparkSession, kind: str) -> str:
    return shared_folder(spark, kind)


# Sensitivity split of the published marts: contact data and the activity
# fact (which carries contact keys) go to the private area, the rest to shared.
PUBLISH_AREA = {
    "dim_date": "shared",
    "dim_unified_account": "shared",
    "dim_unified_employee": "shared",
    "dim_unified_opportunity": "shared",
    "fct_blended_opportunities": "shared",
    "dim_unified_contact": "private",
    "fct_blended_opportunity_activities": "private",
}


# The date by which a fact's rows are ordered within its files.
CLUSTER_BY = {
    "fct_blended_opportunities": "opportunity_projected_close_date",
    "fct_blended_opportunity_activities": "activity_created_date",
}


def table_path(folder: str, name: str) -> str:
    """``folder/<area>/<name>`` for a mart, ``folder/<name>`` for anything else."""
    area = PUBLISH_AREA.get(name)
    return os.path.join(folder, area, name) if area else os.path.join(folder, name)


def _write(spark: SparkSession, df: DataFrame, name: str, path: str, row_group_bytes: int | None = None) -> DataFrame:
    parts = ["source_system"] if "source_system" in df.columns else []
    by = CLUSTER_BY.get(name)
    # The writer needs the partition column first; this order serves for both.
    writer = (df.sortWithinPartitions(*parts, by) if by in df.columns else df).write.mode("overwrite")
    if parts:
        writer = writer.partitionBy(*parts)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def write_tables(spark: SparkSession, frames: Mapping[str, DataFrame], names: Iterable[str] | None = None,
                 folder: str | None = None, row_group_bytes: int | None = None) -> dict[str, DataFrame]:
    """Write each frame as parquet (marts into their shared/private area); return them read back."""
    folder = folder or run_folder(spark, "publish")
    with runtime_filters(spark):
        return {name: _write(spark, frames[name], name, table_path(folder, name), row_group_bytes) for name in names or frames}


def write_counted(spark: SparkSession, frames: Mapping[str, DataFrame], names: Iterable[str] | None = None,
                  folder: str | None = None) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """``write_tables``, and the rows that each frame gave while it was written.

    The rows are observed as they leave the frame, before the writer has
    them: a count of the frame itself, without computing it a second time.
    """
    names = list(names or frames)
    seen = {n: Observation(f"rows of {n}") for n in names}
    counted = {n: frames[n].observe(seen[n], F.count(F.lit(1)).alias("n")) for n in names}
    tables = write_tables(spark, counted, names, folder)
    return tables, {n: seen[n].get["n"] for n in names}


MANIFESTS = "_manifests"


def _files(spark: SparkSession, folder: str):
    """Hadoop's file system of a folder, and the class of its paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def manifests(spark: SparkSession, folder: str) -> list[str]:
    """The names of a folder's manifests, the oldest first."""
    fs, path = _files(spark, folder)
    at = path(os.path.join(folder, MANIFESTS))
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(n for n in names if n.endswith(".json"))


def publish_run(spark: SparkSession, frames: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Write all frames as a run of their own, then make that run the folder's current one.

    The manifest appears under its name by a rename, when every table is
    there.  A run that fails leaves the manifests, and so what readers see,
    as they were.
    """
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    out = write_tables(spark, frames, folder=os.path.join(folder, "runs", run))
    tables = {name: os.path.relpath(table_path(os.path.join(folder, "runs", run), name), folder) for name in frames}
    fs, path = _files(spark, folder)
    hidden, named = (path(os.path.join(folder, MANIFESTS, n)) for n in (f"_{run}.tmp", f"{run}.json"))
    stream = fs.create(hidden, False)
    stream.write(bytearray(json.dumps({"run": run, "tables": tables}).encode()))
    stream.close()
    if not fs.rename(hidden, named):
        raise OSError(f"the manifest {named} can't be put in place")
    return out


def published(spark: SparkSession, folder: str, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The tables of the folder's current run; without any manifest, tables written by ``write_tables``."""
    known = manifests(spark, folder)
    if not known:
        return {n: spark.read.parquet(table_path(folder, n)) for n in names or PUBLISH_AREA}
    lines = spark.read.text(os.path.join(folder, MANIFESTS, known[-1]), wholetext=True).first()[0]
    tables = json.loads(lines)["tables"]
    return {n: spark.read.parquet(os.path.join(folder, tables[n])) for n in names or tables}


def expire_runs(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Remove all runs but the newest ``keep`` published ones; return their names.

    Runs that are younger than the current one (another build may be writing
    them) stay.  A manifest goes before its tables.
    """
    known = [n.removesuffix(".json") for n in manifests(spark, folder)]
    fs, path = _files(spark, folder)
    runs = path(os.path.join(folder, "runs"))
    if not known or not fs.exists(runs):
        return []
    gone = [f.getPath().getName() for f in fs.listStatus(runs)]
    gone = sorted(r for r in gone if r not in known[-keep:] and r < known[-1])
    for run in gone:
        fs.delete(path(os.path.join(folder, MANIFESTS, f"{run}.json")), False)
        fs.delete(path(os.path.join(folder, "runs", run)), True)
    return gone


def stage_sources(spark: SparkSession, src: Sources, folder: str | None = None, parallel: int = 8,
                  row_group_bytes: int | None = None) -> Sources:
    """Land the sources as tables (one folder each) and return them read back.

    The writes are independent jobs; they are submitted together so the
    scheduler can run them side by side on free executor slots.
    ``row_group_bytes`` asks the writer for row groups of another size (a
    reader splits a file only at row-group boundaries, so small test tables
    need small ones to be read by several tasks).
    """
    folder = folder or run_folder(spark, "sources")

    def write(item):
        name, df = item
        writer = df.write.mode("overwrite")
        if row_group_bytes:
            writer = writer.option("parquet.block.size", row_group_bytes)
        writer.parquet(os.path.join(folder, name))

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        list(pool.map(write, src.items()))
    return load_sources(spark, folder)


def stage_extracts(spark: SparkSession, root: str, folder: str | None = None, fmt: str = "parquet",
                   parallel: int = 8) -> tuple[Sources, list[tuple[str, str, int]]]:
    """Land extracts as typed tables, and count the values that can't be read as their type on the way.

    Each extract is read once: the counts are observed while its table is
    written.  Returns the sources read back, and (source, column, rejected)
    for the columns with any.
    """
    folder = folder or run_folder(spark, "sources")

    def write(name: str) -> list[tuple[str, str, int]]:
        raw = spark.read.format(fmt).load(f"{root}/{name}")
        counts, seen = reject_counts(name, raw), Observation(f"rejects of {name}")
        frame = raw.observe(seen, *[c.alias(n) for n, c in counts.items()]) if counts else raw
        typed(name, frame).write.mode("overwrite").parquet(os.path.join(folder, name))
        return [(name, c, n) for c, n in (seen.get if counts else {}).items() if n]

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        found = [r for rows in pool.map(write, SOURCE_COLUMNS) for r in rows]
    return load_sources(spark, folder), found


def register_views(frames: Mapping[str, DataFrame], suffix: str = "") -> dict[str, str]:
    """Register each frame as a temporary view ``<name><suffix>`` for ad-hoc ``spark.sql``; return the names."""
    names = {}
    for name, df in frames.items():
        view = f"{name}{suffix}"
        df.createOrReplaceTempView(view)
        names[name] = view
    return names
