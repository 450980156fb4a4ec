"""Command line: build (marts + data tests) and metric query over the published marts."""

import json
import os
import tempfile

import pytest
from conftest import SF_SMALL
from dimstar import cli
from dimstar.plans.saved import load_saved


def test_build_then_query(spark, capsys):
    out = tempfile.mkdtemp(prefix="dimstar-cli-")
    marts = os.path.join(out, "marts")
    # F1 keeps ACS rows without an opportunity number (error-severity not_null fails), as in the reference.
    assert cli.main(["build", "--master", "local[2]", "--fixture", "--sources", SF_SMALL, "--out", marts]) == 1
    printed = capsys.readouterr().out
    assert "FAIL fct_blended_opportunities_opportunity_number_not_null" in printed
    assert "PASS dim_unified_account_account_csn_unique" in printed
    assert os.path.isdir(os.path.join(marts, "dq_failure_log"))
    result = os.path.join(out, "result")
    assert cli.main(["query", "--master", "local[2]", "--marts", marts, "--metrics",
                     "total_activities,call_connect_rate", "--group-by", "source_system,metric_time__week",
                     "--order-by=-total_activities", "--output", result]) == 0
    df = spark.read.parquet(result)
    assert df.columns == ["source_system", "metric_time__week", "total_activities", "call_connect_rate"]
    assert df.count() > 0

    adhoc = os.path.join(out, "adhoc")
    assert cli.main(["sql", "--master", "local[2]", "--marts", marts, "--output", adhoc,
                     "SELECT source_system, count(*) AS n FROM fct_blended_opportunity_activities GROUP BY 1"]) == 0
    got = {r["source_system"]: r["n"] for r in spark.read.parquet(adhoc).collect()}
    assert set(got) == {"EDH", "Construction"} and all(v > 0 for v in got.values())

    # A saved query of the library, and one of a definitions file.
    kept = os.path.join(out, "saved")
    assert cli.main(["saved", "--master", "local[2]", "--marts", marts, "--output", kept, "quarterly_pipeline"]) == 0
    df = spark.read.parquet(kept)
    assert df.columns[:2] == ["metric_time__quarter", "account__account_segment"] and df.count() > 0
    file = os.path.join(out, "saved.json")
    with open(file, "w") as f:
        json.dump([{"name": "mine", "metrics": ["total_activities", "opportunity_count"], "group_by": ["source_system"],
                    "order_by": ["source_system"]}], f)
    mine = os.path.join(out, "mine")
    assert cli.main(["saved", "--master", "local[2]", "--marts", marts, "--definitions", file, "--output", mine, "mine"]) == 0
    by_system = {r["source_system"]: r["total_activities"] for r in spark.read.parquet(mine).collect()}
    # One row per activity; the facts name their systems differently, so those of the other fact have no activities.
    assert {k: v for k, v in by_system.items() if v is not None} == got
    assert cli.main(["saved", "--master", "local[2]", "--marts", marts, "nobody"]) == 2
    assert "quarterly_pipeline" in capsys.readouterr().err


@pytest.mark.parametrize("item, said", [
    ({"metrics": []}, "no metrics"),
    ({"metrics": ["total_pipeline"]}, "unknown metrics total_pipeline"),
    ({"metrics": "total_activities"}, "must be a list"),
    ({"metrics": ["total_activities"], "order_by": ["-call_connect_rate"]}, "does not return"),
    ({"metrics": ["total_activities"], "groupby": []}, "unknown fields groupby"),
])
def test_saved_definitions_are_checked(spark, tmp_path, item, said):
    file = tmp_path / "saved.json"
    file.write_text(json.dumps([{"name": "q", **item}]))
    with pytest.raises(ValueError, match=said):
        load_saved(spark, str(file))


def test_saved_definitions_replace(spark, tmp_path):
    file = tmp_path / "saved.json"
    file.write_text(json.dumps([{"name": "activity_scorecard", "metrics": ["total_activities"]}]))
    known = load_saved(spark, str(file))
    assert known["activity_scorecard"].metrics == ("total_activities",) and "quarterly_pipeline" in known


def test_list_metrics(capsys):
    assert cli.main(["list"]) == 0
    printed = capsys.readouterr().out
    assert "saved query quarterly_pipeline" in printed
    assert "pipeline_confidence_ratio" in printed and "ratio" in printed
    assert "partner_account (inactive)" in printed


def test_build_needs_a_tenant(capsys):
    with pytest.raises(SystemExit):
        cli.main(["build", "--sources", "nowhere", "--out", "nowhere"])
    assert "--tenant" in capsys.readouterr().err
