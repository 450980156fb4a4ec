"""Rule tables (FIXTURES.md part D): every arm, order conflicts, blanks and NULLs."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from dimstar.functions import rules as R
from dimstar.functions.columns import mail_domain, parse_flag, seconds_between


def _trim(x):
    return None if x is None else x.strip(" ")


def _nullif_blank(x):
    t = _trim(x)
    return None if t in (None, "") else t


def _has(x, p):
    return x is not None and p in x.lower()


def edh_type_full(sat, s, sas, subj, desc):
    """The 14 arms written out in order (test oracle for the reduced form)."""
    t = _nullif_blank(sat)
    if s == "Task" and t == "Call":
        return "Call"
    if s == "Call" and t == "Meeting":
        return "Meeting"
    if s == "Task" and t == "Email":
        return "Email"
    if s == "Task" and t is None and sas == "Email - Response Received":
        return "Email"
    if s == "Task" and t is None and _has(subj, "sub-call"):
        return "Call"
    if s == "Task" and t is None and _has(subj, "inmail"):
        return "Email"
    if s == "Task" and t is None and _has(desc, "external email"):
        return "Email"
    if s == "Task" and t is None and _has(desc, "email sent successfully"):
        return "Email"
    if s == "Task" and t in ("Chat", "Meeting", "Social", "Update"):
        return _trim(sat)
    if t in ("Call", "Scheduled Call"):
        return "Call"
    if t == "Email":
        return "Email"
    if t == "Meeting":
        return "Meeting"
    if t in ("Chat", "Social", "Update"):
        return _trim(sat)
    return _nullif_blank(s) or "Task"


def test_edh_activity_type_reduced_equals_full_arms(spark):
    grid = list(itertools.product(
        [" Call ", "Scheduled Call", "Email", "Meeting", "Chat", " Social", "Update", "", None, "Webinar"],
        ["Task", "Call", "Email", "ListEmail", None, " Task", ""],
        ["Email - Response Received", "Connected", None],
        ["x SUB-CALL", "InMail", None, "other"],
        ["External email", "email sent successfully", None],
    ))
    df = spark.createDataFrame(grid, "sat string, s string, sas string, subj string, descr string")
    got = df.select("*", R.edh_activity_type(F.col("sat"), F.col("s"), F.col("sas"), F.col("subj"),
                                             F.col("descr")).alias("t")).collect()
    assert len(got) == len(grid)
    for r in got:
        assert r["t"] == edh_type_full(r["sat"], r["s"], r["sas"], r["subj"], r["descr"]), r


def acs_type_full(tt, s):
    t = _nullif_blank(tt)
    low = t.lower() if t is not None else None
    if t in ("Call", "Connected Call"):
        return "Call"
    if t == "Email":
        return "Email"
    if t == "Meeting":
        return "Meeting"
    if s in ("Email", "Call", "Meeting"):
        return s
    if s == "Task" and t in R.ACS_EMAIL_LABELS:
        return "Email"
    if s == "Task" and (t in R.ACS_MEETING_LABELS or (low is not None and "meeting" in low)):
        return "Meeting"
    if s == "Task" and ((low is not None and low.startswith("linkedin:")) or t in R.ACS_SOCIAL_LABELS):
        return "Social"
    if s == "Task" and t in R.ACS_CALL_LABELS:
        return "Call"
    if s == "Task" and t in R.ACS_TASK_LABELS:
        return "Task"
    if _nullif_blank(s) in ("Chat", "Social", "Update", "ListEmail", "Cadence"):
        return s
    return _nullif_blank(s) or "Task"


def test_construction_activity_type_every_label(spark):
    labels = (R.ACS_EMAIL_LABELS + R.ACS_MEETING_LABELS + R.ACS_SOCIAL_LABELS + R.ACS_CALL_LABELS
              + R.ACS_TASK_LABELS + ("Call", "Connected Call", " Chat ", "LinkedIn: note", "Weekly MEETING",
                                     "Follow up", "", None))
    subtypes = ["Task", "Call", "Email", "Meeting", "Chat ", " Update", "Cadence", "ListEmail", "", None]
    grid = list(itertools.product(labels, subtypes))
    df = spark.createDataFrame(grid, "tt string, s string")
    got = df.select("*", R.construction_activity_type(F.col("tt"), F.col("s")).alias("t")).collect()
    for r in got:
        assert r["t"] == acs_type_full(r["tt"], r["s"]), r
    # Labels in two lists: the meeting list wins.
    d = {(r["tt"], r["s"]): r["t"] for r in got}
    assert d[("Discovery/Demo Held", "Task")] == "Meeting"
    assert d[("Discovery/Demo Scheduled", "Task")] == "Meeting"
    # Kept sub-type is returned untrimmed.
    assert d[("Follow up", "Chat ")] == "Chat "


def test_stage_rules(spark):
    raw = list(R.STAGE_LOST + R.STAGE_WON + R.STAGE_WON_ACS_ONLY + R.STAGE_1 + R.STAGE_2 + R.STAGE_3
               + R.STAGE_4 + R.STAGE_5) + ["Stage4", "Mystery", None]
    df = spark.createDataFrame([(x,) for x in raw], "s string")
    out = {r["s"]: r for r in df.select(
        "s",
        R.stage_label(F.col("s")).alias("edh"), R.stage_label(F.col("s"), acs=True).alias("acs"),
        R.stage_rank(F.col("s")).alias("edh_rank"), R.stage_rank(F.col("s"), acs=True).alias("acs_rank"),
        R.stage_weight(F.col("s")).cast("string").alias("edh_w"),
        R.stage_weight(F.col("s"), acs=True).cast("string").alias("acs_w"),
    ).collect()}
    assert out["Closed Lost"]["edh"] == "Closed/Lost" and out["Closed Lost"]["edh_rank"] == 0
    assert out["Stage1"]["edh"] == "Stage 1" and out["Stage1"]["edh_w"] == "0.10"
    assert out["4-Proposal/Negotiation"]["edh_rank"] == 4 and out["4-Proposal/Negotiation"]["edh_w"] == "0.50"
    # Stage4 is not a known spelling (trap 16).
    assert out["Stage4"]["edh"] == "Stage4" and out["Stage4"]["edh_rank"] == 0 and out["Stage4"]["edh_w"] == "0.00"
    # ACS-only won labels.
    assert out["Booked"]["edh"] == "Booked" and out["Booked"]["edh_rank"] == 0
    assert out["Booked"]["acs"] == "Won" and out["Booked"]["acs_rank"] == 6 and out["Booked"]["acs_w"] == "1.00"
    assert out["Mystery"]["acs"] == "Mystery"
    assert out[None]["edh"] is None and out[None]["edh_rank"] == 0 and out[None]["edh_w"] == "0.00"


def test_mail_domain_and_flags(spark):
    mails = ["User@ACME.com", "a@b@x.example", "noat", "", None]
    df = spark.createDataFrame([(m,) for m in mails], "m string")
    got = {r["m"]: r["d"] for r in df.select("m", mail_domain(F.col("m")).alias("d")).collect()}
    assert got == {"User@ACME.com": "acme.com", "a@b@x.example": "b@x.example", "noat": "noat", "": "", None: None}

    vals = ["1", "0", "Y", "n", " Yes ", "FALSE", "maybe", None, " y "]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = {r["v"]: r["f"] for r in df.select("v", parse_flag(F.col("v")).alias("f")).collect()}
    assert got == {"1": True, "0": False, "Y": True, "n": False, " Yes ": True, "FALSE": False, "maybe": None,
                   None: None, " y ": True}


def test_call_duration_and_disposition(spark):
    base = dt.datetime(2024, 1, 15, 10, 0, 0, 900000)
    rows = [
        ("Call", 0.0, base, base + dt.timedelta(seconds=30)),      # zero -> measured 30
        ("Call", 0.4, base, base + dt.timedelta(seconds=30)),      # 0.4 casts to 0, no fall-back (trap 13)
        ("Call", 59.9, base, None),                                # truncated to 59
        ("Call", None, base, base),                                # equal -> NULL
        ("Call", None, base, base + dt.timedelta(microseconds=200000)),  # .9 -> 1.1 crosses one boundary
        ("Call", None, base, base - dt.timedelta(seconds=5)),      # completed before -> NULL
        ("Email", 12.0, base, base + dt.timedelta(seconds=9)),     # not a call -> NULL
    ]
    df = spark.createDataFrame(rows, "nt string, dur double, c timestamp_ntz, d timestamp_ntz")
    got = [r["x"] for r in df.select(R.call_duration(F.col("nt"), F.col("dur"), F.col("c"), F.col("d")).alias("x"))
           .collect()]
    assert got == [30, 0, 59, None, 1, None, None]
    assert [r[0] for r in spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 900000),
                                                  dt.datetime(2024, 1, 1, 0, 0, 1, 100000))], "a timestamp_ntz, b timestamp_ntz")
            .select(seconds_between(F.col("a"), F.col("b"))).collect()] == [1]
    disp = spark.createDataFrame([("Call", None, "Connected"), ("Call", "Qualified", "x"), ("Email", "Qualified", "x")],
                                 "nt string, o string, c string")
    assert [r[0] for r in disp.select(R.call_disposition(F.col("nt"), F.col("o"), F.col("c"))).collect()] == \
        ["Connected", "Qualified", None]


def test_kpi_flags(spark):
    rows = [
        # new_type, direction, group, system, cadence_sub, outcome, task_type
        ("Call", "Outbound", "Customer Activity", "EDH", "Discovery call", None, None),
        ("Call", "Outbound", "Customer Activity", "EDH", "Discovery Call", None, None),  # case matters (trap 14)
        ("Call", "Outbound", "Customer Activity", "Construction", "Qualified", "Qualified", "Connected"),
        ("Call", "Inbound", "Customer Activity", "Construction", "Qualified", "Qualified", "Discovery Call"),
        ("Meeting", "Outbound", "Customer Activity", "EDH", "Meeting scheduled", None, None),
        ("Meeting", None, "Customer Activity", "Construction", None, None, "Set Appointment"),
        ("Meeting", None, "Partner Activity", "Construction", None, None, "Demo"),  # completed: no customer rule
        ("Email", "Outbound", "Customer Activity", "EDH", None, None, None),
        ("Email", "Inbound", "Customer Activity", "Construction", None, None, None),
        ("Email", "Inbound", "Internal Activity", "EDH", None, None, None),
    ]
    schema = "nt string, dir string, grp string, sys string, sub string, outc string, tt string"
    df = spark.createDataFrame(rows, schema)
    flags = R.kpi_flags(*[F.col(c) for c in ("nt", "dir", "grp", "sys", "sub", "outc", "tt")])
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in flags.items()]).collect()]
    # call_attempt, connected, scheduled, completed, email_out, email_in
    assert got == [
        (1, 1, 0, 0, 0, 0),
        (1, 0, 0, 0, 0, 0),
        (1, 1, 0, 0, 0, 0),
        (0, 0, 0, 1, 0, 0),
        (0, 0, 1, 0, 0, 0),
        (0, 0, 1, 0, 0, 0),
        (0, 0, 0, 1, 0, 0),
        (0, 0, 0, 0, 1, 0),
        (0, 0, 0, 0, 0, 1),
        (0, 0, 0, 0, 0, 0),
    ]
    # connected implies attempt
    for r in got:
        assert r[1] <= r[0]


@pytest.mark.parametrize("acs", [False, True])
def test_direction_rules(spark, acs):
    if not acs:
        rows = [("Call", "Task", " Email - Sent ", None, "Outbound"),
                (None, "Task", "Email - Response Received", None, "Inbound"),
                ("Meeting", "Call", "Meeting scheduled", None, "Outbound"),
                ("Email", "Email", None, "Inbound", "Inbound"),
                ("Email", "ListEmail", "", None, "Outbound"),
                ("Chat", "Task", " Connected ", None, "Connected")]
        df = spark.createDataFrame(rows, "sat string, s string, sas string, tt string, want string")
        got = df.select(R.edh_direction(F.col("sat"), F.col("s"), F.col("sas"), F.col("tt")).alias("d"), "want")
    else:
        rows = [("Email - Response Received", "Email", None, "Outbound"),
                ("Email - Response Received", "Task", None, "Inbound"),
                ("Connected", "Call", "Inbound", "Inbound"),
                (" Connected Call ", "Task", None, "Outbound"),
                ("Connected", "Task", None, None),  # typed Call through the label list: no direction (trap 10)
                ("x", "ListEmail", None, "Outbound")]
        df = spark.createDataFrame(rows, "tt string, s string, ct string, want string")
        got = df.select(R.construction_direction(F.col("tt"), F.col("s"), F.col("ct")).alias("d"), "want")
    for r in got.collect():
        assert r["d"] == r["want"]


def test_activity_group_without_a_tenant_word(spark):
    """Without a word no activity is internal; the empty word counts as none."""
    df = spark.createDataFrame([("Call", "End Customer", "a@acme.com"), ("Call", None, None)], "l string, a string, e string")
    for word, want in (("acme", ["Internal", "Customer"]), (None, ["Customer"] * 2), ("", ["Customer"] * 2)):
        got = [r[0] for r in df.select(R.activity_group(F.col("l"), F.col("a"), F.col("e"), word)).collect()]
        assert [g.split()[0] for g in got] == want, word
