"""Business rules as Column expressions.

Every rule is a first-match chain of built-in predicates; long label lists
become ``isin`` (planned as a hash set), so each rule compiles into the
surrounding whole-stage code instead of needing a lookup join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimstar.functions.columns import blank_to_null, first_match, mail_domain, seconds_between

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
# ---------------------------------------------------------------------------

# Source-system tags, per output.
PIPELINE_EDH = "EDH_SFDC"
PIPELINE_ACS = "ACS_SFDC"
DIM_EDH = "EDH"
DIM_ACS = "ACS"
ACTIVITY_EDH = "EDH"
ACTIVITY_ACS = "Construction"
ACS_FOCUS_SEGMENT_GROUP = "Emerging Tech"
ACS_FOCUS_SEGMENT = "Construction"

# Account eligibility for the pipeline.
ELIGIBLE_ACCOUNT_TYPES = ("End Customer", "Strategic Account", "Government", "A.D.N.")
EXCLUDED_ACCOUNT_CATEGORIES = ("Internal", "Partner")
PARTNER_ACCOUNT_TYPES = ("Distributor", "Reseller")
LOST_REASON_EXCLUDED = "Migrated to ENT"
OPPORTUNITY_TYPE_UNIFIED = "UnifiedOpportunity"
SEGMENT_TERRITORY_GROUPS = ("Territory", "Individual", "Unknown")

# Stage spellings.
STAGE_LOST = ("0-Closed/Lost", "Closed/Lost", "Closed", "Closed Lost", "--None--")
STAGE_WON = ("Won", "5-Closed/Won")
STAGE_WON_ACS_ONLY = ("Booked", "Closed Won", "Console Add-On")
STAGE_1 = ("Stage 1", "Stage1", "1-Prospecting")
STAGE_2 = ("Stage 2", "Stage2", "2-Qualifying")
STAGE_3 = ("Stage 3", "Stage3", "3-Solution Building")
STAGE_4 = ("Stage 4", "4-Proposal/Negotiation")
STAGE_5 = ("Stage 5",)
# (normalised label, rank, weight) per open/won stage group.
STAGE_STEPS = (
    (STAGE_1, "Stage 1", 1, "0.10"),
    (STAGE_2, "Stage 2", 2, "0.20"),
    (STAGE_3, "Stage 3", 3, "0.30"),
    (STAGE_4, "Stage 4", 4, "0.50"),
    (STAGE_5, "Stage 5", 5, "0.80"),
)
WON_LABEL, WON_RANK, WON_WEIGHT = "Won", 6, "1.00"
LOST_LABEL = "Closed/Lost"
OTHER_RANK, OTHER_WEIGHT = 0, "0.00"

# Partner-led tag phrases (lower case, contained anywhere).
PARTNER_LED_PHRASES = ("partner led", "led by partner")

# EDH activity type: subject / description phrases for untyped tasks.
EDH_SUBJECT_CALL = "sub-call"
EDH_SUBJECT_EMAIL = "inmail"
EDH_DESCRIPTION_EMAIL = ("external email", "email sent successfully")
EDH_REPLY_SUBTYPE = "Email - Response Received"
EDH_CALL_TYPES = ("Call", "Scheduled Call")
EDH_KEPT_TYPES = ("Chat", "Social", "Update")
BOUNCED = "Email - Bounced"

# Construction activity type: labels per type for TASK_SUBTYPE = 'Task',
# in priority order (an earlier list wins for a label in two lists).
ACS_CALL_TYPES = ("Call", "Connected Call")
ACS_EMAIL_LABELS = (
    "Email", "Email - Sent", "Email - Response Received",
    "Email - Engaged with Partner", "Email - Bounced",
)
ACS_MEETING_LABELS = (
    "Meeting", "Meeting completed", "Meeting scheduled",
    "Meeting missed / rescheduled", "Intro Meeting",
    "Follow-Up Meeting - Demo", "Follow-Up Meeting - Discovery",
    "New Key Contact Meeting", "Set Appointment",
    "Discovery/Demo Held", "Discovery/Demo Scheduled", "Demo Held",
)
ACS_MEETING_WORD = "meeting"
ACS_SOCIAL_PREFIX = "linkedin:"
ACS_SOCIAL_LABELS = ("Sent Message", "Sent Connect Request", "Connect Accepted", "Message Responded")
ACS_CALL_LABELS = (
    "Connected", "Connected Call", "Left Message", "Left Voicemail",
    "No Answer", "No answer, no vm", "No Response", "Abandoned",
    "Discovery Call", "Discovery Held", "Discovery/Demo Held", "Discovery/Demo Scheduled",
    "Connected, Decision maker/influencer", "Connected, Non Decision Maker",
    "Connected, business conversation", "Contacted", "Transitioned to Call", "First Call",
    "Invalid Number", "Invalid Phone Number", "Invalid Contact",
    "Incorrect/Invalid Phone Number", "Wrong Number", "Disconnected",
    "Contact no longer with company", "Not Decision Maker", "Gatekeeper",
    "Customer Not Interested", "No Business Need", "Competitor",
    "Interest but no budget", "No Budget", "No Buying Timeframe",
    "Information Requested", "Information (Quote/Pricing/Product) Requested",
    "Quote Requested", "Quote Sent", "Requested Pricing", "Requested Product Info",
    "Sales Conversation", "Sales - Handoff", "Sales Handoff",
    "Handoff to Different Sales Group", "Engaged with partner", "Referred to partner",
    "Support", "Support Case", "Support Account Management & Orders",
    "Transfer to Support", "Education", "Renewals",
    "Purchased", "Already Purchased", "Closed/Won", "Cart link sent",
    "Opportunity Update", "Demo", "Prospect Task",
    "Do Not Contact", "Partners/Vendors", "Invalid",
)
ACS_TASK_LABELS = (
    "Action Item", "Other", "Fallback", "Account Task", "Collaboration Task",
    "Pipeline Task", "Project Task", "Project Team Recon", "Account Support",
    "SOF Processing", "Re-Engage w/ Key Contact",
)
ACS_KEPT_SUBTYPES = ("Chat", "Social", "Update", "ListEmail", "Cadence")

# Direction labels.
EDH_OUTBOUND_SUBTYPES = ("Email - Sent", "Email - Engaged with Partner")
EDH_INBOUND_SUBTYPE = "Email - Response Received"
ACS_OUTBOUND_TYPES = ("Email - Sent", "Email - Engaged with Partner")
ACS_INBOUND_TYPE = "Email - Response Received"
PARTNER_ACTIVITY_LABELS = ("Engaged with partner", "Email - Engaged with Partner")

# Activity groups.
GROUP_PARTNER = "Partner Activity"
GROUP_INTERNAL = "Internal Activity"
GROUP_CUSTOMER = "Customer Activity"

# KPI flag label lists.
EDH_CONNECTED_SUBTYPES = (
    "Connected", "Connected, Decision maker/influencer",
    "Connected, business conversation", "Connected, Non Decision Maker",
    "Discovery call", "Customer Not Interested",
)
ACS_CONNECTED_OUTCOMES = (
    "Qualified", "Answered - Leave in Sequence (CS ONLY)", "Gate Keeper - Follow Up",
    "No Timeline", "No Authority", "Open S2+ Opportunity", "Prospect Refused To Talk",
    "Sales - Working", "No Budget", "Uses Competitor", "Follow up within 30 Days",
    "Active License",
)
EDH_MEETING_SCHEDULED_SUBTYPE = "Meeting scheduled"
ACS_MEETING_SCHEDULED_TYPES = ("Meeting scheduled", "Set Appointment", "Discovery/Demo Scheduled")
EDH_MEETING_COMPLETED_SUBTYPES = ("Meeting completed", "Discovery/Demo Held", "Demo Held")
ACS_MEETING_COMPLETED_TYPES = (
    "Meeting completed", "Discovery/Demo Held", "Demo Held", "Demo",
    "Discovery Call", "Discovery Held",
)

# ---------------------------------------------------------------------------
# Stage rules
# ---------------------------------------------------------------------------


def _won_labels(acs: bool) -> tuple[str, ...]:
    return STAGE_WON + (STAGE_WON_ACS_ONLY if acs else ())


def stage_label(raw: Column, acs: bool = False) -> Column:
    """Normalised stage; unknown spellings pass through unchanged."""
    rules = [(raw.isin(*STAGE_LOST), LOST_LABEL), (raw.isin(*_won_labels(acs)), WON_LABEL)]
    rules += [(raw.isin(*labels), name) for labels, name, _, _ in STAGE_STEPS]
    return first_match(rules, raw)


def stage_rank(raw: Column, acs: bool = False) -> Column:
    rules = [(raw.isin(*labels), rank) for labels, _, rank, _ in STAGE_STEPS]
    rules.append((raw.isin(*_won_labels(acs)), WON_RANK))
    return first_match(rules, OTHER_RANK)


def stage_weight(raw: Column, acs: bool = False) -> Column:
    """Probability weight as decimal(3,2); 0.00 for lost, unknown and NULL."""
    rules = [(raw.isin(*labels), F.lit(w).cast("decimal(3,2)")) for labels, _, _, w in STAGE_STEPS]
    rules.append((raw.isin(*_won_labels(acs)), F.lit(WON_WEIGHT).cast("decimal(3,2)")))
    return first_match(rules, F.lit(OTHER_WEIGHT).cast("decimal(3,2)"))


def is_partner_led(tags: Column) -> Column:
    low = F.lower(tags)
    hit = None
    for phrase in PARTNER_LED_PHRASES:
        cond = low.contains(phrase)
        hit = cond if hit is None else (hit | cond)
    return F.when(hit, F.lit("Yes")).otherwise(F.lit("No"))


def account_segment(named_group: Column) -> Column:
    return F.when(named_group.isin(*SEGMENT_TERRITORY_GROUPS), F.lit("Territory")).otherwise(named_group)


def eligible_account(account_type: Column, is_visible: Column, category: Column) -> Column:
    """P5: account type, visibility and a NULL-safe category exclusion."""
    return (
        account_type.isin(*ELIGIBLE_ACCOUNT_TYPES)
        & (is_visible == 1)
        & ~F.coalesce(category, F.lit("")).isin(*EXCLUDED_ACCOUNT_CATEGORIES)
    )


# ---------------------------------------------------------------------------
# Activity rules
# ---------------------------------------------------------------------------


def edh_activity_type(sales_type: Column, task_subtype: Column, sales_subtype: Column,
                      subject: Column, description: Column) -> Column:
    """R12, reduced: a typed task decides by its type; an untyped 'Task' by text cues."""
    t = blank_to_null(sales_type)
    untyped_task = (task_subtype == "Task") & t.isNull()
    low_subject, low_desc = F.lower(subject), F.lower(description)
    return first_match(
        [
            (t.isin(*EDH_CALL_TYPES), "Call"),
            (t == "Email", "Email"),
            (t == "Meeting", "Meeting"),
            (t.isin(*EDH_KEPT_TYPES), F.trim(sales_type)),
            (untyped_task & (sales_subtype == EDH_REPLY_SUBTYPE), "Email"),
            (untyped_task & low_subject.contains(EDH_SUBJECT_CALL), "Call"),
            (untyped_task & low_subject.contains(EDH_SUBJECT_EMAIL), "Email"),
            (untyped_task & (low_desc.contains(EDH_DESCRIPTION_EMAIL[0])
                             | low_desc.contains(EDH_DESCRIPTION_EMAIL[1])), "Email"),
        ],
        F.coalesce(blank_to_null(task_subtype), F.lit("Task")),
    )


def edh_direction(sales_type: Column, task_subtype: Column, sales_subtype: Column,
                  task_type: Column) -> Column:
    t = blank_to_null(sales_type)
    sub = F.trim(sales_subtype)
    return first_match(
        [
            (sub.isin(*EDH_OUTBOUND_SUBTYPES), "Outbound"),
            (sub == EDH_INBOUND_SUBTYPE, "Inbound"),
            (t.isin(*EDH_CALL_TYPES) | (task_subtype == "Call"), "Outbound"),
            ((t == "Email") & (task_type == "Inbound"), "Inbound"),
            ((t == "Email") & blank_to_null(sales_subtype).isNull()
             & task_subtype.isin("Email", "ListEmail"), "Outbound"),
        ],
        sub,
    )


def activity_group(partner_label: Column, account_type: Column, email: Column,
                   tenant_pattern: str | None) -> Column:
    """Partner first, then the tenant's own mail domain (None: nothing is internal), else customer."""
    rules = [(partner_label.isin(*PARTNER_ACTIVITY_LABELS) | account_type.isin(*PARTNER_ACCOUNT_TYPES), GROUP_PARTNER)]
    if tenant_pattern:
        rules.append((email.isNotNull() & mail_domain(email).contains(tenant_pattern.lower()), GROUP_INTERNAL))
    return first_match(rules, GROUP_CUSTOMER)


def construction_activity_type(task_type: Column, task_subtype: Column) -> Column:
    """The task's own type first, then the sub-type, then label lists for 'Task'."""
    t = blank_to_null(task_type)
    low_t = F.lower(t)
    is_task = task_subtype == "Task"
    return first_match(
        [
            (t.isin(*ACS_CALL_TYPES), "Call"),
            (t == "Email", "Email"),
            (t == "Meeting", "Meeting"),
            (task_subtype.isin("Email", "Call", "Meeting"), task_subtype),
            (is_task & t.isin(*ACS_EMAIL_LABELS), "Email"),
            (is_task & (t.isin(*ACS_MEETING_LABELS) | low_t.contains(ACS_MEETING_WORD)), "Meeting"),
            (is_task & (low_t.startswith(ACS_SOCIAL_PREFIX) | t.isin(*ACS_SOCIAL_LABELS)), "Social"),
            (is_task & t.isin(*ACS_CALL_LABELS), "Call"),
            (is_task & t.isin(*ACS_TASK_LABELS), "Task"),
            (blank_to_null(task_subtype).isin(*ACS_KEPT_SUBTYPES), task_subtype),
        ],
        F.coalesce(blank_to_null(task_subtype), F.lit("Task")),
    )


def construction_direction(task_type: Column, task_subtype: Column, call_type: Column) -> Column:
    t = blank_to_null(task_type)
    call_dir = F.coalesce(call_type, F.lit("Outbound"))
    return first_match(
        [
            ((task_subtype == "Email") | t.isin(*ACS_OUTBOUND_TYPES), "Outbound"),
            (t == ACS_INBOUND_TYPE, "Inbound"),
            (task_subtype == "Call", call_dir),
            (t.isin(*ACS_CALL_TYPES), call_dir),
            (task_subtype == "ListEmail", "Outbound"),
        ],
        F.lit(None).cast("string"),
    )


def call_disposition(new_type: Column, call_outcome: Column, cadence_sub: Column) -> Column:
    return F.when(new_type == "Call", F.coalesce(call_outcome, cadence_sub))


def call_duration(new_type: Column, source_seconds: Column, created: Column,
                  completed: Column) -> Column:
    """Non-zero source duration (truncated), else positive completed - created."""
    measured = F.when(
        completed.isNotNull() & created.isNotNull() & (completed > created),
        seconds_between(created, completed).cast("int"),
    )
    return F.when(new_type == "Call", F.coalesce(F.nullif(source_seconds, F.lit(0.0)).cast("int"), measured))


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def kpi_flags(new_type: Column, direction: Column, group: Column, system: Column,
              cadence_sub: Column, call_outcome: Column, task_type: Column) -> dict[str, Column]:
    """R19-R24 as 0/1 integer columns."""
    customer = group == GROUP_CUSTOMER
    edh, acs = system == ACTIVITY_EDH, system == ACTIVITY_ACS
    attempt = (new_type == "Call") & (direction == "Outbound") & customer
    connected = attempt & (
        (edh & cadence_sub.isin(*EDH_CONNECTED_SUBTYPES))
        | (acs & call_outcome.isin(*ACS_CONNECTED_OUTCOMES))
    )
    scheduled = (new_type == "Meeting") & customer & (
        (edh & (direction == "Outbound") & (cadence_sub == EDH_MEETING_SCHEDULED_SUBTYPE))
        | (acs & task_type.isin(*ACS_MEETING_SCHEDULED_TYPES))
    )
    completed = new_type.isin("Meeting", "Call") & (
        (edh & cadence_sub.isin(*EDH_MEETING_COMPLETED_SUBTYPES))
        | (acs & task_type.isin(*ACS_MEETING_COMPLETED_TYPES))
    )
    return {
        "call_attempt_outbound": _flag(attempt),
        "call_connected_outbound": _flag(connected),
        "meeting_scheduled": _flag(scheduled),
        "meeting_completed": _flag(completed),
        "email_attempt_outbound": _flag((new_type == "Email") & (direction == "Outbound") & customer),
        "email_received": _flag((new_type == "Email") & (direction == "Inbound") & customer),
    }
