"""Whole jobs: transitions, new disputes, review jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.checks import views
from ledgerflow.checks.job_tables import (
    actions,
    base_tables,
    map_tables,
    master_tables,
    mining_tables,
    queue_tables,
    review_sub,
    ticket_tables,
)
from ledgerflow.checks.operator_queries import (
    ENRICHED_SQL,
    WORKLIST_SQL,
    seed_rows,
    seed_tables,
)
from ledgerflow.checks.registry import check
from ledgerflow.checks.views import EVENT_NOW, ORDER_NOW, day_text, table, text, v_sub
from ledgerflow.config import JobConfig
from ledgerflow.functions import name_key
from ledgerflow.operators.conform import conform, existing
from ledgerflow.operators.filters import rejected

from ledgerflow.operators.validate import amount_rules, date_rules, validate
from ledgerflow.plans.dispute import nonseed_disputes, seed_disputes
from ledgerflow.plans.review import (
    audit_job,
    close_job,
    dispute_job,
    escalate_job,
    lv_job,
    map_job,
    note_job,
    other_job,
    paid_job,
    prov_job,
    ticket_job,
)
from ledgerflow.plans.run import error_return, review_folder, run_folder
from ledgerflow.plans.transitions import direct_actions, transition
from ledgerflow.sources.rowset import OTHER_VALUES
from ledgerflow.sources.sinks import error_records

CONFIG = JobConfig(note_day_limit=200, prov_note_days=14, lv_note_days=14)

# Parts of SQL text shared below.
NO_DISPUTE = "DSB_ID does not exist in Dispute Current"
AMOUNT = "WHEN bad_number THEN 'Amount_Or_Days is not numeric' WHEN bad_sign THEN 'Amount_Or_Days is <= 0'"
CREDIT = (
    "WHEN bad_date THEN 'Credit_Invoice_Date is not a date' "
    "WHEN bad_eom THEN 'Credit_Invoice_Date is not the end of the month' "
    "WHEN bad_past THEN 'Credit_Invoice_Date is in the past'"
)
CAP = "WHEN amount > 200 THEN 'DN max day cap is 200 day(s)'"
KNOWN = f"WHEN cur_id IS NULL THEN '{NO_DISPUTE}'"
EMAIL = "WHEN cur_type <> 'Email' THEN 'Dispute_Type is not Email for DSB_ID'"
STAFF = "WHEN full_name IS NULL THEN 'Comp_Serial does not exist'"
PRIOR = "WHEN old_dh IS NULL THEN 'DSB_ID has no prior version in Dispute History'"

views.SQL_VIEWS["v_act"] = (
    """
SELECT s.*, e.full_name, c.dsb_id AS cur_id, c.dispute_type AS cur_type,
       c.dispute_category AS cur_category,
       h.dh_id AS old_dh, h.dispute_reason AS old_reason, h.escalate AS old_escalate,
       h.dispute_category AS old_category
FROM v_num s LEFT JOIN v_emp e ON e.comp_serial = s.comp_serial
LEFT JOIN v_current c ON c.dsb_id = s.dsb_id LEFT JOIN v_history h ON h.dh_id = c.dh_id""",
    ("v_num", "v_emp", "v_current", "v_history"),
)
views.SQL_VIEWS["v_rev"] = (
    """
SELECT n.*, e.full_name, e.initials
FROM v_num n LEFT JOIN v_emp e ON e.comp_serial = n.comp_serial""",
    ("v_num", "v_emp"),
)
views.SQL_VIEWS["v_enriched"] = (ENRICHED_SQL, ("v_sub",))

JUDGED = {
    "Escalate": f"{KNOWN} {STAFF}",
    "Close": f"{KNOWN} {STAFF} {PRIOR}",
    "Paid": f"{AMOUNT} {CREDIT} {KNOWN} {STAFF} {PRIOR}",
    "Denied": f"{KNOWN} {EMAIL} {STAFF} {PRIOR}",
    "Approved": f"{AMOUNT} {KNOWN} {EMAIL} {STAFF} {PRIOR}",
    "Dispute Note": f"{KNOWN} {AMOUNT} {CAP} {STAFF}",
}
MOVED = {
    "status": "c.status",
    "display_status": "c.display_status",
    "n_escalations": "c.n_escalations",
    "dispute_reason": "NULL",
    "close_reason": "NULL",
    "credit_approved": "NULL",
    "credit_day": "NULL",
    "ilec_comments": "NULL",
    "last_action": "NULL",
    "last_rep": "NULL",
    "note": "NULL",
    "note_rep": "NULL",
    "note_days": "NULL",
    "dh_id": "c.dh_id",
    "dn_id": "NULL",
}
CHANGED = {
    "Escalate": {
        "display_status": "'Filed'",
        "n_escalations": "COALESCE(c.n_escalations, 0) + 1",
        "dispute_reason": "k.reason",
        "last_action": "'Filed'",
    },
    "Close": {
        "status": "'Closed'",
        "display_status": "'Denied - Closed'",
        "close_reason": "k.reason",
        "last_action": "'GRT Close'",
    },
    "Paid": {
        "status": "'Closed'",
        "display_status": "'Paid'",
        "credit_approved": "CAST(k.amount AS DOUBLE)",
        "credit_day": "strftime(k.day, '%Y-%m-%d')",
        "last_action": "'Paid'",
    },
    "Denied": {
        "display_status": "'Denied - Pending'",
        "ilec_comments": "k.reason",
        "last_action": "'Denied - Pending'",
    },
    "Approved": {
        "display_status": "'Approved'",
        "credit_approved": "CAST(k.amount AS DOUBLE)",
        "last_action": "'Approved'",
    },
    "Dispute Note": {
        "note": "k.reason",
        "note_rep": "CASE WHEN k.line_id % 3 = 0 THEN 'Boss' ELSE k.full_name END",
        "note_days": "CAST(k.amount AS INTEGER)",
        "dn_id": "k.key",
    },
}


def snapshot_sql(action: str) -> str:
    """The current state after one action, written out for DuckDB."""
    new = dict(CHANGED[action])
    if action != "Dispute Note":
        new |= {"last_rep": "k.full_name", "dh_id": "k.key"}
    columns = ",\n       ".join(
        f"CASE WHEN k.dsb_id IS NOT NULL THEN {new[c]} ELSE {old} END AS {c}" if c in new else f"{old} AS {c}"
        for c, old in MOVED.items()
    )
    return f"""
WITH j AS (SELECT *, CASE {JUDGED[action]} END AS err FROM v_act),
k AS (SELECT *, (SELECT MAX(o_orderkey) FROM orders) + ROW_NUMBER() OVER (ORDER BY line_id) AS key
      FROM j WHERE err IS NULL)
SELECT c.dsb_id, {columns}
FROM v_current c LEFT JOIN k ON k.dsb_id = c.dsb_id"""


def _state(df):
    """The columns of a snapshot that are compared; absent ones are null."""
    have = existing(df)
    wanted = {
        "status": "Status",
        "display_status": "Display_Status",
        "n_escalations": "#_Of_Escalations",
        "dispute_reason": "Dispute_Reason",
        "close_reason": "Close_Reason",
        "credit_approved": "Credit_Approved",
        "credit_day": "Credit_Received_Invoice_Date",
        "ilec_comments": "ILEC_Comments",
        "last_action": "Last_GRT_Action",
        "last_rep": "Last_GRT_Action_Rep",
        "note": "Dispute_Note",
        "note_rep": "Note_Assigned_To",
        "note_days": "Days_Till_Note_Review",
        "dh_id": "DH_ID",
        "dn_id": "DN_ID",
    }
    shape = {
        "credit_approved": lambda c: c.cast("double"),
        "credit_day": day_text,
    }
    return df.select(
        F.col("DSB_ID").alias("dsb_id"),
        *[
            (
                shape.get(name, lambda c: c)(F.col(source))
                if source.lower() in have
                else F.lit(None).cast("string")
            ).alias(name)
            for name, source in wanted.items()
        ],
    )


def _register_transition(name: str, action: str) -> None:
    @check(name, snapshot_sql(action), ("v_act", "v_current"))
    def query(spark, sf):
        tables = base_tables(spark, sf)
        step = transition(actions(spark, sf, action), tables, EVENT_NOW, [action], CONFIG)
        return _state(step.snapshot(tables["dispute_current"]))


for _name, _action in (
    ("escalate", "Escalate"),
    ("close", "Close"),
    ("paid", "Paid"),
    ("denied", "Denied"),
    ("approved", "Approved"),
    ("dispute_note", "Dispute Note"),
):
    _register_transition(_name, _action)

EVENT_ACTIONS = {
    "view": "Escalate",
    "signup": "Close",
    "error": "Denied",
    "click": "Approved",
    "purchase": "Paid",
}
_ERR_BY_ACTION = " ".join(
    f"WHEN action = '{event}' THEN CASE {JUDGED[name]} END" for event, name in EVENT_ACTIONS.items()
)
_NAME_BY_ACTION = " ".join(f"WHEN '{e}' THEN '{n}'" for e, n in EVENT_ACTIONS.items())


def _direct(spark, sf):
    tables = base_tables(spark, sf)
    named = F.create_map(*[F.lit(x) for pair in EVENT_ACTIONS.items() for x in pair])
    sub = actions(spark, sf).withColumn("Action", F.element_at(named, F.col("Action")))
    return direct_actions(sub, tables, EVENT_NOW, CONFIG)


@check(
    "direct_actions",
    f"""
WITH j AS (SELECT *, CASE {_ERR_BY_ACTION} END AS err, CASE action {_NAME_BY_ACTION} END AS act FROM v_act)
SELECT act AS action, err AS error_message, COUNT(*) AS n_rows FROM j GROUP BY act, err""",
    ("v_act",),
)
def q_direct_actions(spark, sf):
    result = _direct(spark, sf)
    return result.results.groupBy(
        F.col("Action").alias("action"), F.col("Error_Message").alias("error_message")
    ).agg(F.count("*").alias("n_rows"))


_PRIOR = "DSB_ID has no prior version in Dispute History"


@check(
    "direct_actions_snapshot",
    f"""
WITH j AS (SELECT *, CASE {_ERR_BY_ACTION} END AS err, CASE action {_NAME_BY_ACTION} END AS act,
             line_id % 4 = 0 AND cur_id IS NOT NULL AND full_name IS NOT NULL AS raised FROM v_act),
k AS (SELECT dsb_id, raised, act, CASE WHEN raised AND err = '{_PRIOR}' THEN NULL ELSE err END AS err FROM j)
SELECT c.dsb_id,
       CASE WHEN k.err IS NULL AND k.act IN ('Close', 'Paid') THEN 'Closed' ELSE c.status END AS status,
       CASE WHEN k.dsb_id IS NULL THEN c.display_status
            WHEN k.err IS NULL THEN CASE k.act WHEN 'Escalate' THEN 'Filed' WHEN 'Close' THEN 'Denied - Closed'
                 WHEN 'Denied' THEN 'Denied - Pending' ELSE k.act END
            WHEN k.raised THEN 'Filed' ELSE c.display_status END AS display_status
FROM v_current c LEFT JOIN k ON k.dsb_id = c.dsb_id""",
    ("v_act", "v_current"),
)
def direct_actions_snapshot(spark, sf):
    """Every fourth dispute is escalated too, under another spelling of its number."""
    tables = base_tables(spark, sf)
    named = F.create_map(*[F.lit(x) for pair in EVENT_ACTIONS.items() for x in pair])
    sub = actions(spark, sf).withColumn("Action", F.element_at(named, F.col("Action")))
    again = sub.filter((F.col("Line_ID") % 4 == 0) & (F.col("Action") != "Escalate")).withColumns(
        {
            "Action": F.lit("Escalate"),
            "DSB_ID": F.concat(F.lit("00"), "DSB_ID"),
            "Line_ID": -F.col("Line_ID") - 1,
        }
    )
    result = direct_actions(sub.unionByName(again), tables, EVENT_NOW, CONFIG)
    return result.snapshots["dispute_current"].select(
        F.col("DSB_ID").alias("dsb_id"),
        F.col("Status").alias("status"),
        F.col("Display_Status").alias("display_status"),
    )


@check(
    "direct_actions_history",
    f"""
WITH j AS (SELECT *, CASE {_ERR_BY_ACTION} END AS err, CASE action {_NAME_BY_ACTION} END AS act FROM v_act)
SELECT (SELECT MAX(o_orderkey) FROM orders) + ROW_NUMBER() OVER (ORDER BY line_id) AS dh_id, dsb_id,
       CASE act WHEN 'Escalate' THEN 'Filed' WHEN 'Close' THEN 'Denied - Closed' WHEN 'Denied'
            THEN 'Denied - Pending' ELSE act END AS display_status,
       CASE WHEN act = 'Escalate' THEN cur_category ELSE old_category END AS dispute_category,
       CASE WHEN act = 'Escalate' THEN 'Y' ELSE old_escalate END AS escalate,
       CASE WHEN act = 'Escalate' THEN reason ELSE old_reason END AS dispute_reason,
       CASE WHEN act IN ('Approved', 'Paid') THEN CAST(amount AS DOUBLE) END AS credit_approved,
       CASE WHEN act = 'Close' THEN reason END AS close_reason,
       CASE WHEN act IN ('Approved', 'Denied') THEN 'I' || CAST(line_id AS VARCHAR) END AS ilec_confirmation,
       full_name AS rep, 'GRT Status: 20240126' AS source_file
FROM j WHERE err IS NULL""",
    ("v_act",),
)
def direct_actions_history(spark, sf):
    history = _direct(spark, sf).appends["dispute_history"]
    return history.select(
        F.col("DH_ID").alias("dh_id"),
        F.col("DSB_ID").alias("dsb_id"),
        F.col("Display_Status").alias("display_status"),
        F.col("Dispute_Category").alias("dispute_category"),
        F.col("Escalate").alias("escalate"),
        F.col("Dispute_Reason").alias("dispute_reason"),
        F.col("Credit_Approved").cast("double").alias("credit_approved"),
        F.col("Close_Reason").alias("close_reason"),
        F.col("ILEC_Confirmation").alias("ilec_confirmation"),
        F.col("GRT_Update_Rep").alias("rep"),
        F.col("Source_File").alias("source_file"),
    )


MASTER_SQL = """
LEFT JOIN v_ban b ON b.ban = x.ban
  AND LAST_DAY(x.bill_day) BETWEEN LAST_DAY(b.start_date) AND LAST_DAY(COALESCE(b.end_date, DATE '{today}'))
LEFT JOIN nation bp ON bp.n_nationkey = b.platform_id
LEFT JOIN v_ban m ON m.id = COALESCE(x.master_id, b.id)
LEFT JOIN nation mp ON mp.n_nationkey = m.platform_id
LEFT JOIN region mv ON mv.r_regionkey = m.platform_id % 5"""


SEEDED_SQL = """
x AS (
  SELECT e.*, CAST(e.bill_date AS DATE) AS bill_day, p.full_name,
         CASE WHEN e.line_id % 10 = 5 THEN n.source_id ELSE CAST(e.line_id AS VARCHAR) END AS seed,
         CASE WHEN e.cost_type = 'MRC' THEN CAST(substr(e.source_id, 1) AS BIGINT) END AS master_id
  FROM v_enriched e JOIN v_num n ON n.line_id = e.line_id JOIN v_emp p ON p.comp_serial = n.comp_serial
  WHERE e.error_message IS NULL AND e.cost_type <> 'NONE' AND NOT n.bad_number AND NOT n.bad_sign),
y AS (
  SELECT x.*, (SELECT MAX(o_orderkey) FROM orders) + ROW_NUMBER() OVER (ORDER BY line_id) AS key,
         '20010810_' || left(record_type, 1) || seed AS claim,
         CAST(CAST(dispute_amt AS DECIMAL(19,4)) AS DOUBLE) AS amount
  FROM x)"""
SEEDED_VIEWS = ("v_enriched", "v_num", "v_emp", "v_ban")
SEEDED_PLATFORM = (
    "COALESCE(CASE WHEN x.platform = 'own' AND x.line_id % 2 = 0 THEN NULL ELSE x.platform END, bp.n_name)"
)


@check(
    "seed_disputes",
    f"""
WITH {SEEDED_SQL}
SELECT x.key AS dsb_id, x.claim, x.full_name, x.vendor, {SEEDED_PLATFORM} AS platform,
       mp.n_name AS norm_platform, mv.r_name AS norm_vendor,
       CASE WHEN x.line_id % 8 = 0 THEN 'Given' WHEN x.line_id % 5 = 0 THEN 'Filed'
            ELSE 'Pending Review' END AS display_status,
       x.amount AS dispute_amount
FROM y AS x {MASTER_SQL.format(today="2001-08-15")}""",
    SEEDED_VIEWS,
)
def q_seed_disputes(spark, sf):
    return _opened(_seeded(spark, sf))


def _seeded(spark, sf):
    n = F.col("Line_ID")
    amounts = v_sub(spark, sf).select(
        F.col("line_id").alias("Line_ID"), F.col("amount_txt").alias("Approved_Amt")
    )
    sub = (
        seed_rows(spark, sf)
        .join(amounts, "Line_ID")
        .withColumns(
            {
                "Platform": F.when(n % 2 != 0, F.col("Platform")),
                "Dispute_Type": F.when(n % 5 == 0, "Email").otherwise("STC"),
                "Dispute_Status": F.when(n % 8 == 0, "Given"),
            }
        )
    )
    tables = base_tables(spark, sf) | master_tables(spark, sf) | seed_tables(spark, sf)
    return seed_disputes(sub, tables, ORDER_NOW)


@check(
    "dispute_header",
    f"""
WITH {SEEDED_SQL}
SELECT x.key AS dsb_id, x.key AS orig_dh_id, x.claim, x.full_name AS disputer,
       CASE WHEN x.line_id % 5 = 0 THEN 'Email' ELSE 'STC' END AS dispute_type, x.vendor,
       {SEEDED_PLATFORM} AS platform, x.ban, x.bill_date, trim(x.usi) AS usi, x.amount AS dispute_amount,
       COALESCE(x.master_id, b.id) AS banmaster_id, x.source_tbl, x.source_id,
       '2001-08-15 12:00:00' AS edit_dt
FROM y AS x {MASTER_SQL.format(today="2001-08-15")}""",
    SEEDED_VIEWS,
)
def dispute_header(spark, sf):
    """The header rows of new seeds, linked to their first history row."""
    return _seeded(spark, sf).appends["dispute_header"].select(
        F.col("DSB_ID").alias("dsb_id"),
        F.col("Orig_DH_ID").alias("orig_dh_id"),
        F.col("STC_Claim_Number").alias("claim"),
        F.col("Disputer").alias("disputer"),
        F.col("Dispute_Type").alias("dispute_type"),
        F.col("Vendor").alias("vendor"),
        F.col("Platform").alias("platform"),
        F.col("BAN").alias("ban"),
        day_text("Bill_Date").alias("bill_date"),
        F.col("USI").alias("usi"),
        F.col("Dispute_Amount").cast("double").alias("dispute_amount"),
        F.col("BanMaster_ID").alias("banmaster_id"),
        F.col("Source_TBL").alias("source_tbl"),
        F.col("Source_ID").alias("source_id"),
        F.date_format("Edit_DT", "yyyy-MM-dd HH:mm:ss").alias("edit_dt"),
    )


@check(
    "dispute_detail",
    f"""
WITH {SEEDED_SQL}
SELECT y.key AS ds_id, y.key AS dsb_id, y.cost_type, y.seed AS cost_type_seed,
       CASE y.cost_type WHEN 'MRC' THEN 'TX' WHEN 'OCC' THEN 'CA' WHEN 'TAS' THEN 'NY' WHEN 'USAGE' THEN 'FL'
            WHEN 'LPC' THEN 'WA' WHEN 'ADJ' THEN 'OR' ELSE o.o_orderstatus END AS state,
       y.usoc, CASE y.cost_type WHEN 'MRC' THEN c.c_mktsegment WHEN 'OCC' THEN p.p_name END AS usoc_desc,
       y.cpid, y.record_type, CAST(CAST(y.billed_amt AS DECIMAL(19,4)) AS DOUBLE) AS billed_amt,
       y.amount AS claimed_amt, y.phrase_code,
       CASE WHEN y.cost_type = 'OCC' THEN 'SO' || y.seed END AS causing_so,
       CASE WHEN y.cost_type = 'OCC' THEN 'PN' || y.seed END AS pon,
       CASE WHEN y.cost_type = 'USAGE' THEN '0.5' END AS usage_rate, y.jurisdiction
FROM y LEFT JOIN orders o ON o.o_orderkey = CAST(y.seed AS BIGINT)
LEFT JOIN customer c ON c.c_custkey = CAST(y.seed AS BIGINT)
LEFT JOIN part p ON p.p_partkey = CAST(y.seed AS BIGINT)""",
    SEEDED_VIEWS,
)
def dispute_detail(spark, sf):
    """The detail rows of new seeds, with all that their cost rows filled in."""
    named = ("DS_ID", "DSB_ID", "Cost_Type", "Cost_Type_Seed", "State", "USOC", "USOC_Desc", "CPID", "Record_Type")
    rest = ("Causing_SO", "PON", "Usage_Rate", "Jurisdiction")
    return _seeded(spark, sf).appends["dispute_detail"].select(
        *[F.col(c).alias(c.lower()) for c in (*named, *rest)],
        F.col("Billed_Amt").cast("double").alias("billed_amt"),
        F.col("Claimed_Amt").cast("double").alias("claimed_amt"),
        F.col("Billed_Phrase_Code").alias("phrase_code"),
    )


def _opened(result):
    return result.appends["dispute_current"].select(
        F.col("DSB_ID").alias("dsb_id"),
        F.col("STC_Claim_Number").alias("claim"),
        F.col("Disputer").alias("full_name"),
        F.col("Vendor").alias("vendor"),
        F.col("Platform").alias("platform"),
        F.col("Norm_Platform").alias("norm_platform"),
        F.col("Norm_Vendor").alias("norm_vendor"),
        F.col("Display_Status").alias("display_status"),
        F.col("Dispute_Amount").cast("double").alias("dispute_amount"),
    )


@check(
    "nonseed_disputes",
    f"""
WITH x AS (
  SELECT n.*, p.full_name, n.source_id AS ban, n.day AS bill_day, CAST(NULL AS BIGINT) AS master_id
  FROM v_num n JOIN v_emp p ON p.comp_serial = n.comp_serial
  WHERE NOT n.bad_date AND COALESCE(LAST_DAY(n.day) <= DATE '2024-02-29', TRUE)
    AND NOT n.bad_number AND NOT n.bad_sign)
SELECT (SELECT MAX(o_orderkey) FROM orders) + ROW_NUMBER() OVER (ORDER BY x.line_id) AS dsb_id,
       x.full_name, 'BDT ' || b.ban AS vendor, bp.n_name AS platform, mp.n_name AS norm_platform,
       mv.r_name AS norm_vendor,
       CASE WHEN x.line_id % 5 = 0 THEN 'Filed' ELSE 'Pending Review' END AS display_status,
       CAST(x.amount AS DOUBLE) AS dispute_amount
FROM x {MASTER_SQL.format(today="2024-01-31")}""",
    ("v_num", "v_emp", "v_ban"),
)
def q_nonseed_disputes(spark, sf):
    n = F.col("line_id")
    sub = v_sub(spark, sf).select(
        n.alias("Line_ID"),
        F.col("comp_serial").alias("Comp_Serial"),
        F.col("source_id").alias("BAN"),
        F.col("date_txt").alias("Bill_Date"),
        F.col("amount_txt").alias("Dispute_Amt"),
        F.when(n % 5 == 0, "Email").otherwise("STC").alias("Dispute_Type"),
    )
    tables = base_tables(spark, sf) | master_tables(spark, sf)
    return _opened(nonseed_disputes(sub, tables, EVENT_NOW)).drop("claim")


MINED_JOB = """
r AS (
  SELECT r.*, CASE WHEN full_name IS NULL THEN 'Comp_Serial does not exist'
              WHEN f.first <> r.line_id THEN 'Source_ID was already given for this action' END AS err0
  FROM v_rev r LEFT JOIN (
    SELECT source_tbl, source_id, MIN(line_id) AS first FROM v_rev WHERE full_name IS NOT NULL
    GROUP BY source_tbl, source_id) f ON f.source_tbl = r.source_tbl AND f.source_id = r.source_id),
s AS (
  SELECT r.*, CAST(r.source_id AS BIGINT) AS src,
         LAST_DAY(CAST(date_trunc('month', CASE WHEN r.line_id % 2 = 0 THEN DATE '1998-01-01'
           ELSE DATE '2001-08-15' + 15 - CAST(30 + 100 * c.c_nationkey AS INTEGER) END)
           - INTERVAL 1 MONTH AS DATE)) AS start_day
  FROM r LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = r.source_id WHERE r.err0 IS NULL),
m AS (
  SELECT s.line_id, s.source_tbl, s.source_id, s.full_name, 'MRC' AS cost_type, 'MRC' AS record_type,
         o.o_orderkey AS seed, o.o_orderpriority AS vendor, 'MP' AS platform,
         CAST(o.o_orderkey % 100 AS VARCHAR) AS ban, CAST(o.o_orderdate AS DATE) AS bill_day,
         o.o_totalprice - 100000 AS amt
  FROM s JOIN orders o ON o.o_custkey = s.src AND CAST(o.o_orderdate AS DATE) > s.start_day
  WHERE s.source_tbl = 'BMI' AND o.o_totalprice - 100000 > 0
  UNION ALL
  SELECT s.line_id, s.source_tbl, s.source_id, s.full_name, 'OCC', upper(p.p_type), p.p_partkey, 'V', 'OP',
         CAST(p.p_partkey AS VARCHAR), DATE '2001-07-31', p.p_retailprice - 905
  FROM s JOIN customer c ON c.c_custkey = s.src JOIN part p ON p.p_partkey = s.src
  WHERE s.source_tbl = 'BMI' AND DATE '2001-07-31' > s.start_day AND p.p_retailprice - 905 > 0
  UNION ALL
  SELECT s.line_id, s.source_tbl, s.source_id, s.full_name, 'PC-' || k.t, k.t, o.o_orderkey,
         'V' || CAST(o.o_custkey AS VARCHAR), NULL, CAST(o.o_custkey AS VARCHAR),
         CAST(o.o_orderdate AS DATE), o.o_totalprice + k.n
  FROM s JOIN orders o ON o.o_custkey = s.src AND CAST(o.o_orderdate AS DATE) > s.start_day
  CROSS JOIN (VALUES ('MRC', -100000), ('NRC', -199999), ('FRAC', -299998)) AS k(t, n)
  WHERE s.source_tbl = 'PCI' AND o.o_totalprice + k.n > 0)"""


def _dispute_job(spark, sf):
    tables = base_tables(spark, sf) | master_tables(spark, sf) | mining_tables(spark, sf)
    return dispute_job(review_sub(spark, sf, "Dispute"), tables, ORDER_NOW)


@check(
    "dispute_job",
    f"""
WITH {MINED_JOB}
SELECT r.line_id, COALESCE(r.err0, CASE WHEN k.source_id IS NULL THEN
  'Valid cost was not found for the Source_TBL, Source_ID, Start_Date combo' END) AS error_message
FROM r LEFT JOIN (SELECT DISTINCT source_tbl, source_id FROM m) k
  ON k.source_tbl = r.source_tbl AND k.source_id = r.source_id""",
    ("v_rev",),
)
def q_dispute_job(spark, sf):
    return _dispute_job(spark, sf).results.select(
        F.col("Line_ID").alias("line_id"), F.col("Error_Message").alias("error_message")
    )


@check(
    "dispute_job_bad_dates",
    f"""
WITH {
        MINED_JOB.replace(
            "WHEN f.first <> r.line_id", "WHEN r.line_id % 5 = 0 THEN 'Start_Date is not a date' WHEN f.first <> r.line_id"
        ).replace("WHERE full_name IS NOT NULL", "WHERE full_name IS NOT NULL AND line_id % 5 <> 0")
    }
SELECT r.line_id, COALESCE(r.err0, CASE WHEN k.source_id IS NULL THEN
  'Valid cost was not found for the Source_TBL, Source_ID, Start_Date combo' END) AS error_message
FROM r LEFT JOIN (SELECT DISTINCT source_tbl, source_id FROM m) k
  ON k.source_tbl = r.source_tbl AND k.source_id = r.source_id""",
    ("v_rev",),
)
def q_dispute_job_bad_dates(spark, sf):
    """A start date that cannot be read is an error and is not filled in."""
    tables = base_tables(spark, sf) | master_tables(spark, sf) | mining_tables(spark, sf)
    sub = review_sub(spark, sf, "Dispute")
    unread = F.when(F.col("Line_ID") % 5 == 0, "31.12.2023").otherwise(F.col("Start_Date"))
    results = dispute_job(sub.withColumn("Start_Date", unread), tables, ORDER_NOW).results
    return results.select(F.col("Line_ID").alias("line_id"), F.col("Error_Message").alias("error_message"))


@check(
    "review_seed_disputes",
    f"""
WITH {MINED_JOB},
x AS (SELECT *, CAST(NULL AS BIGINT) AS master_id FROM m)
SELECT (SELECT MAX(o_orderkey) FROM orders)
         + ROW_NUMBER() OVER (ORDER BY x.line_id, x.cost_type, CAST(x.seed AS VARCHAR)) AS dsb_id,
       '20010810_' || left(x.record_type, 1) || CAST(x.seed AS VARCHAR) AS claim, x.full_name, x.vendor,
       COALESCE(x.platform, bp.n_name) AS platform, mp.n_name AS norm_platform, mv.r_name AS norm_vendor,
       CASE WHEN x.source_tbl = 'PCI' THEN 'Filed' ELSE 'Pending Review' END AS display_status,
       CAST(CAST(x.amt AS DECIMAL(18,2)) AS DOUBLE) AS dispute_amount
FROM x {MASTER_SQL.format(today="2001-08-15")}""",
    ("v_rev", "v_ban"),
)
def q_review_seed_disputes(spark, sf):
    return _opened(_dispute_job(spark, sf))


def _facts(kind, df, key, *values):
    """Rows of one kind in the common shape (kind, id, v1, v2, v3)."""
    columns = [*values, *[F.lit(None)] * (3 - len(values))]
    return df.select(
        F.lit(kind).alias("kind"),
        F.col(key).cast("bigint").alias("id"),
        *[
            (F.col(v) if isinstance(v, str) else v).cast("string").alias(f"v{i}")
            for i, v in enumerate(columns, start=1)
        ],
    )


def _first_per_source(errors: str) -> str:
    """Review rows with the first clean row of each source kept."""
    return f"""
r0 AS (SELECT *, CASE {STAFF} {errors} END AS err0 FROM v_rev),
r1 AS (
  SELECT r0.*, COALESCE(err0, CASE WHEN f.first <> line_id THEN
         'Source_ID was already given for this action' END) AS err1
  FROM r0 LEFT JOIN (SELECT source_tbl, source_id, MIN(line_id) AS first FROM r0 WHERE err0 IS NULL
                     GROUP BY source_tbl, source_id) f
    ON f.source_tbl = r0.source_tbl AND f.source_id = r0.source_id)"""


def move_sql(errors: str, test: str, message: str, prior: bool, status: str) -> str:
    """Outcome and new history of a review job that moves the disputes of a source."""
    wrong = "m.old_dh IS NULL" if prior else "FALSE"
    return f"""
WITH {_first_per_source(errors)},
d AS (
  SELECT c.source_tbl, c.source_id, c.dsb_id, h.dh_id AS old_dh
  FROM v_current c LEFT JOIN v_history h ON h.dh_id = c.dh_id
  WHERE c.status = 'Open' AND c.dispute_category = 'GRT CNR' AND {test}),
r2 AS (
  SELECT r1.*, COALESCE(err1, CASE WHEN k.source_id IS NULL THEN '{message}' END) AS err2
  FROM r1 LEFT JOIN (SELECT DISTINCT source_tbl, source_id FROM d) k
    ON k.source_tbl = r1.source_tbl AND k.source_id = r1.source_id),
m AS (
  SELECT r2.line_id, r2.full_name, d.dsb_id, d.old_dh
  FROM r2 JOIN d ON d.source_tbl = r2.source_tbl AND d.source_id = r2.source_id WHERE r2.err2 IS NULL)
SELECT 'result' AS kind, r2.line_id AS id, COALESCE(err2, CASE WHEN t.n = 0 THEN
         'DSB_ID has no prior version in Dispute History' END) AS v1,
       CAST(NULL AS VARCHAR) AS v2, CAST(NULL AS VARCHAR) AS v3
FROM r2 LEFT JOIN (SELECT line_id, SUM(CASE WHEN {wrong} THEN 0 ELSE 1 END) AS n FROM m GROUP BY line_id) t
  ON t.line_id = r2.line_id
UNION ALL
SELECT 'history', dsb_id, '{status}', full_name, CAST((SELECT MAX(o_orderkey) FROM orders)
       + ROW_NUMBER() OVER (ORDER BY line_id, dsb_id) AS VARCHAR)
FROM m WHERE NOT ({wrong})"""


def _moved(result):
    return _facts("result", result.results, "Line_ID", "Error_Message").unionByName(
        _facts(
            "history",
            result.appends["dispute_history"],
            "DSB_ID",
            "Display_Status",
            "GRT_Update_Rep",
            "DH_ID",
        )
    )


@check(
    "escalate_job",
    move_sql(
        "",
        "(c.display_status = 'Denied - Pending' OR c.dispute_type = 'Email')",
        "There are no open Denied - Pending/Email GRT CNR disputes for this "
        "Source_TBL & Source_ID combo",
        False,
        "Filed",
    ),
    ("v_rev", "v_current", "v_history"),
)
def q_escalate_job(spark, sf):
    sub = review_sub(spark, sf, "Escalate Disputes")
    return _moved(escalate_job(sub, base_tables(spark, sf), EVENT_NOW, CONFIG))


@check(
    "paid_job",
    move_sql(
        f"{AMOUNT} {CREDIT}",
        "(c.display_status IN ('Denied - Pending', 'Approved', 'Partial Approved') "
        "OR c.dispute_type = 'Email')",
        "There are no open Denied - Pending or Approved GRT CNR disputes for this Source_ID",
        True,
        "Paid",
    ),
    ("v_rev", "v_current", "v_history"),
)
def q_paid_job(spark, sf):
    sub = review_sub(spark, sf, "Paid Disputes")
    return _moved(paid_job(sub, base_tables(spark, sf), EVENT_NOW, CONFIG))


@check(
    "close_job",
    move_sql(
        "",
        "(c.display_status IN ('Denied - Pending') OR c.dispute_type = 'Email')",
        "There are no open Denied - Pending GRT CNR disputes for this Source_ID",
        True,
        "Denied - Closed",
    ),
    ("v_rev", "v_current", "v_history"),
)
def q_close_job(spark, sf):
    sub = review_sub(spark, sf, "Close Disputes")
    return _moved(close_job(sub, base_tables(spark, sf), EVENT_NOW, CONFIG))


@check(
    "note_job",
    f"""
WITH today AS (
  SELECT DISTINCT source_tbl, source_id FROM v_current
  WHERE status = 'Open' AND dispute_category = 'GRT CNR' AND dsb_id % 8 = 0),
n0 AS (
  SELECT r.*, t.source_id IS NOT NULL AS noted
  FROM v_rev r LEFT JOIN today t ON t.source_tbl = r.source_tbl AND t.source_id = r.source_id),
{
        _first_per_source(
            "WHEN noted THEN 'Dispute Notes were already filed for this Source_ID today' "
            f"{AMOUNT} {CAP}"
        ).replace("FROM v_rev", "FROM n0")
    },
d AS (SELECT * FROM v_current WHERE status = 'Open' AND dispute_category = 'GRT CNR'),
r2 AS (
  SELECT r1.*, COALESCE(err1, CASE WHEN k.source_id IS NULL THEN
    'There are no open STC filed GRT CNR disputes for this Source_TBL & Source_ID combo' END) AS err2
  FROM r1 LEFT JOIN (SELECT DISTINCT source_tbl, source_id FROM d) k
    ON k.source_tbl = r1.source_tbl AND k.source_id = r1.source_id),
m AS (
  SELECT r2.line_id, r2.full_name, r2.amount, d.dsb_id
  FROM r2 JOIN d ON d.source_tbl = r2.source_tbl AND d.source_id = r2.source_id WHERE r2.err2 IS NULL)
SELECT 'result' AS kind, line_id AS id, err2 AS v1, CAST(NULL AS VARCHAR) AS v2, CAST(NULL AS VARCHAR) AS v3
FROM r2
UNION ALL
SELECT 'note', dsb_id, full_name, CAST(CAST(amount AS INTEGER) AS VARCHAR),
       CAST((SELECT MAX(o_orderkey) FROM orders) + ROW_NUMBER() OVER (ORDER BY line_id, dsb_id) AS VARCHAR)
FROM m""",
    ("v_rev", "v_current"),
)
def q_note_job(spark, sf):
    sub = review_sub(spark, sf, "Dispute Note")
    result = note_job(sub, base_tables(spark, sf), EVENT_NOW, CONFIG)
    notes = result.appends["dispute_notes"]
    return _facts("result", result.results, "Line_ID", "Error_Message").unionByName(
        _facts("note", notes, "DSB_ID", "Assign_To", "Days_Till_Action", "DN_ID")
    )


FOLDER_STEPS = f"""
WITH today AS (
  SELECT DISTINCT source_tbl, source_id FROM v_current
  WHERE status = 'Open' AND dispute_category = 'GRT CNR' AND dsb_id % 8 = 0),
n0 AS (
  SELECT r.*, r.line_id % 3 AS act FROM v_rev r
  LEFT JOIN today t ON t.source_tbl = r.source_tbl AND t.source_id = r.source_id
  WHERE full_name IS NOT NULL
    AND (r.line_id % 3 <> 2 OR (t.source_id IS NULL AND NOT bad_number AND NOT bad_sign AND COALESCE(amount, 0) <= 200))),
w AS (
  SELECT * FROM n0 QUALIFY ROW_NUMBER() OVER (PARTITION BY act, source_tbl, source_id ORDER BY line_id) = 1),
d AS (
  SELECT c.*, h.dh_id IS NOT NULL AS has_prior FROM v_current c LEFT JOIN v_history h ON h.dh_id = c.dh_id
  WHERE status = 'Open' AND c.dispute_category = 'GRT CNR'),
noted AS (
  SELECT d.dsb_id, w.reason FROM d JOIN w ON w.act = 2 AND w.source_tbl = d.source_tbl AND w.source_id = d.source_id),
raised AS (
  SELECT d.dsb_id, (SELECT MAX(o_orderkey) FROM orders) + ROW_NUMBER() OVER (ORDER BY w.line_id, d.dsb_id) AS key
  FROM d JOIN w ON w.act = 0 AND w.source_tbl = d.source_tbl AND w.source_id = d.source_id
  WHERE d.display_status = 'Denied - Pending' OR d.dispute_type = 'Email'),
shut AS (
  SELECT d.dsb_id, w.reason, (SELECT MAX(o_orderkey) FROM orders) + (SELECT COUNT(*) FROM raised)
         + ROW_NUMBER() OVER (ORDER BY w.line_id, d.dsb_id) AS key
  FROM d LEFT JOIN raised e ON e.dsb_id = d.dsb_id
  JOIN w ON w.act = 1 AND w.source_tbl = d.source_tbl AND w.source_id = d.source_id
  WHERE (d.dispute_type = 'Email' OR (e.dsb_id IS NULL AND d.display_status = 'Denied - Pending'))
    AND (e.dsb_id IS NOT NULL OR d.has_prior))"""


def _folder(spark, sf):
    """A review file with three actions, of which one source may have all."""
    n = F.col("Line_ID")
    action = F.when(n % 3 == 0, "Escalate Disputes").when(n % 3 == 1, "Close Disputes").otherwise("Dispute Note")
    sub = review_sub(spark, sf, "").withColumn("Action", action)
    return review_folder(sub, base_tables(spark, sf), EVENT_NOW, CONFIG)


@check(
    "review_folder_snapshot",
    f"""
{FOLDER_STEPS}
SELECT c.dsb_id, CASE WHEN s.dsb_id IS NOT NULL THEN 'Closed' ELSE c.status END AS status,
       CASE WHEN s.dsb_id IS NOT NULL THEN 'Denied - Closed' WHEN e.dsb_id IS NOT NULL THEN 'Filed'
            ELSE c.display_status END AS display_status,
       CASE WHEN e.dsb_id IS NOT NULL THEN COALESCE(c.n_escalations, 0) + 1 ELSE c.n_escalations END AS n_escalations,
       s.reason AS close_reason,
       CASE WHEN s.dsb_id IS NULL AND e.dsb_id IS NULL THEN n.reason END AS note,
       COALESCE(s.key, e.key, c.dh_id) AS dh_id
FROM v_current c LEFT JOIN noted n ON n.dsb_id = c.dsb_id LEFT JOIN raised e ON e.dsb_id = c.dsb_id
LEFT JOIN shut s ON s.dsb_id = c.dsb_id""",
    ("v_rev", "v_current", "v_history"),
)
def review_folder_snapshot(spark, sf):
    """The current state after a file of notes, escalations and closures; each sees the one before."""
    return _state(_folder(spark, sf).snapshots["dispute_current"]).select(
        "dsb_id", "status", "display_status", "n_escalations", "close_reason", "note", "dh_id"
    )


@check(
    "review_folder_history",
    f"""
{FOLDER_STEPS}
SELECT key AS dh_id, dsb_id, 'Filed' AS display_status FROM raised
UNION ALL SELECT key, dsb_id, 'Denied - Closed' FROM shut""",
    ("v_rev", "v_current", "v_history"),
)
def review_folder_history(spark, sf):
    """The history rows of the same file: the keys of one action go on where the one before ended."""
    return _folder(spark, sf).appends["dispute_history"].select(
        F.col("DH_ID").alias("dh_id"), F.col("DSB_ID").alias("dsb_id"), F.col("Display_Status").alias("display_status")
    )


def queue_sql(waiting: str, message: str, listed: str) -> str:
    """Outcome, notes and queue rows of an outbound queue job."""
    return f"""
WITH p AS (
  SELECT DISTINCT CASE WHEN o_orderkey % 4 = 0 THEN 'PCI' ELSE 'BMI' END AS source_tbl,
         CAST(o_orderkey AS VARCHAR) AS source_id
  FROM orders WHERE {waiting}),
q0 AS (
  SELECT r.*, c.s_suppkey IS NULL AS no_mac, p.source_id IS NOT NULL AS waits
  FROM v_rev r LEFT JOIN supplier c ON CAST(c.s_suppkey AS VARCHAR) = r.source_id
  LEFT JOIN p ON p.source_tbl = r.source_tbl AND p.source_id = r.source_id),
{
        _first_per_source(
            f"WHEN no_mac THEN 'This Macnum is not a known customer' WHEN waits THEN '{message}'"
        ).replace("FROM v_rev", "FROM q0")
    },
d AS (
  SELECT * FROM v_current WHERE status = 'Open' AND dispute_category = 'GRT CNR'
    AND (display_status = 'Denied - Pending' OR dispute_type = 'Email')),
pick AS (
  SELECT source_tbl, source_id, disputer FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY source_tbl, source_id
                                 ORDER BY disputer, date_submitted DESC) AS rn FROM d) t
  WHERE rn = 1),
w AS ({WORKLIST_SQL})
SELECT 'result' AS kind, line_id AS id, err1 AS v1, CAST(NULL AS VARCHAR) AS v2, CAST(NULL AS VARCHAR) AS v3
FROM r1
UNION ALL
SELECT 'note', d.dsb_id, d.disputer, '14', CAST((SELECT MAX(o_orderkey) FROM orders)
       + ROW_NUMBER() OVER (ORDER BY r1.line_id, d.dsb_id) AS VARCHAR)
FROM r1 JOIN d ON d.source_tbl = r1.source_tbl AND d.source_id = r1.source_id WHERE r1.err1 IS NULL
UNION ALL
{listed}"""


def _queued(result, name, *values):
    notes = result.appends["dispute_notes"]
    return (
        _facts("result", result.results, "Line_ID", "Error_Message")
        .unionByName(_facts("note", notes, "DSB_ID", "Assign_To", "Days_Till_Action", "DN_ID"))
        .unionByName(_facts("queue", result.appends[name], "Source_ID", *values))
    )


@check(
    "prov_job",
    queue_sql(
        "o_orderkey % 5 = 0 AND o_orderkey % 2 = 0",
        "This Source_TBL and Source_ID is already pending in Send to Prov table",
        """
SELECT 'queue', CAST(r1.source_id AS BIGINT), COALESCE(pick.disputer, r1.full_name),
       CASE WHEN r1.source_tbl = 'BMI' THEN o.o_orderpriority END,
       CASE WHEN r1.line_id % 3 = 0 THEN 'own' ELSE CAST(o.o_custkey AS VARCHAR) END
FROM r1 JOIN w ON w.source_tbl = r1.source_tbl AND w.source_id = r1.source_id
JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = w.source_id
LEFT JOIN pick ON pick.source_tbl = r1.source_tbl AND pick.source_id = r1.source_id
WHERE r1.err1 IS NULL""",
    ),
    ("v_rev", "v_current"),
)
def q_prov_job(spark, sf):
    tables = base_tables(spark, sf) | queue_tables(spark, sf)
    result = prov_job(review_sub(spark, sf, "Send to Prov"), tables, EVENT_NOW, CONFIG)
    return _queued(result, "queue_prov", "Assigned_To", "Product", "BAN")


@check(
    "lv_job",
    queue_sql(
        "o_orderkey % 5 = 0 OR o_orderkey % 7 = 0",
        "This Source_TBL and Source_ID is already pending in Send to LV table",
        """
SELECT 'queue', CAST(r1.source_id AS BIGINT), COALESCE(pick.disputer, r1.full_name), 'W' || w.source_id,
       strftime(w.max_cnr_date, '%Y-%m-%d')
FROM r1 LEFT JOIN w ON w.source_tbl = r1.source_tbl AND w.source_id = r1.source_id
LEFT JOIN pick ON pick.source_tbl = r1.source_tbl AND pick.source_id = r1.source_id
WHERE r1.err1 IS NULL""",
    ),
    ("v_rev", "v_current"),
)
def q_lv_job(spark, sf):
    tables = base_tables(spark, sf) | queue_tables(spark, sf)
    result = lv_job(review_sub(spark, sf, "Send to LV"), tables, EVENT_NOW, CONFIG)
    return _queued(result, "queue_lv", "Assigned_To", "WTN", "Invoice_Date")


LOGGED_SQL = f"""
WITH w AS ({WORKLIST_SQL})
SELECT CASE WHEN w.tag = 'unmapped' THEN 'unmapped' ELSE 'zero_revenue' END AS kind, s.line_id AS id,
       {{result}} AS v1, s.initials AS v2, {{comment}} AS v3
FROM v_rev s JOIN w ON w.source_tbl = s.source_tbl AND w.source_id = s.source_id
{{more}}
WHERE s.full_name IS NOT NULL AND w.tag IS NOT NULL"""


def _logged(result):
    frames = [
        _facts(kind, result.appends[prefix + kind], "Line_ID", "Audit_Result", "Rep", "Comment")
        for kind in ("unmapped", "zero_revenue")
        for prefix in ("", "pci_")
    ]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


@check(
    "audit_job",
    LOGGED_SQL.format(result="'Audit Review'", comment="'Send to Audit'", more=""),
    ("v_rev",),
)
def q_audit_job(spark, sf):
    return _logged(
        audit_job(review_sub(spark, sf, "Send to Audit"), base_tables(spark, sf), EVENT_NOW)
    )


@check(
    "other_job",
    LOGGED_SQL.format(result="'Vendor Call'", comment="s.reason", more=""),
    ("v_rev",),
)
def q_other_job(spark, sf):
    sub = review_sub(spark, sf, "Vendor Call").withColumnRenamed("Action_Reason", "Action_Comment")
    return _logged(other_job(sub, base_tables(spark, sf), EVENT_NOW))


@check(
    "ticket_job",
    LOGGED_SQL.format(
        result="'Ticket Opened'",
        comment="CAST(c.c_custkey AS VARCHAR) || ' - ' || n.n_name",
        more="""JOIN customer c ON c.c_custkey = CAST(s.amount AS BIGINT) AND c.c_custkey % 7 <> 0
JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    )
    + " AND NOT s.bad_number AND NOT s.bad_sign",
    ("v_rev",),
)
def q_ticket_job(spark, sf):
    tables = base_tables(spark, sf) | ticket_tables(spark, sf)
    return _logged(ticket_job(review_sub(spark, sf, "Ticket Opened"), tables, EVENT_NOW))


MAPPED_SQL = """
WITH p AS (
  SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 'PCI' ELSE 'BMI' END AS tbl,
         CASE WHEN p_size % 2 = 0 THEN 'LL' ELSE 'BRD' END AS kind,
         CASE WHEN p_partkey % 4 = 0 THEN split_part(p_name, ' ', 1) ELSE replace(p_name, ' ', ', ') END AS items
  FROM part),
i AS (
  SELECT id, tbl, kind, CAST(instr(items, ',') > 0 AS INTEGER) AS bmb,
         unnest(string_split(replace(items, ', ', ','), ',')) AS item FROM p),
ll AS (SELECT DISTINCT 'LL' AS kind, CASE WHEN p_size > 30 THEN split_part(p_name, ' ', 1)
              ELSE split_part(p_name, ' ', 2) END AS item FROM part
       UNION SELECT DISTINCT 'BRD', split_part(p_name, ' ', 1) FROM part),
br AS (SELECT DISTINCT CASE WHEN p_partkey % 50 = 0 THEN p_partkey ELSE -p_partkey - 1 END AS id,
              split_part(p_name, ' ', 1) AS item FROM part),
e AS (
  SELECT i.*, CASE WHEN ll.item IS NULL THEN i.kind || ' ' || i.item || ' is not found in ' || i.kind
                   WHEN br.item IS NOT NULL THEN
                   'BMB table is already mapped to ' || i.kind || ' ' || i.item END AS err
  FROM i LEFT JOIN ll ON ll.kind = i.kind AND ll.item = i.item
  LEFT JOIN br ON i.bmb = 1 AND i.kind = 'BRD' AND br.id = i.id AND br.item = i.item),
f AS (SELECT id, ARG_MIN(err, item) AS sibling FROM e WHERE err IS NOT NULL GROUP BY id),
g AS (SELECT e.* FROM e LEFT JOIN f ON f.id = e.id WHERE f.id IS NULL)
"""


@check(
    "map_job",
    f"""
{MAPPED_SQL}
SELECT e.id, e.item, e.bmb, COALESCE(e.err, f.sibling) AS error_message
FROM e LEFT JOIN f ON f.id = e.id""",
)
def q_map_job(spark, sf):
    return _mapped(spark, sf).results.select(
        F.col("Line_ID").alias("id"),
        F.col("Gs_SrvID").alias("item"),
        F.col("BMB").alias("bmb"),
        F.col("Error_Message").alias("error_message"),
    )


def _mapped(spark, sf):
    key = F.col("p_partkey")
    sub = table(spark, sf, "part").select(
        key.alias("Line_ID"),
        F.lit("Map").alias("Action"),
        F.when(key % 3 == 0, "PCI").otherwise("BMI").alias("Source_TBL"),
        text(key).alias("Source_ID"),
        F.when(F.col("p_size") % 2 == 0, "LL").otherwise("BRD").alias("Gs_SrvType"),
        F.when(key % 4 == 0, F.element_at(F.split("p_name", " "), 1))
        .otherwise(F.replace("p_name", F.lit(" "), F.lit(", ")))
        .alias("Gs_SrvID"),
        F.lit(1).cast("long").alias("Comp_Serial"),
    )
    return map_job(sub, base_tables(spark, sf) | map_tables(spark, sf), EVENT_NOW)


@check(
    "map_bridges",
    f"""
{MAPPED_SQL}
SELECT CASE WHEN tbl = 'BMI' THEN 'bmb' ELSE 'pci_bmb' END AS bridge, id, kind AS srv_type, item AS srv_id, 'S1' AS rep
FROM g WHERE bmb = 1""",
)
def map_bridges(spark, sf):
    """The bridge rows of sources that are mapped to several services."""
    appends = _mapped(spark, sf).appends
    frames = [
        appends[name].select(
            F.lit(name).alias("bridge"), F.col(key).alias("id"), F.col("gs_SrvType").alias("srv_type"),
            F.col("gs_SrvID").alias("srv_id"), F.col("Rep").alias("rep"),
        )
        for name, key in (("bmb", "BMI_ID"), ("pci_bmb", "PCI_ID"))
    ]
    return frames[0].unionByName(frames[1])


def _written_back(target: str, source: str, bridge: str, rep: str) -> str:
    return f"""
SELECT '{target}' AS target, p_partkey AS id,
       CASE WHEN k.id IS NULL THEN p_brand WHEN k.bmb = 1 THEN CAST(k.id AS VARCHAR) ELSE k.item END AS srv_id,
       CASE WHEN k.id IS NULL THEN p_type WHEN k.bmb = 1 THEN '{bridge}' ELSE k.kind END AS srv_type,
       CASE WHEN k.id IS NOT NULL THEN {rep} END AS rep
FROM part LEFT JOIN k ON k.id = p_partkey AND k.tbl = '{source}'"""


@check(
    "map_write_back",
    f"""
{MAPPED_SQL},
k AS (SELECT id, tbl, kind, MAX(bmb) AS bmb, MIN(item) AS item FROM g GROUP BY id, tbl, kind)
{_written_back("bmm", "BMI", "BMB", "'S1'")}
UNION ALL
{_written_back("pci", "PCI", "M2M", "CAST(NULL AS VARCHAR)")}""",
)
def map_write_back(spark, sf):
    """Both inventories after the mapping; one with several services points to its bridge."""
    snapshots = _mapped(spark, sf).snapshots
    frames = [
        snapshots[name].select(
            F.lit(name).alias("target"), F.col(key).alias("id"), F.col("gs_SrvID").alias("srv_id"),
            F.col("gs_SrvType").alias("srv_type"), F.col("frameID").cast("string").alias("rep"),
        )
        for name, key in (("bmm", "BMI_ID"), ("pci", "ID"))
    ]
    return frames[0].unionByName(frames[1])


@check(
    "map_log",
    f"""
{MAPPED_SQL}
SELECT DISTINCT CASE WHEN tbl = 'BMI' THEN 'unmapped' ELSE 'pci_unmapped' END AS log, id, 'Mapped' AS audit_result,
       'S1' AS rep FROM g""",
)
def map_log(spark, sf):
    """One log row for each mapped source."""
    appends = _mapped(spark, sf).appends
    frames = [
        appends[name].select(
            F.lit(name).alias("log"), F.col(key).alias("id"), F.col("Audit_Result").alias("audit_result"),
            F.col("Rep").alias("rep"),
        )
        for name, key in (("unmapped", "BMI_ID"), ("pci_unmapped", "PCI_ID"))
    ]
    return frames[0].unionByName(frames[1])


@check(
    "lv_attachments",
    queue_sql(
        "o_orderkey % 5 = 0 OR o_orderkey % 7 = 0",
        "This Source_TBL and Source_ID is already pending in Send to LV table",
        """
SELECT 'queue', CAST(r1.source_id AS BIGINT), COALESCE(pick.disputer, r1.full_name),
       CASE WHEN o.o_orderkey % 6 = 0 THEN r1.source_tbl || '_' || r1.source_id || '_b.pdf'
            WHEN o.o_orderkey % 3 = 0 THEN r1.source_tbl || '_' || r1.source_id || '.pdf' END, CAST(NULL AS VARCHAR)
FROM r1 LEFT JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = r1.source_id
  AND r1.source_tbl = CASE WHEN o.o_orderkey % 4 = 0 THEN 'PCI' ELSE 'BMI' END
LEFT JOIN pick ON pick.source_tbl = r1.source_tbl AND pick.source_id = r1.source_id
WHERE r1.err1 IS NULL""",
    ),
    ("v_rev", "v_current"),
)
def lv_attachments(spark, sf):
    """Line verification through the folder, with the newest attachment of a kept listing."""
    key = F.col("o_orderkey")
    source = F.when(key % 4 == 0, "PCI").otherwise("BMI")
    day = F.col("o_orderdate").cast("timestamp")
    orders = table(spark, sf, "orders").filter(key % 3 == 0)
    listed = [
        part.select(
            source.alias("Source_TBL"), text(key).alias("Source_ID"),
            F.concat(source, F.lit("_"), text(key), F.lit(end)).alias("File_Name"),
            (day + F.expr(f"INTERVAL {days} DAYS")).alias("Modified"),
        )
        for part, end, days in ((orders, ".pdf", 0), (orders.filter(key % 6 == 0), "_b.pdf", 1))
    ]
    tables = base_tables(spark, sf) | queue_tables(spark, sf) | {"attachments": listed[0].unionByName(listed[1])}
    result = run_folder("01_BMI-PCI", review_sub(spark, sf, "Send to LV"), tables, EVENT_NOW, CONFIG)
    return _queued(result, "queue_lv", "Assigned_To", "CSR_File_Name")


@check(
    "error_records",
    """
WITH e AS (
  SELECT *, CASE WHEN bad_number THEN 'amount_txt is not numeric' ELSE 'amount_txt is <= 0' END AS message
  FROM v_num WHERE bad_number OR bad_sign)
SELECT e.line_id, u.name, u.value
FROM e CROSS JOIN LATERAL (VALUES ('line_id', CAST(e.line_id AS VARCHAR)), ('action', e.action),
  ('source_tbl', e.source_tbl), ('source_id', e.source_id), ('dsb_id', CAST(e.dsb_id AS VARCHAR)),
  ('amount_txt', e.amount_txt), ('date_txt', e.date_txt), ('Error_Columns', 'amount_txt'),
  ('Error_Message', e.message), ('Comp_Serial', CAST(e.comp_serial AS VARCHAR)), ('Odd Reason', e.reason)
) AS u(name, value) WHERE u.value IS NOT NULL AND u.value <> ''""",
    ("v_num",),
)
def q_error_records(spark, sf):
    """Rejected rows as named values, those of an attribute that no job lists included."""
    judged = validate(conform(v_sub(spark, sf), []), amount_rules("amount_txt"))
    other = F.to_json(F.struct(F.col("reason").alias("Odd Reason"))).alias(OTHER_VALUES)
    rows = rejected(judged).withColumnRenamed("comp_serial", "Comp_Serial").select("*", other).drop("reason")
    records = error_records(rows).select(F.explode("var").alias("v"), F.get(F.filter("var", lambda v: v["_var_name"] == "line_id"), 0)["_VALUE"].alias("line"))
    return records.select(
        F.col("line").cast("bigint").alias("line_id"), F.col("v._var_name").alias("name"), F.col("v._VALUE").alias("value")
    )


@check(
    "error_return",
    """
WITH e AS (
  SELECT DISTINCT '01_BMI-PCI' AS folder_name, comp_serial, line_id FROM v_num WHERE bad_number OR bad_sign
  UNION
  SELECT DISTINCT '04_Dispute-Actions', comp_serial, line_id FROM v_num
  WHERE bad_date OR bad_eom OR bad_past)
SELECT folder_name, comp_serial, COUNT(*) AS n_error FROM e GROUP BY folder_name, comp_serial""",
    ("v_num",),
)
def q_error_return(spark, sf):
    rows = conform(v_sub(spark, sf), [])
    judged = {
        "01_BMI-PCI": validate(rows, amount_rules("amount_txt")),
        "04_Dispute-Actions": validate(rows, date_rules("date_txt", EVENT_NOW)),
    }
    return error_return(judged)[1].select(
        F.col("Folder_Name").alias("folder_name"),
        F.col("Comp_Serial").alias("comp_serial"),
        F.col("N_Error").alias("n_error"),
    )


@check(
    "hash_claims",
    """
WITH x AS (
  SELECT n.source_id AS ban, p.full_name,
         (SELECT MAX(o_orderkey) FROM orders) + ROW_NUMBER() OVER (ORDER BY n.line_id) AS dsb_id
  FROM v_num n JOIN v_emp p ON p.comp_serial = n.comp_serial
  WHERE NOT n.bad_date AND COALESCE(LAST_DAY(n.day) <= DATE '2024-02-29', TRUE)
    AND NOT n.bad_number AND NOT n.bad_sign)
SELECT dsb_id, '20240126_X' || CAST(CAST('0x' || substr(md5(CAST(dsb_id AS VARCHAR)), 1, 15) AS BIGINT) AS VARCHAR)
         AS claim, full_name || '_' || ban AS owner
FROM x""",
    ("v_num", "v_emp"),
)
def hash_claims(spark, sf):
    """Claim numbers of free-form disputes, made from their new keys."""
    sub = v_sub(spark, sf).select(
        F.col("line_id").alias("Line_ID"),
        F.col("comp_serial").alias("Comp_Serial"),
        F.col("source_id").alias("BAN"),
        F.col("date_txt").alias("Bill_Date"),
        F.col("amount_txt").alias("Dispute_Amt"),
    )
    tables = base_tables(spark, sf) | master_tables(spark, sf)
    opened = nonseed_disputes(sub, tables, EVENT_NOW).appends["dispute_header"]
    return opened.select(
        F.col("DSB_ID").alias("dsb_id"),
        F.col("STC_Claim_Number").alias("claim"),
        name_key("Disputer", "BAN").alias("owner"),
    )


