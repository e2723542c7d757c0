"""One query per operator or small group of operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.checks.registry import check
from ledgerflow.checks.views import (
    CATEGORY,
    EVENT_NOW,
    ORDER_NOW,
    day_text,
    money,
    table,
    text,
    v_ban,
    v_current,
    v_emp,
    v_history,
    v_sub,
)
from ledgerflow.functions import (
    audit_comment,
    batch_date,
    batch_label,
    first_non_blank,
    month_end,
    previous_month_end,
    same_day,
    seed_claim_no,
    to_money,
)
from ledgerflow.operators.conform import (
    as_action_rows,
    coalesce_from,
    conform,
    default_where,
    initial_status,
    project_except,
    trim_all,
    with_source,
)
from ledgerflow.operators.enrich import enrich_by_cost_type
from ledgerflow.operators.filters import (
    clean,
    eligible,
    flag_unlisted,
    pending,
    positive,
    rejected,
    tag_is,
    tag_is_not,
)
from ledgerflow.operators.joins import (
    conditional_lookup,
    join_chain,
    join_effective,
    lookup,
    with_employee,
)
from ledgerflow.operators.keys import assign_ids
from ledgerflow.operators.mining import mine_cost
from ledgerflow.operators.relational import collect_errors, explode_csv, first_per, latest_by
from ledgerflow.operators.updates import (
    apply_mapping,
    apply_updates,
    assign_reps,
    default_start,
    stamp_worklist,
)
from ledgerflow.operators.validate import (
    amount_rules,
    bill_date_rules,
    date_rules,
    known_employee,
    max_value,
    must_derive,
    must_exist,
    must_exist_with,
    must_not_exist,
    outcome_summary,
    propagate_error,
    ticket_status,
    validate,
)
from ledgerflow.plans.dispute import SEED_COLUMNS

ERRORS = ("line_id", "error_columns", "error_message")


def _errors(df, *more):
    return df.select(
        *[F.col(c).alias(c) for c in ("line_id", *more, "error_columns", "error_message")]
    )


def _sub(spark, sf):
    return conform(v_sub(spark, sf), [])


@check(
    "conform_trim",
    """
SELECT line_id, trim('  ' || action || ' ' || chr(9), ' ' || chr(9)) AS action,
       CAST(NULL AS VARCHAR) AS comment, '02_Seeds' AS folder_name
FROM v_sub""",
    ("v_sub",),
)
def conform_trim(spark, sf):
    raw = v_sub(spark, sf).select(
        "line_id", F.concat(F.lit("  "), "action", F.lit(" \t")).alias("ACTION")
    )
    shaped = with_source(trim_all(conform(raw, ["action", "comment"])), "02_Seeds")
    return shaped.select(
        "line_id", "action", "comment", F.col("Folder_Name").alias("folder_name")
    )


@check(
    "project_except",
    """
SELECT dsb_id, source_id, display_status, 'Sent to Prov' AS action_norm_reason,
       CAST(NULL AS VARCHAR) AS note_tag, CAST(NULL AS INTEGER) AS days
FROM v_current""",
    ("v_current",),
)
def q_project_except(spark, sf):
    kept = project_except(
        v_current(spark, sf),
        [
            "source_tbl",
            "status",
            "dispute_type",
            "dispute_category",
            "n_escalations",
            "dispute_amount",
            "disputer",
            "date_submitted",
            "dh_id",
        ],
    )
    return as_action_rows(
        kept, {"action_norm_reason": "Sent to Prov"}, {"note_tag": "string", "days": "int"}
    )


@check(
    "first_non_blank",
    """
WITH p AS (
  SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '  ' ELSE p_name END AS a,
         CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN '' ELSE p_brand END AS b,
         p_type AS c
  FROM part)
SELECT p_partkey, COALESCE(NULLIF(rtrim(a), ''), NULLIF(rtrim(b), ''), c) AS usi,
       COALESCE(b, c) AS filled
FROM p""",
)
def q_first_non_blank(spark, sf):
    k = F.col("p_partkey")
    p = table(spark, sf, "part").select(
        k,
        F.when(k % 3 == 0, "  ").otherwise(F.col("p_name")).alias("a"),
        F.when(k % 5 == 0, None).when(k % 7 == 0, "").otherwise(F.col("p_brand")).alias("b"),
        F.col("p_type").alias("c"),
    )
    named = p.withColumn("usi", first_non_blank("a", "b", "c")).withColumn("filled", F.col("b"))
    return coalesce_from(named, {"filled": "c"}).select("p_partkey", "usi", "filled")


@check(
    "initial_status",
    """
WITH d AS (
  SELECT dsb_id, CASE WHEN n_escalations = 1 THEN 'Paid' END AS given,
         CASE WHEN source_tbl = 'PCI' THEN 'Email' ELSE dispute_type END AS kind
  FROM v_current)
SELECT dsb_id, kind, CASE WHEN given IS NOT NULL THEN given WHEN kind = 'Email' THEN 'Filed'
                          ELSE 'Pending Review' END AS first_status
FROM d""",
    ("v_current",),
)
def q_initial_status(spark, sf):
    d = v_current(spark, sf).select(
        "dsb_id",
        "source_tbl",
        F.when(F.col("n_escalations") == 1, "Paid").alias("given"),
        F.col("dispute_type").alias("kind"),
    )
    d = default_where(d, F.col("source_tbl") == "PCI", {"kind": "Email"})
    return d.select("dsb_id", "kind", initial_status("given", "kind").alias("first_status"))


@check(
    "audit_comment",
    """
SELECT line_id, 'New Dispute - ' || COALESCE(amount_txt, '') AS with_action, amount_txt AS plain,
       'Send to Audit' AS action_only, source_tbl || '_' || amount_txt AS null_kept
FROM v_sub""",
    ("v_sub",),
)
def q_audit_comment(spark, sf):
    return v_sub(spark, sf).select(
        "line_id",
        audit_comment("New Dispute", "amount_txt").alias("with_action"),
        audit_comment(None, "amount_txt").alias("plain"),
        audit_comment("Send to Audit", None).alias("action_only"),
        F.concat("source_tbl", F.lit("_"), "amount_txt").alias("null_kept"),
    )


@check(
    "action_split",
    """
SELECT source_tbl, action,
       CAST(SUM(CASE WHEN action IN ('view','click','purchase') THEN 1 ELSE 0 END) AS BIGINT) AS n_ok,
       CAST(SUM(CASE WHEN action IN ('view','click','purchase') THEN 0 ELSE 1 END) AS BIGINT) AS n_error
FROM v_sub GROUP BY source_tbl, action""",
    ("v_sub",),
)
def q_action_split(spark, sf):
    flagged = flag_unlisted(_sub(spark, sf), "action", ("view", "click", "purchase"))
    return outcome_summary(flagged, "source_tbl", "action").select(
        "source_tbl", "action", F.col("N_Ok").alias("n_ok"), F.col("N_Error").alias("n_error")
    )


@check(
    "eligible_disputes",
    """
SELECT dsb_id, display_status, dispute_type FROM v_current
WHERE status = 'Open' AND dispute_category = 'GRT CNR'
  AND (display_status IN ('Denied - Pending', 'Approved') OR dispute_type = 'Email')""",
    ("v_current",),
)
def q_eligible_disputes(spark, sf):
    rows = conform(v_current(spark, sf), [])
    found = clean(rows).filter(eligible(("Denied - Pending", "Approved"), CATEGORY))
    return found.select("dsb_id", "display_status", "dispute_type")


@check(
    "pending_queue",
    """
WITH q AS (
  SELECT o_orderkey, o_orderdate, NULLIF(o_orderstatus, 'P') AS a,
         NULLIF(o_orderpriority, '1-URGENT') AS b,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'x' END AS c
  FROM orders)
SELECT o_orderkey, CAST(a IS NULL AND b IS NULL AND c IS NULL AS INTEGER) AS waits_all,
       CAST(a IS NULL OR b IS NULL OR c IS NULL AS INTEGER) AS waits_any,
       CAST(CAST(o_orderdate AS DATE) = DATE '2001-07-31' AS INTEGER) AS today
FROM q WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'""",
)
def q_pending_queue(spark, sf):
    q = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderdate",
        F.nullif("o_orderstatus", F.lit("P")).alias("a"),
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("b"),
        F.when(F.col("o_orderkey") % 3 == 0, None).otherwise("x").alias("c"),
    )
    dated = q.filter(F.col("o_orderdate") > F.lit("1998-01-01").cast("timestamp_ntz"))
    return dated.select(
        "o_orderkey",
        pending(("a", "b", "c"), "all").cast("int").alias("waits_all"),
        pending(("a", "b", "c"), "any").cast("int").alias("waits_any"),
        same_day("o_orderdate", "2001-07-31").cast("int").alias("today"),
    )


@check(
    "tag_split",
    """
WITH w AS (SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS tag, o_totalprice - 200000 AS amt FROM orders)
SELECT o_orderkey, 'unmapped' AS slice FROM w WHERE tag = 'F' AND amt > 0
UNION ALL
SELECT o_orderkey, 'other' FROM w WHERE tag <> 'F' AND amt > 0""",
)
def q_tag_split(spark, sf):
    w = table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("tag"),
        (F.col("o_totalprice") - 200000).alias("amt"),
    )
    w = w.filter(positive("amt"))
    slice_of = F.when(tag_is("F", "tag"), "unmapped").when(tag_is_not("F", "tag"), "other")
    return w.select("o_orderkey", slice_of.alias("slice")).filter(F.col("slice").isNotNull())


@check(
    "validate_amount",
    """
SELECT line_id, CASE WHEN bad_number OR bad_sign THEN 'amount_txt' END AS error_columns,
       CASE WHEN bad_number THEN 'amount_txt is not numeric'
            WHEN bad_sign THEN 'amount_txt is <= 0' END AS error_message
FROM v_num""",
    ("v_num",),
)
def validate_amount(spark, sf):
    return _errors(validate(_sub(spark, sf), amount_rules("amount_txt")))


@check(
    "validate_date",
    """
SELECT line_id, CASE WHEN bad_date OR bad_eom OR bad_past THEN 'date_txt' END AS error_columns,
       CASE WHEN bad_date THEN 'date_txt is not a date'
            WHEN bad_eom THEN 'date_txt is not the end of the month'
            WHEN bad_past THEN 'date_txt is in the past' END AS error_message
FROM v_num""",
    ("v_num",),
)
def validate_date(spark, sf):
    return _errors(validate(_sub(spark, sf), date_rules("date_txt", EVENT_NOW)))


@check(
    "validate_bill_date",
    """
SELECT line_id,
       CASE WHEN bad_date OR LAST_DAY(day) > DATE '2024-02-29' THEN 'date_txt' END AS error_columns,
       CASE WHEN bad_date THEN 'date_txt is not a date'
            WHEN LAST_DAY(day) > DATE '2024-02-29' THEN 'date_txt is in the future' END AS error_message
FROM v_num""",
    ("v_num",),
)
def validate_bill_date(spark, sf):
    return _errors(validate(_sub(spark, sf), bill_date_rules("date_txt", EVENT_NOW)))


@check(
    "must_exist",
    """
SELECT s.line_id, CASE WHEN e.comp_serial IS NULL THEN 'Comp_Serial' END AS error_columns,
       CASE WHEN e.comp_serial IS NULL THEN 'Comp_Serial does not exist' END AS error_message
FROM v_sub s LEFT JOIN v_emp e ON e.comp_serial = s.comp_serial""",
    ("v_sub", "v_emp"),
)
def q_must_exist(spark, sf):
    return _errors(
        must_exist(
            _sub(spark, sf),
            v_emp(spark, sf),
            ["comp_serial"],
            "Comp_Serial",
            "Comp_Serial does not exist",
        )
    )


@check(
    "must_exist_text_key",
    """
SELECT l.l_orderkey * 10 + l.l_linenumber AS id,
       CASE WHEN s.s_suppkey IS NULL THEN 'not a supplier' END AS error_message
FROM lineitem l LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey AND s.s_suppkey % 3 <> 0""",
)
def q_must_exist_text_key(spark, sf):
    """Keys as padded text against a numeric key."""
    sub = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.concat(F.lit("00"), text("l_suppkey")).alias("key"),
    )
    ref = table(spark, sf, "supplier").filter("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("key"))
    judged = must_exist(conform(sub, []), ref, ["key"], "key", "not a supplier")
    return judged.select("id", F.col("Error_Message").alias("error_message"))


@check(
    "must_exist_typed",
    """
SELECT s.line_id,
       CASE WHEN c.dsb_id IS NULL OR c.dispute_type <> 'Email' THEN 'DSB_ID' END AS error_columns,
       CASE WHEN c.dsb_id IS NULL THEN 'DSB_ID does not exist in Dispute Current'
            WHEN c.dispute_type <> 'Email' THEN 'Dispute_Type is not Email for DSB_ID' END AS error_message
FROM v_sub s LEFT JOIN v_current c ON c.dsb_id = s.dsb_id""",
    ("v_sub", "v_current"),
)
def q_must_exist_typed(spark, sf):
    return _errors(
        must_exist_with(
            _sub(spark, sf),
            v_current(spark, sf),
            "dsb_id",
            F.col("dispute_type") != "Email",
            "DSB_ID",
            "DSB_ID does not exist in Dispute Current",
            "Dispute_Type is not Email for DSB_ID",
        )
    )


@check(
    "must_not_exist",
    """
SELECT s.line_id, CASE WHEN c.dsb_id IS NOT NULL THEN 'DSB_ID' END AS error_columns,
       CASE WHEN c.dsb_id IS NOT NULL THEN 'DSB_ID is already pending' END AS error_message
FROM v_sub s LEFT JOIN (SELECT dsb_id FROM v_current WHERE status = 'Open') c ON c.dsb_id = s.dsb_id""",
    ("v_sub", "v_current"),
)
def q_must_not_exist(spark, sf):
    waiting = v_current(spark, sf).filter(F.col("status") == "Open")
    return _errors(
        must_not_exist(
            _sub(spark, sf), waiting, ["dsb_id"], "DSB_ID", "DSB_ID is already pending"
        )
    )


@check(
    "cap_and_derive",
    """
WITH ok AS (SELECT DISTINCT dsb_id FROM v_current WHERE status = 'Open' AND dispute_category = 'GRT CNR')
SELECT s.line_id,
       CASE WHEN s.amount > 200 THEN 'amount_txt' WHEN ok.dsb_id IS NULL THEN 'DSB_ID' END AS error_columns,
       CASE WHEN s.amount > 200 THEN 'DN max day cap is 200 day(s)'
            WHEN ok.dsb_id IS NULL THEN 'There are no open disputes' END AS error_message
FROM v_num s LEFT JOIN ok ON ok.dsb_id = s.dsb_id""",
    ("v_num", "v_current"),
)
def q_cap_and_derive(spark, sf):
    capped = validate(_sub(spark, sf), [max_value("amount_txt", 200)])
    open_ones = v_current(spark, sf).filter(eligible(None, CATEGORY))
    return _errors(
        must_derive(capped, open_ones, ["dsb_id"], "DSB_ID", "There are no open disputes")
    )


@check(
    "propagate_error",
    """
WITH e AS (
  SELECT line_id, action, source_id,
         CASE WHEN bad_number THEN 'amount_txt is not numeric'
              WHEN bad_sign THEN 'amount_txt is <= 0' END AS msg
  FROM v_num),
f AS (
  SELECT action, source_id, ARG_MIN(msg, line_id) AS sibling FROM e WHERE msg IS NOT NULL
  GROUP BY action, source_id)
SELECT e.line_id, CASE WHEN e.msg IS NOT NULL OR f.sibling IS NOT NULL THEN 'amount_txt' END AS error_columns,
       COALESCE(e.msg, f.sibling) AS error_message
FROM e LEFT JOIN f ON f.action = e.action AND f.source_id = e.source_id""",
    ("v_num",),
)
def q_propagate_error(spark, sf):
    judged = validate(_sub(spark, sf), amount_rules("amount_txt"))
    return _errors(propagate_error(judged, ["action", "source_id"], "line_id"))


@check(
    "ticket_status",
    """
SELECT s.line_id,
       CASE WHEN NOT s.bad_number AND NOT s.bad_sign AND c.sid IS NOT NULL
            THEN CAST(c.c_custkey AS VARCHAR) || ' - ' || n.n_name ELSE s.amount_txt END AS ticket,
       CASE WHEN s.bad_number OR s.bad_sign OR c.sid IS NULL THEN 'ticket' END AS error_columns,
       CASE WHEN s.bad_number THEN 'ticket is not numeric' WHEN s.bad_sign THEN 'ticket is <= 0'
            WHEN c.sid IS NULL THEN 'ticket is not a known ticket' END AS error_message
FROM v_num s
LEFT JOIN (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS sid
           FROM customer) c ON c.c_custkey = CAST(s.amount AS BIGINT)
LEFT JOIN nation n ON n.n_nationkey = c.sid""",
    ("v_num",),
)
def q_ticket_status(spark, sf):
    key = F.col("c_custkey")
    core = table(spark, sf, "customer").select(
        key.alias("Ticket_ID"),
        F.when(key % 7 == 0, None).otherwise(F.col("c_nationkey")).alias("Ticket_Status_ID"),
    )
    status = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("Ticket_Status_ID"), F.col("n_name").alias("Status")
    )
    rows = _sub(spark, sf).withColumnRenamed("amount_txt", "ticket")
    checked = validate(rows, amount_rules("ticket"))
    return _errors(ticket_status(checked, core, status, "ticket"), "ticket")


@check(
    "outcome_summary",
    """
SELECT action, CAST(SUM(CASE WHEN bad_number OR bad_sign THEN 0 ELSE 1 END) AS BIGINT) AS n_ok,
       CAST(SUM(CASE WHEN bad_number OR bad_sign THEN 1 ELSE 0 END) AS BIGINT) AS n_error
FROM v_num GROUP BY action""",
    ("v_num",),
)
def q_outcome_summary(spark, sf):
    judged = validate(_sub(spark, sf), amount_rules("amount_txt"))
    return outcome_summary(judged, "action").select(
        "action", F.col("N_Ok").alias("n_ok"), F.col("N_Error").alias("n_error")
    )


@check(
    "employee_join",
    """
SELECT s.line_id, e.full_name, CAST(e.comp_serial IS NOT NULL AS INTEGER) AS in_inner
FROM v_sub s LEFT JOIN v_emp e ON e.comp_serial = s.comp_serial""",
    ("v_sub", "v_emp"),
)
def employee_join(spark, sf):
    joined = with_employee(v_sub(spark, sf), v_emp(spark, sf))
    return joined.select(
        "line_id",
        F.col("Full_Name").alias("full_name"),
        F.col("_has_employee").cast("int").alias("in_inner"),
    )


@check(
    "effective_join",
    """
SELECT n.n_name AS platform, r.r_name AS region, COUNT(*) AS n_rows,
       CAST(SUM(CASE WHEN b.ban IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_unmatched
FROM lineitem l
LEFT JOIN v_ban b ON b.ban = CAST(l.l_suppkey AS VARCHAR)
  AND LAST_DAY(CAST(l.l_shipdate AS DATE)) BETWEEN LAST_DAY(b.start_date)
      AND LAST_DAY(COALESCE(b.end_date, DATE '2001-08-15'))
LEFT JOIN nation n ON n.n_nationkey = b.platform_id
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
GROUP BY n.n_name, r.r_name""",
    ("v_ban",),
)
def effective_join(spark, sf):
    facts = table(spark, sf, "lineitem").select(
        text("l_suppkey").alias("ban"), F.col("l_shipdate").cast("date").alias("bill_date")
    )
    dated = join_effective(
        facts,
        v_ban(spark, sf),
        ORDER_NOW,
        "bill_date",
        {"master_id": "id", "platform_id": "platform_id"},
        key="ban",
        master_key="ban",
        start="start_date",
        end="end_date",
    )
    named = join_chain(
        dated,
        [
            (
                table(spark, sf, "nation"),
                {"platform_id": "n_nationkey"},
                {"platform": "n_name", "region_id": "n_regionkey"},
            ),
            (table(spark, sf, "region"), {"region_id": "r_regionkey"}, {"region": "r_name"}),
        ],
    )
    return named.groupBy("platform", "region").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("master_id").isNull()).alias("n_unmatched")
    )


@check(
    "pair_join",
    """
WITH f AS (SELECT source_tbl, source_id, MIN(line_id) AS line_id FROM v_sub GROUP BY source_tbl, source_id)
SELECT f.line_id, f.source_tbl, f.source_id, c.dsb_id
FROM f JOIN (SELECT * FROM v_current WHERE source_tbl = 'BMI') c
  ON c.source_tbl = f.source_tbl AND c.source_id = f.source_id""",
    ("v_sub", "v_current"),
)
def pair_join(spark, sf):
    keys = ["source_tbl", "source_id"]
    first = first_per(v_sub(spark, sf).select("line_id", *keys), keys, [F.col("line_id").asc()])
    disputes = v_current(spark, sf).filter(F.col("source_tbl") == "BMI").select(*keys, "dsb_id")
    found = lookup(disputes, first, keys, {"line_id": "line_id"}, own_shuffle=True)
    return found.filter(F.col("line_id").isNotNull()).select("line_id", *keys, "dsb_id")


def cost_tables(spark, sf):
    """Charge tables over the line items: recurring (R), one-time (A) and paper bills (N)."""
    items = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders")
    circuit = {"Vendor": 7, "BAN": 11, "Circuit_ID": 13}
    dated = F.col("l_shipdate").cast("date")
    return {
        "mrc": items.filter(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").alias("BMI_ID"),
            dated.alias("Invoice_Date"),
            F.col("l_partkey").alias("BDT_MRC_ID"),
            (F.col("l_extendedprice") - 20000).alias("Amount"),
        ),
        "occ": items.filter(F.col("l_returnflag") == "A").select(
            *[(F.col("l_orderkey") % n).alias(c) for c, n in circuit.items()],
            F.col("l_orderkey").alias("BTN"),
            dated.alias("Invoice_Date"),
            F.col("l_partkey").alias("BDT_OCC_ID"),
            F.lower("l_linestatus").alias("Activity_Type"),
            (F.col("l_extendedprice") - 20000).alias("Amount"),
        ),
        "bmi": orders.select(
            F.col("o_orderkey").alias("BMI_ID"),
            *[(F.col("o_orderkey") % n).alias(c) for c, n in circuit.items()],
            F.col("o_orderkey").alias("WTN"),
        ),
        "paper_cost": items.filter(F.col("l_returnflag") == "N").select(
            F.col("l_orderkey").alias("PCI_ID"),
            F.col("l_partkey").alias("Seed"),
            dated.alias("Bill_Date"),
            (F.col("l_quantity") - 25).alias("MRC"),
            (F.col("l_tax") * 100 - 4).alias("NRC"),
            (F.col("l_discount") * 100 - 5).alias("FRAC"),
        ),
    }


MINED_SQL = """
WITH sub AS (
  SELECT o_orderkey AS source_no, CASE WHEN o_custkey % 3 = 0 THEN 'PCI' ELSE 'BMI' END AS source_tbl,
         CAST(o_orderdate AS DATE) + 30 AS start_date
  FROM orders)
SELECT s.source_tbl, s.source_no, l.l_partkey AS seed, t.cost_type, t.record_type
FROM sub s JOIN lineitem l ON l.l_orderkey = s.source_no AND CAST(l.l_shipdate AS DATE) > s.start_date
JOIN (VALUES ('MRC', 'R', 'BMI'), ('OCC', 'A', 'BMI'), ('PC-MRC', 'N', 'PCI'), ('PC-NRC', 'N', 'PCI'),
             ('PC-FRAC', 'N', 'PCI')) AS k(cost_type, flag, tbl)
  ON k.flag = l.l_returnflag AND k.tbl = s.source_tbl
CROSS JOIN LATERAL (
  SELECT k.cost_type AS cost_type,
         CASE k.cost_type WHEN 'OCC' THEN upper(lower(l.l_linestatus)) WHEN 'MRC' THEN 'MRC'
              ELSE substr(k.cost_type, 4) END AS record_type,
         CASE k.cost_type WHEN 'PC-MRC' THEN l.l_quantity - 25 WHEN 'PC-NRC' THEN l.l_tax * 100 - 4
              WHEN 'PC-FRAC' THEN l.l_discount * 100 - 5 ELSE l.l_extendedprice - 20000 END AS amt) t
WHERE t.amt > 0"""


@check("mine_cost", MINED_SQL)
def q_mine_cost(spark, sf):
    sub = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Line_ID"),
        F.col("o_orderkey").alias("Source_No"),
        text("o_orderkey").alias("Source_ID"),
        F.when(F.col("o_custkey") % 3 == 0, "PCI").otherwise("BMI").alias("Source_TBL"),
        F.date_add(F.col("o_orderdate").cast("date"), 30).alias("Start_Date"),
    )
    return mine_cost(sub, cost_tables(spark, sf)).select(
        F.col("Source_TBL").alias("source_tbl"),
        F.col("Source_No").alias("source_no"),
        F.col("Seed").cast("bigint").alias("seed"),
        F.col("Cost_Type").alias("cost_type"),
        F.col("Record_Type").alias("record_type"),
    )


@check(
    "conditional_left",
    """
WITH p AS (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem)
SELECT o.o_orderkey, p.l_returnflag AS product
FROM orders o LEFT JOIN p ON o.o_orderstatus = 'F' AND p.l_orderkey = o.o_orderkey AND p.l_linenumber = 1""",
)
def conditional_left(spark, sf):
    products = (
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").distinct()
    )
    orders = table(spark, sf, "orders").withColumn("first_line", F.lit(1))
    return conditional_lookup(
        orders,
        products,
        F.col("o_orderstatus") == "F",
        {"o_orderkey": "l_orderkey", "first_line": "l_linenumber"},
        {"product": "l_returnflag"},
    ).select("o_orderkey", "product")


@check(
    "prior_version",
    """
SELECT s.line_id, c.dh_id, h.dispute_category, h.dispute_reason, h.escalate,
       CAST(h.dh_id IS NOT NULL AS INTEGER) AS has_prior
FROM v_sub s JOIN v_current c ON c.dsb_id = s.dsb_id LEFT JOIN v_history h ON h.dh_id = c.dh_id""",
    ("v_sub", "v_current", "v_history"),
)
def prior_version(spark, sf):
    current = v_current(spark, sf).select("dsb_id", "dh_id")
    touched = v_sub(spark, sf).select("line_id", "dsb_id").join(current, "dsb_id")
    found = lookup(
        touched,
        v_history(spark, sf),
        ["dh_id"],
        {c: c for c in ("dispute_category", "dispute_reason", "escalate")},
        "has_prior",
    )
    return found.select(
        "line_id",
        "dh_id",
        "dispute_category",
        "dispute_reason",
        "escalate",
        F.col("has_prior").cast("int").alias("has_prior"),
    )


@check("distinct_pairs", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_pairs(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_type").distinct()


@check(
    "latest_by",
    """
SELECT user_id, event_id, event_type FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t
WHERE rn = 1""",
)
def q_latest_by(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return latest_by(events, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type"
    )


@check(
    "first_per",
    """
SELECT source_id, display_status, dsb_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY source_id ORDER BY display_status, dsb_id DESC) AS rn
  FROM v_current) t
WHERE rn = 1""",
    ("v_current",),
)
def q_first_per(spark, sf):
    rows = v_current(spark, sf).select("source_id", "display_status", "dsb_id")
    return first_per(
        rows, ["source_id"], [F.col("display_status").asc(), F.col("dsb_id").desc()]
    )


@check(
    "collect_errors",
    """
SELECT DISTINCT comp_serial, action, CAST(NULL AS VARCHAR) AS date_txt,
       CASE WHEN bad_number THEN 'amount_txt is not numeric' ELSE 'amount_txt is <= 0' END AS error_message
FROM v_num WHERE bad_number OR bad_sign
UNION
SELECT DISTINCT comp_serial, CAST(NULL AS VARCHAR), date_txt, 'date_txt is not a date'
FROM v_num WHERE bad_date""",
    ("v_num",),
)
def q_collect_errors(spark, sf):
    rows = _sub(spark, sf)
    amounts = rejected(validate(rows, amount_rules("amount_txt"))).select(
        "comp_serial", "action", F.col("Error_Message").alias("error_message")
    )
    dates = rejected(validate(rows, date_rules("date_txt", EVENT_NOW)[:1])).select(
        "comp_serial", "date_txt", F.col("Error_Message").alias("error_message")
    )
    return collect_errors(amounts, dates).select(
        "comp_serial", "action", "date_txt", "error_message"
    )


@check(
    "explode_csv",
    """
WITH p AS (
  SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN p_brand ELSE replace(p_name, ' ', ', ') END AS items
  FROM part)
SELECT p_partkey, CAST(instr(items, ',') > 0 AS INTEGER) AS multi,
       unnest(string_split(replace(items, ', ', ','), ',')) AS item
FROM p""",
)
def q_explode_csv(spark, sf):
    k = F.col("p_partkey")
    listed = F.replace("p_name", F.lit(" "), F.lit(", "))
    p = table(spark, sf, "part").select(
        k, F.when(k % 4 == 0, F.col("p_brand")).otherwise(listed).alias("item")
    )
    return explode_csv(p, "item", "multi").select("p_partkey", "multi", "item")


@check(
    "date_helpers",
    """
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT o_orderkey, strftime(LAST_DAY(day), '%Y-%m-%d') AS month_end,
       strftime(LAST_DAY(CAST(date_trunc('month', day) - INTERVAL 1 MONTH AS DATE)), '%Y-%m-%d')
           AS previous_month_end,
       strftime(CAST(date_trunc('week', day) AS DATE) - 3, '%Y-%m-%d') AS batch_day,
       strftime(CAST(date_trunc('week', day) AS DATE) + 7, '%Y%m%d') AS next_batch,
       strftime(day + 15 - CAST(30 + o_orderkey % 5 AS INTEGER), '%Y-%m-%d') AS limit_day
FROM d""",
)
def date_helpers(spark, sf):
    d = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day")
    )
    limit = (F.col("o_orderkey") % 5 + 30).cast("int")
    return d.select(
        "o_orderkey",
        day_text(month_end("day")).alias("month_end"),
        day_text(previous_month_end("day")).alias("previous_month_end"),
        day_text(batch_date(F.col("day"))).alias("batch_day"),
        batch_label(F.col("day"), 7, 0).alias("next_batch"),
        day_text(F.date_add("day", F.lit(15) - limit)).alias("limit_day"),
    )


@check(
    "claim_numbers",
    """
SELECT l_orderkey, l_returnflag, '20010810_' || left(upper(l_returnflag || 'x'), 1)
       || CAST(l_orderkey AS VARCHAR) AS claim
FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem) t""",
)
def claim_numbers(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag").distinct()
    kind = F.upper(F.concat("l_returnflag", F.lit("x")))
    return rows.select(
        "l_orderkey",
        "l_returnflag",
        seed_claim_no(batch_label(F.lit("2001-08-15")), kind, "l_orderkey").alias("claim"),
    )


def seed_tables(spark, sf):
    """Cost tables in which seeds are looked up, over five of the given tables."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    part, supplier = table(spark, sf, "part"), table(spark, sf, "supplier")

    def named(prefix, key):
        return F.concat(F.lit(prefix), text(key))

    bill = F.lit("2001-07-31").cast("date")
    return {
        "paper_cost": orders.select(
            F.col("o_orderkey").alias("Seed"),
            F.col("o_custkey").alias("PCI_ID"),
            named("V", "o_custkey").alias("Vendor"),
            text("o_custkey").alias("BAN"),
            F.col("o_orderdate").cast("date").alias("Bill_Date"),
            F.col("o_orderstatus").alias("State"),
            money("o_totalprice").alias("MRC"),
            money(F.col("o_totalprice") + 1).alias("NRC"),
            money(F.col("o_totalprice") + 2).alias("FRAC"),
            F.when(F.col("o_orderkey") % 4 == 0, " ").otherwise(named("W", "o_orderkey")).alias("WTN"),
            F.when(F.col("o_orderkey") % 8 == 0, None)
            .otherwise(named("C", "o_orderkey"))
            .alias("Circuit_ID"),
            named("B", "o_orderkey").alias("BTN"),
        ),
        "mrc": customer.select(
            F.col("c_custkey").alias("BDT_MRC_ID"),
            F.col("c_nationkey").alias("BMI_ID"),
            bill.alias("Invoice_Date"),
            F.col("c_name").alias("Vendor"),
            F.col("c_mktsegment").alias("Platform"),
            text("c_nationkey").alias("BAN"),
            bill.alias("Bill_Date"),
            F.lit("TX").alias("State"),
            money("c_acctbal").alias("Amount"),
            named("U", "c_nationkey").alias("USOC"),
            F.col("c_mktsegment").alias("USOC_Description"),
            F.lit("").alias("WTN"),
            F.lit("").alias("Circuit_ID"),
            named("B", "c_custkey").alias("BTN"),
        ),
        "mrc_cmp": customer.select(
            F.col("c_custkey").alias("BDT_MRC_ID"),
            bill.alias("Invoice_Date"),
            named("CP", "c_custkey").alias("CPID"),
            F.col("c_nationkey").cast("long").alias("BANMasterID"),
        ),
        "occ": part.select(
            F.col("p_partkey").alias("BDT_OCC_ID"),
            F.lower("p_type").alias("Activity_Type"),
            F.col("p_brand").alias("Vendor"),
            F.col("p_type").alias("Platform"),
            text("p_size").alias("BAN"),
            bill.alias("Bill_Date"),
            F.lit("CA").alias("State"),
            money("p_retailprice").alias("Amount"),
            named("U", "p_size").alias("USOC"),
            F.col("p_name").alias("USOC_Description"),
            F.lit("PH").alias("Phrase_Code"),
            named("SO", "p_partkey").alias("SO"),
            named("PN", "p_partkey").alias("PON"),
            F.lit(None).cast("string").alias("BTN"),
            named("C", "p_partkey").alias("Circuit_ID"),
        ),
        "tas": supplier.select(
            F.col("s_suppkey").alias("BDT_TAS_ID"),
            F.col("s_name").alias("Vendor"),
            F.lit("P").alias("Platform"),
            text("s_nationkey").alias("BAN"),
            bill.alias("Bill_Date"),
            F.lit("NY").alias("State"),
            money("s_acctbal").alias("Total_Amount"),
            named("J", "s_nationkey").alias("Jurisdiction_Phrase"),
        ),
        "usage": orders.select(
            F.col("o_orderkey").alias("BDT_USAGE_ID"),
            F.col("o_orderpriority").alias("Vendor"),
            F.lit("P").alias("Platform"),
            text("o_custkey").alias("BAN"),
            F.col("o_orderdate").cast("date").alias("Bill_Date"),
            F.lit("FL").alias("State"),
            money("o_totalprice").alias("Amount"),
            F.lit("").alias("BTN"),
            F.lit("0.5").alias("Usage_Rate"),
            F.col("o_orderstatus").alias("Jurisdiction"),
        ),
        "lpc": customer.select(
            F.col("c_custkey").alias("BDT_INVOICE_ID"),
            F.col("c_name").alias("Vendor"),
            F.col("c_mktsegment").alias("Platform"),
            text("c_nationkey").alias("BAN"),
            bill.alias("Bill_Date"),
            F.lit("WA").alias("State"),
            money("c_acctbal").alias("Late_Payment_Charges"),
        ),
        "adj": part.select(
            F.col("p_partkey").alias("BDT_PAD_ID"),
            F.col("p_brand").alias("Vendor"),
            F.col("p_type").alias("Platform"),
            text("p_size").alias("BAN"),
            bill.alias("Bill_Date"),
            F.lit("OR").alias("State"),
            money("p_retailprice").alias("Amount"),
            F.lit("AD").alias("Phrase_Code"),
        ),
    }


def seed_rows(spark, sf):
    """Seed submissions of every cost type and one unknown type."""
    n = F.col("line_id")
    kinds = ["PC-MRC", "PC-NRC", "PC-FRAC", "MRC", "OCC", "TAS", "USAGE", "LPC", "ADJ", "NONE"]
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (n % 10 + 1).cast("int"))
    return v_sub(spark, sf).select(
        n.alias("Line_ID"),
        kind.alias("Cost_Type"),
        F.when(n % 10 == 5, F.col("source_id")).otherwise(text(n)).alias("Cost_Type_Seed"),
        F.when(n % 3 == 0, F.lit("1.00")).alias("Dispute_Amt"),
        F.when(n % 4 == 0, F.lit("  ")).when(n % 7 == 0, F.lit("usi")).alias("USI"),
        F.when(n % 6 == 0, F.lit("mine")).alias("USOC"),
        F.lit("own").alias("Platform"),
        F.lit("old").alias("Vendor"),
        F.col("comp_serial").alias("Comp_Serial"),
    )


ENRICHED_SQL = """
WITH s AS (
  SELECT line_id,
         list_extract(['PC-MRC','PC-NRC','PC-FRAC','MRC','OCC','TAS','USAGE','LPC','ADJ','NONE'],
                      CAST(line_id % 10 + 1 AS INTEGER)) AS cost_type,
         CASE WHEN line_id % 10 = 5 THEN CAST(source_id AS BIGINT) ELSE line_id END AS seed,
         CASE WHEN line_id % 3 = 0 THEN '1.00' END AS dispute_amt,
         CASE WHEN line_id % 4 = 0 THEN '  ' WHEN line_id % 7 = 0 THEN 'usi' END AS usi,
         CASE WHEN line_id % 6 = 0 THEN 'mine' END AS usoc, comp_serial
  FROM v_sub),
c AS (
  SELECT k.t AS cost_type, o_orderkey AS seed, substr(k.t, 4) AS record_type,
         'V' || CAST(o_custkey AS VARCHAR) AS vendor, NULL AS platform,
         CAST(o_custkey AS VARCHAR) AS ban, CAST(o_orderdate AS DATE) AS bill_date,
         CAST(CAST(o_totalprice + k.n AS DECIMAL(18,2)) AS VARCHAR) AS amt,
         CASE WHEN o_orderkey % 4 <> 0 THEN 'W' || CAST(o_orderkey AS VARCHAR)
              WHEN o_orderkey % 8 <> 0 THEN 'C' || CAST(o_orderkey AS VARCHAR)
              ELSE 'B' || CAST(o_orderkey AS VARCHAR) END AS usi,
         NULL AS usoc, NULL AS phrase, NULL AS jurisdiction, NULL AS cpid, 'PCI' AS tbl,
         CAST(o_custkey AS VARCHAR) AS sid
  FROM orders CROSS JOIN (VALUES ('PC-MRC', 0), ('PC-NRC', 1), ('PC-FRAC', 2)) AS k(t, n)
  UNION ALL
  SELECT 'MRC', c_custkey, 'MRC', c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR), DATE '2001-07-31',
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), 'B' || CAST(c_custkey AS VARCHAR),
         'U' || CAST(c_nationkey AS VARCHAR), NULL, NULL, 'CP' || CAST(c_custkey AS VARCHAR), 'BMI',
         CAST(c_nationkey AS VARCHAR)
  FROM customer
  UNION ALL
  SELECT 'OCC', p_partkey, upper(p_type), p_brand, p_type, CAST(p_size AS VARCHAR), DATE '2001-07-31',
         CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), 'C' || CAST(p_partkey AS VARCHAR),
         'U' || CAST(p_size AS VARCHAR), 'PH', NULL, NULL, NULL, NULL
  FROM part
  UNION ALL
  SELECT 'TAS', s_suppkey, 'TAS', s_name, 'P', CAST(s_nationkey AS VARCHAR), DATE '2001-07-31',
         CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR), NULL, NULL, NULL,
         'J' || CAST(s_nationkey AS VARCHAR), NULL, NULL, NULL
  FROM supplier
  UNION ALL
  SELECT 'USAGE', o_orderkey, 'USAGE', o_orderpriority, 'P', CAST(o_custkey AS VARCHAR),
         CAST(o_orderdate AS DATE), CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '', NULL, NULL,
         o_orderstatus, NULL, NULL, NULL
  FROM orders
  UNION ALL
  SELECT 'LPC', c_custkey, 'LPC', c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR), DATE '2001-07-31',
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM customer
  UNION ALL
  SELECT 'ADJ', p_partkey, 'ADJ', p_brand, p_type, CAST(p_size AS VARCHAR), DATE '2001-07-31',
         CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), NULL, NULL, 'AD', NULL, NULL, NULL, NULL
  FROM part)
SELECT s.line_id, s.cost_type,
       CASE WHEN s.cost_type = 'NONE' THEN 'old' ELSE c.vendor END AS vendor,
       CASE WHEN s.cost_type = 'NONE' OR s.cost_type LIKE 'PC-%' THEN 'own' ELSE c.platform END AS platform,
       c.record_type, c.ban, strftime(c.bill_date, '%Y-%m-%d') AS bill_date, c.amt AS billed_amt,
       COALESCE(s.dispute_amt, c.amt) AS dispute_amt,
       CASE WHEN s.cost_type IN ('NONE', 'TAS', 'LPC', 'ADJ') OR NULLIF(rtrim(s.usi), '') IS NOT NULL
            THEN s.usi ELSE c.usi END AS usi,
       COALESCE(s.usoc, c.usoc) AS usoc, c.phrase AS phrase_code, c.jurisdiction, c.cpid,
       c.tbl AS source_tbl, c.sid AS source_id,
       CASE WHEN s.cost_type <> 'NONE' AND c.seed IS NULL THEN 'Cost_Type_Seed does not exist' END
           AS error_message
FROM s LEFT JOIN c ON c.cost_type = s.cost_type AND c.seed = s.seed"""


@check("enrich_by_type", ENRICHED_SQL, ("v_sub",))
def enrich_by_type(spark, sf):
    rows = conform(seed_rows(spark, sf), SEED_COLUMNS)
    done = enrich_by_cost_type(rows, seed_tables(spark, sf))
    return done.select(
        F.col("Line_ID").alias("line_id"),
        *[
            F.col(c).alias(c.lower())
            for c in (
                "Cost_Type",
                "Vendor",
                "Platform",
                "Record_Type",
                "BAN",
                "Bill_Date",
                "Billed_Amt",
                "Dispute_Amt",
                "USI",
                "USOC",
                "Phrase_Code",
                "Jurisdiction",
                "CPID",
                "Source_TBL",
                "Source_ID",
                "Error_Message",
            )
        ],
    )


@check(
    "assign_ids",
    "SELECT o_orderkey, o_custkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS id FROM orders",
)
def q_assign_ids(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return assign_ids(orders, ["o_orderkey"], 1, "id")


@check(
    "apply_updates",
    """
SELECT c.dsb_id, CASE WHEN s.dsb_id IS NOT NULL THEN 'Closed' ELSE c.status END AS status,
       CASE WHEN s.dsb_id IS NOT NULL THEN s.action ELSE c.display_status END AS display_status,
       CASE WHEN s.dsb_id IS NOT NULL THEN CAST(s.amount AS DOUBLE) ELSE c.dispute_amount END
           AS dispute_amount
FROM v_current c LEFT JOIN v_num s ON s.dsb_id = c.dsb_id""",
    ("v_current", "v_num"),
)
def q_apply_updates(spark, sf):
    changes = v_sub(spark, sf).select(
        "dsb_id",
        F.lit("Closed").alias("status"),
        F.col("action").alias("display_status"),
        to_money("amount_txt").alias("dispute_amount"),
    )
    target = v_current(spark, sf).select("dsb_id", "status", "display_status", "dispute_amount")
    return apply_updates(
        target, changes, ["dsb_id"], ["status", "display_status", "dispute_amount"], unique=True
    )


@check(
    "assign_reps",
    """
WITH pick AS (
  SELECT source_tbl, source_id, disputer FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY source_tbl, source_id
                                 ORDER BY disputer, date_submitted DESC) AS rn FROM v_current) t
  WHERE rn = 1)
SELECT s.line_id, CASE WHEN NOT s.bad_number AND NOT s.bad_sign THEN p.disputer END AS assigned_to
FROM v_num s LEFT JOIN pick p ON p.source_tbl = s.source_tbl AND p.source_id = s.source_id""",
    ("v_num", "v_current"),
)
def q_assign_reps(spark, sf):
    rows = validate(_sub(spark, sf), amount_rules("amount_txt"))
    offers = v_current(spark, sf).select(
        "source_tbl",
        "source_id",
        F.col("disputer").alias("Assign_Rep"),
        F.col("date_submitted").alias("Date_Submitted"),
    )
    done = assign_reps(rows, offers, ["source_tbl", "source_id"])
    return done.select("line_id", F.col("Assigned_To").alias("assigned_to"))


@check(
    "default_start",
    """
WITH s AS (
  SELECT o.o_orderkey, CASE WHEN o.o_orderkey % 2 = 0 THEN CAST(o.o_orderdate AS DATE)
         ELSE DATE '2001-08-15' + 15 - CAST(30 + 10 * c.c_nationkey AS INTEGER) END AS d
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey)
SELECT o_orderkey, strftime(LAST_DAY(CAST(date_trunc('month', d) - INTERVAL 1 MONTH AS DATE)),
                            '%Y-%m-%d') AS start_date
FROM s""",
)
def q_default_start(spark, sf):
    orders = table(spark, sf, "orders")
    sub = orders.select(
        "o_orderkey",
        F.col("o_orderkey").alias("Source_No"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate").cast("date")).alias("Start_Date"),
    )
    inventory = orders.select(F.col("o_orderkey").alias("BMI_ID"), text("o_custkey").alias("BAN"))
    limits = table(spark, sf, "customer").select(
        text("c_custkey").alias("BAN"), (F.col("c_nationkey") * 10 + 30).alias("Dispute_Limit")
    )
    done = default_start(sub, inventory, limits, ORDER_NOW)
    return done.select("o_orderkey", day_text("Start_Date").alias("start_date"))


@check(
    "apply_mapping",
    """
SELECT p_partkey AS bmi_id,
       CASE WHEN p_size > 10 THEN CASE WHEN p_size > 25 THEN CAST(p_partkey AS VARCHAR) ELSE p_name END
            ELSE p_brand END AS gs_srvid,
       CASE WHEN p_size > 10 THEN CASE WHEN p_size > 25 THEN
                 CASE WHEN p_size > 40 THEN 'M2M' ELSE 'BMB' END ELSE 'LL' END
            ELSE p_type END AS gs_srvtype,
       CASE WHEN p_size > 10 THEN 'ABC' END AS frameid
FROM part""",
)
def q_apply_mapping(spark, sf):
    part = table(spark, sf, "part")
    target = part.select(
        F.col("p_partkey").alias("BMI_ID"),
        F.col("p_brand").alias("gs_SrvID"),
        F.col("p_type").alias("gs_SrvType"),
        F.lit(None).cast("string").alias("frameID"),
        F.lit(None).cast("timestamp_ntz").alias("Edit_Date"),
    )
    mapped = part.filter(F.col("p_size") > 10).select(
        F.col("p_partkey").alias("Line_ID"),
        F.col("p_partkey").alias("Source_No"),
        F.col("p_partkey").alias("Source_ID"),
        F.when(F.col("p_size") > 40, "PCI").otherwise("BMI").alias("Source_TBL"),
        (F.col("p_size") > 25).cast("int").alias("BMB"),
        F.col("p_name").alias("Gs_SrvID"),
        F.lit("LL").alias("Gs_SrvType"),
        F.lit("ABC").alias("Initials"),
    )
    done = apply_mapping(target, mapped, "BMI_ID", ORDER_NOW, stamp_frame=True)
    return done.select(
        F.col("BMI_ID").alias("bmi_id"),
        F.col("gs_SrvID").alias("gs_srvid"),
        F.col("gs_SrvType").alias("gs_srvtype"),
        F.col("frameID").alias("frameid"),
    )


def worklist(spark, sf):
    """Worklist items over the orders, some tagged unmapped, some without a tag."""
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.when(key % 4 == 0, "PCI").otherwise("BMI").alias("Source_TBL"),
        text(key).alias("Source_ID"),
        F.when(F.col("o_orderstatus") == "F", "unmapped")
        .when(F.col("o_orderstatus") == "O", "zero")
        .alias("TAG"),
        F.col("o_orderdate").cast("date").alias("Max_CNR_Date"),
        F.col("o_orderpriority").alias("Vendor"),
        text("o_custkey").alias("BAN"),
        F.concat(F.lit("B"), text(key)).alias("BTN"),
        F.concat(F.lit("W"), text(key)).alias("WTN"),
        F.concat(F.lit("C"), text(key)).alias("Circuit_ID"),
        money("o_totalprice").alias("MRC_Amount"),
        F.lit(None).cast("string").alias("Audit_Result"),
        F.lit(None).cast("string").alias("Rep"),
        F.lit(None).cast("string").alias("Comment"),
        F.lit(None).cast("timestamp_ntz").alias("Edit_Date"),
    )


WORKLIST_SQL = """
SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'PCI' ELSE 'BMI' END AS source_tbl,
       CAST(o_orderkey AS VARCHAR) AS source_id,
       CASE o_orderstatus WHEN 'F' THEN 'unmapped' WHEN 'O' THEN 'zero' END AS tag,
       CAST(o_orderdate AS DATE) AS max_cnr_date
FROM orders"""


def _stamped(spark, sf):
    rows = with_employee(
        validate(_sub(spark, sf), amount_rules("amount_txt")), v_emp(spark, sf)
    )
    return stamp_worklist(
        rows, worklist(spark, sf), "Dispute Review", EVENT_NOW, "reason", "New Dispute"
    )


@check(
    "stamp_worklist",
    f"""
WITH w AS ({WORKLIST_SQL})
SELECT s.line_id, w.source_tbl, w.source_id, w.tag,
       CASE WHEN w.tag <> 'unmapped' THEN strftime(w.max_cnr_date, '%Y-%m-%d') END AS invoice_date,
       'Dispute Review' AS audit_result, e.initials AS rep, 'New Dispute - ' || s.reason AS comment
FROM v_num s JOIN v_emp e ON e.comp_serial = s.comp_serial
JOIN w ON w.source_tbl = s.source_tbl AND w.source_id = s.source_id
WHERE NOT s.bad_number AND NOT s.bad_sign AND w.tag IS NOT NULL""",
    ("v_num", "v_emp"),
)
def q_stamp_worklist(spark, sf):
    unmapped, zero, _ = _stamped(spark, sf)
    both = zero.unionByName(
        unmapped.withColumns(
            {"Invoice_Date": F.lit(None).cast("date"), "Tag": F.lit("unmapped")}
        )
    )
    return both.select(
        F.col("Line_ID").alias("line_id"),
        F.col("Source_TBL").alias("source_tbl"),
        F.col("Source_ID").alias("source_id"),
        F.col("Tag").alias("tag"),
        day_text("Invoice_Date").alias("invoice_date"),
        F.col("Audit_Result").alias("audit_result"),
        F.col("Rep").alias("rep"),
        F.col("Comment").alias("comment"),
    )


@check(
    "worklist_snapshot",
    f"""
WITH w AS ({WORKLIST_SQL}),
last AS (
  SELECT s.source_tbl, s.source_id, MAX(s.line_id) AS line_id
  FROM v_num s JOIN v_emp e ON e.comp_serial = s.comp_serial
  WHERE NOT s.bad_number AND NOT s.bad_sign GROUP BY s.source_tbl, s.source_id)
SELECT w.source_tbl, w.source_id, w.tag,
       CASE WHEN w.tag IS NOT NULL AND l.line_id IS NOT NULL THEN 'Dispute Review' END AS audit_result,
       CASE WHEN w.tag IS NOT NULL THEN e.initials END AS rep,
       CASE WHEN w.tag IS NOT NULL THEN 'New Dispute - ' || s.reason END AS comment
FROM w LEFT JOIN last l ON l.source_tbl = w.source_tbl AND l.source_id = w.source_id
LEFT JOIN v_num s ON s.line_id = l.line_id LEFT JOIN v_emp e ON e.comp_serial = s.comp_serial""",
    ("v_num", "v_emp"),
)
def worklist_snapshot(spark, sf):
    snapshot = _stamped(spark, sf)[2]
    return snapshot.select(
        F.col("Source_TBL").alias("source_tbl"),
        F.col("Source_ID").alias("source_id"),
        F.col("TAG").alias("tag"),
        F.col("Audit_Result").alias("audit_result"),
        F.col("Rep").alias("rep"),
        F.col("Comment").alias("comment"),
    )


@check(
    "submission_outcome",
    """
SELECT s.action,
       CAST(SUM(CASE WHEN NOT bad_number AND NOT bad_sign AND e.comp_serial IS NOT NULL THEN 1 ELSE 0 END)
            AS BIGINT) AS n_ok,
       CAST(SUM(CASE WHEN NOT bad_number AND NOT bad_sign AND e.comp_serial IS NOT NULL THEN 0 ELSE 1 END)
            AS BIGINT) AS n_error
FROM v_num s LEFT JOIN v_emp e ON e.comp_serial = s.comp_serial GROUP BY s.action""",
    ("v_num", "v_emp"),
)
def submission_outcome(spark, sf):
    """conform, validate, employee join and summary in one plan."""
    rows = trim_all(conform(v_sub(spark, sf), ["comment"]))
    judged = validate(
        with_employee(rows, v_emp(spark, sf)), [*amount_rules("amount_txt"), known_employee()]
    )
    return outcome_summary(judged, "action").select(
        "action", F.col("N_Ok").alias("n_ok"), F.col("N_Error").alias("n_error")
    )
