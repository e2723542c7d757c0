"""Jobs of the review folder: what a rep may do with a worklist item."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.config import COST_TYPES, REVIEW_CATEGORY, JobConfig
from ledgerflow.functions import as_moment, month_end, same_day, to_day
from ledgerflow.functions.dates import AsOf
from ledgerflow.operators.conform import (
    ERROR_COLUMNS,
    ERROR_MESSAGE,
    as_action_rows,
    conform,
    trim_all,
    with_source,
)
from ledgerflow.operators.filters import clean, eligible, flag_unlisted, pending, rejected
from ledgerflow.operators.joins import conditional_lookup, lookup, narrow
from ledgerflow.operators.keys import stable
from ledgerflow.operators.mining import mine_cost
from ledgerflow.operators.relational import explode_csv, latest_by, union_all
from ledgerflow.operators.updates import (
    apply_mapping,
    assign_reps,
    default_start,
    stamp_worklist,
)
from ledgerflow.operators.validate import (
    Rule,
    amount_rules,
    date_rules,
    flag_repeats,
    is_date,
    max_value,
    must_derive,
    must_exist,
    must_not_exist,
    propagate_error,
    ticket_status,
    validate,
)
from ledgerflow.plans.dispute import check_employee, review_seed_disputes
from ledgerflow.plans.tables import JobResult, Tables
from ledgerflow.plans.transitions import Transition, transition

# The columns a review file is padded to.
REVIEW_COLUMNS = (
    "Action",
    "Source_TBL",
    "Source_ID",
    "Gs_SrvType",
    "Gs_SrvID",
    "Action_Comment",
    "Action_Norm_Reason",
    "Action_Reason",
    "USI",
    "Start_Date",
    "Claim_Channel",
    "Confidence",
    "PON",
    "Macnum",
    "Audit_Group",
    "Prov_Category",
    "Prov_Recommendation",
    "Prov_Norm_Reason",
    "Prov_Sub_Reason",
    "Amount_Or_Days",
    "Credit_Invoice_Date",
    "Vendor",
    "Platform",
    "BAN",
    "Bill_Date",
    "State",
    "Billed_Amt",
    "Dispute_Amt",
    "USOC",
    "USOC_Desc",
    "CPID",
    "BANMaster_ID",
    "Phrase_Code",
    "Causing_SO",
    "Jurisdiction",
    "Usage_Rate",
    "Ticket",
)

# Service type to the key column of its master table.
SERVICE_KEYS = {
    "LL": "ORD_WTN",
    "BRD": "ORD_BRD_ID",
    "DED": "CUS_DED_ID",
    "LD": "ORD_WTN",
    "TF": "ORD_POTS_ANI_BIL",
}

SOURCE = ("Source_TBL", "Source_ID")
SOURCE_TEXT = "Source_TBL, Source_ID"
SERVICE_TEXT = "Gs_SrvType, Gs_SrvID"
REPEATED = "Source_ID was already given for this action"


def review_rows(sub: DataFrame, tables: Tables, folder: str = "01_BMI-PCI") -> DataFrame:
    """Padded, trimmed review rows with the submitter's names; unknown submitters flagged."""
    rows = with_source(trim_all(conform(sub, REVIEW_COLUMNS)), folder)
    rows = rows.withColumn("Source_No", F.col("Source_ID").cast("string").try_cast("bigint"))
    return check_employee(rows, tables)


def one_per_source(rows: DataFrame) -> DataFrame:
    """A source is acted on once per file; later rows of the same source are errors.

    The judged rows are used by several joins, so they are written once.
    """
    return stable(flag_repeats(rows, SOURCE, "Line_ID", SOURCE_TEXT, REPEATED))


def open_disputes(rows: DataFrame, tables: Tables, statuses: Iterable[str] | None) -> DataFrame:
    """The open review disputes of the clean rows' sources, as a stable copy.

    This is the only read of the current state before its new snapshot: the
    checks, the join to the rows and the transition all work on the copy.
    """
    current = tables["dispute_current"].filter(eligible(statuses, REVIEW_CATEGORY))
    return stable(narrow(current, clean(rows), SOURCE))


def _stamp(
    result: JobResult,
    rows: DataFrame,
    tables: Tables,
    audit_result: Column | str,
    as_of: AsOf,
    comment: str | None = None,
    action: str | None = None,
) -> JobResult:
    """Log the rows against the worklist and stamp it."""
    unmapped, zero_revenue, worklist = stamp_worklist(
        rows, tables["worklist"], audit_result, as_of, comment, action
    )
    for source, prefix in (("BMI", ""), ("PCI", "pci_")):
        for name, log in (("unmapped", unmapped), ("zero_revenue", zero_revenue)):
            part = log.filter(F.col("Source_TBL") == source)
            table = prefix + name
            old = result.appends.get(table)
            result.appends[table] = part if old is None else union_all(old, part)
    result.snapshots["worklist"] = worklist
    return result


def settle(rows: DataFrame, step: Transition) -> DataFrame:
    """The rows with one outcome each: a row of which no dispute moved is an error.

    It gets the error of its failed dispute of the lowest DSB_ID. A row of which some
    disputes moved counts as done; what failed is in the transition's results.
    """
    failed = F.col(ERROR_COLUMNS).isNotNull()
    why = F.struct(F.col(ERROR_COLUMNS).alias("c"), F.col(ERROR_MESSAGE).alias("m"))
    fates = step.results.groupBy("Line_ID").agg(
        F.count_if(~failed).alias("_moved"), F.min_by(F.when(failed, why), F.when(failed, F.col("DSB_ID"))).alias("_why")
    )
    judged = lookup(rows, fates, ["Line_ID"], {"_n": "_moved", "_why": "_why"}, own_shuffle=True)
    lost = (F.col("_n") == 0) & F.col("_why").isNotNull()
    return validate(judged, [Rule(F.col("_why.c"), F.col("_why.m"), lost)]).drop("_n", "_why")


def _moved(rows: DataFrame, step: Transition, tables: Tables) -> JobResult:
    return JobResult(
        rows,
        {"dispute_history": step.history, "dispute_notes": step.notes},
        {"dispute_current": step.snapshot(tables["dispute_current"])},
        {"dispute_current": step.changes},
        counters=dict(step.counters),
    )


def _act_on_disputes(
    rows: DataFrame,
    tables: Tables,
    as_of: AsOf,
    action: str,
    statuses: Iterable[str] | None,
    message: str,
    config: JobConfig,
    starts: Mapping[str, int] | None,
) -> tuple[DataFrame, Transition]:
    """Find the disputes of each row, flag rows that have none, and move the disputes."""
    rows = one_per_source(rows)
    disputes = open_disputes(rows, tables, statuses)
    rows = must_derive(rows, disputes, SOURCE, SOURCE_TEXT, message)
    actions = (
        clean(rows)
        .drop("Full_Name", "Initials")
        .join(disputes.select(*SOURCE, "DSB_ID"), list(SOURCE))
        .withColumn("Action", F.lit(action))
    )
    work = {**tables, "dispute_current": disputes}
    step = transition(actions, work, as_of, [action], config, starts, distinct=True)
    return stable(settle(rows, step)), step


def escalate_job(
    sub: DataFrame,
    tables: Tables,
    as_of: AsOf,
    config: JobConfig = JobConfig(),
    starts: Mapping[str, int] | None = None,
) -> JobResult:
    rows, step = _act_on_disputes(
        review_rows(sub, tables),
        tables,
        as_of,
        "Escalate",
        ("Denied - Pending",),
        "There are no open Denied - Pending/Email GRT CNR disputes for this "
        "Source_TBL & Source_ID combo",
        config,
        starts,
    )
    return _stamp(
        _moved(rows, step, tables),
        rows,
        tables,
        "Dispute Review",
        as_of,
        "Action_Reason",
        "GRT Escalate",
    )


def paid_job(
    sub: DataFrame,
    tables: Tables,
    as_of: AsOf,
    config: JobConfig = JobConfig(),
    starts: Mapping[str, int] | None = None,
) -> JobResult:
    rules = [*amount_rules("Amount_Or_Days"), *date_rules("Credit_Invoice_Date", as_of)]
    rows, step = _act_on_disputes(
        validate(review_rows(sub, tables), rules),
        tables,
        as_of,
        "Paid",
        ("Denied - Pending", "Approved", "Partial Approved"),
        "There are no open Denied - Pending or Approved GRT CNR disputes for this Source_ID",
        config,
        starts,
    )
    return _stamp(
        _moved(rows, step, tables), rows, tables, "Dispute Review", as_of, None, "GRT Paid"
    )


def close_job(
    sub: DataFrame,
    tables: Tables,
    as_of: AsOf,
    config: JobConfig = JobConfig(),
    starts: Mapping[str, int] | None = None,
) -> JobResult:
    rows, step = _act_on_disputes(
        review_rows(sub, tables),
        tables,
        as_of,
        "Close",
        ("Denied - Pending",),
        "There are no open Denied - Pending GRT CNR disputes for this Source_ID",
        config,
        starts,
    )
    return _stamp(
        _moved(rows, step, tables), rows, tables, "Dispute Review", as_of, None, "GRT Closed"
    )


def note_job(
    sub: DataFrame,
    tables: Tables,
    as_of: AsOf,
    config: JobConfig = JobConfig(),
    starts: Mapping[str, int] | None = None,
) -> JobResult:
    """A note on every open dispute of the source, at most one per source and day."""
    rows = review_rows(sub, tables)
    current = tables["dispute_current"].filter(eligible(None, REVIEW_CATEGORY))
    today = tables["dispute_notes"].filter(same_day("Edit_Date", as_of)).select("DSB_ID")
    noted = narrow(current, today, ["DSB_ID"]).select(*SOURCE)
    rows = must_not_exist(
        rows,
        noted,
        SOURCE,
        SOURCE_TEXT,
        "Dispute Notes were already filed for this Source_ID today",
    )
    rules = [
        *amount_rules("Amount_Or_Days"),
        max_value("Amount_Or_Days", config.note_day_limit),
    ]
    rows, step = _act_on_disputes(
        validate(rows, rules),
        tables,
        as_of,
        "Dispute Note",
        None,
        "There are no open STC filed GRT CNR disputes for this Source_TBL & Source_ID combo",
        config,
        starts,
    )
    return _stamp(
        _moved(rows, step, tables),
        rows,
        tables,
        "Dispute Review",
        as_of,
        "Action_Reason",
        "Dispute Note",
    )


def _queue_job(
    sub: DataFrame,
    tables: Tables,
    as_of: AsOf,
    queue: str,
    waiting: Column,
    pending_message: str,
    note: str,
    note_days: int,
    config: JobConfig,
    starts: Mapping[str, int] | None,
) -> tuple[DataFrame, Transition]:
    """Common part of the outbound queues: checks, note on open disputes, rep pick."""
    rows = review_rows(sub, tables)
    rows = must_exist(
        rows, tables["cust_file"], ["Macnum"], "Macnum", "This Macnum is not a known customer"
    )
    rows = must_not_exist(
        rows, tables[queue].filter(waiting), SOURCE, SOURCE_TEXT, pending_message
    )
    rows = one_per_source(rows)
    disputes = open_disputes(rows, tables, ("Denied - Pending",))
    offered = disputes.select(
        *SOURCE, "DSB_ID", "Date_Submitted", F.col("Disputer").alias("Assign_Rep")
    )
    rows = assign_reps(rows, offered, SOURCE)
    actions = (
        as_action_rows(
            clean(rows).drop("Full_Name", "Initials"),
            {
                "Action": "Dispute Note",
                "Action_Norm_Reason": note,
                "Amount_Or_Days": str(note_days),
            },
            {"Note_Tag": "string", "Attachment": "string"},
        )
        .join(offered.drop("Date_Submitted"), list(SOURCE))
    )
    wide = replace(config, note_day_limit=max(config.note_day_limit, note_days))
    work = {**tables, "dispute_current": disputes}
    step = transition(actions, work, as_of, ["Dispute Note"], wide, starts, distinct=True)
    return stable(settle(rows, step)), step


def work_items(tables: Tables, rows: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The distinct worklist rows of the submitted sources."""
    items = narrow(tables["worklist"], clean(rows), SOURCE)
    return items.select(*SOURCE, *[F.col(v).alias(k) for k, v in columns.items()]).distinct()


def products_of(listed: DataFrame, mrc: DataFrame) -> DataFrame:
    """The products billed to the listed sources in the months that the worklist names.

    `listed` is a written frame. The first and last month are literals, which prune the
    partitions of a table laid out by date; source and month cut what is left.
    """
    asked = listed.filter(F.col("Source_TBL") == "BMI").select("Source_No", "Max_CNR_Date")
    day = F.col("Max_CNR_Date").cast("date")
    first, last = asked.agg(F.min(day), F.max(day)).first()
    dated = mrc.filter(F.col("Invoice_Date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    own = narrow(dated, asked, {"Source_No": "BMI_ID", "Max_CNR_Date": "Invoice_Date"})
    return own.select("BMI_ID", "Invoice_Date", "Product_Type").distinct()


def prov_job(
    sub: DataFrame,
    tables: Tables,
    as_of: AsOf,
    config: JobConfig = JobConfig(),
    starts: Mapping[str, int] | None = None,
) -> JobResult:
    """Send a source to provisioning, with its worklist facts and product."""
    rows, step = _queue_job(
        sub,
        tables,
        as_of,
        "queue_prov",
        pending(("Root_Cause", "Prov_Note", "New_Root_Cause"), "all"),
        "This Source_TBL and Source_ID is already pending in Send to Prov table",
        "Sent to Prov",
        config.prov_note_days,
        config,
        starts,
    )
    items = work_items(
        tables,
        rows,
        {
            "Item_Vendor": "Vendor",
            "Item_BAN": "BAN",
            "Item_BTN": "BTN",
            "Item_WTN": "WTN",
            "Item_Circuit_ID": "Circuit_ID",
            "MRC_Amount": "MRC_Amount",
            "Max_CNR_Date": "Max_CNR_Date",
        },
    )
    listed = stable(clean(rows).join(items, list(SOURCE)))
    products = products_of(listed, tables["mrc"])
    queue = conditional_lookup(
        listed,
        products,
        F.col("Source_TBL") == "BMI",
        {"Max_CNR_Date": "Invoice_Date", "Source_No": "BMI_ID"},
        {"Product": "Product_Type"},
    ).select(
        F.col("Full_Name").alias("Logged_By"),
        F.coalesce("Assigned_To", "Full_Name").alias("Assigned_To"),
        month_end(as_moment(as_of).cast("date")).alias("Batch"),
        F.lit("CNR").alias("Audit_Name"),
        "Audit_Group",
        *SOURCE,
        "Product",
        F.col("Item_Vendor").alias("Vendor"),
        F.coalesce("BAN", "Item_BAN").alias("BAN"),
        F.col("Item_BTN").alias("BTN"),
        F.col("Item_WTN").alias("WTN"),
        F.col("Item_Circuit_ID").alias("Circuit_ID"),
        F.col("MRC_Amount").alias("Monthly_Impact"),
        F.col("Max_CNR_Date").alias("Invoice_Date"),
        "Macnum",
        F.col("PON").alias("Associated_PON"),
        F.col("Action_Reason").alias("Issue"),
        F.col("Prov_Category").alias("Category"),
        F.col("Prov_Recommendation").alias("Recommended_Action"),
        F.col("Prov_Norm_Reason").alias("Normalized_Reason"),
        F.col("Prov_Sub_Reason").alias("Sub_Reason"),
    )
    result = _moved(rows, step, tables)
    result.appends["queue_prov"] = queue
    return _stamp(result, rows, tables, "Pending Prov", as_of, "Action_Reason", "Sent to Prov")


def with_attachment(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Add the newest attachment of each source; `files` comes from `scan_attachments`."""
    newest = latest_by(
        files.select(*SOURCE, "File_Name", "Modified"), SOURCE, ["Modified", "File_Name"]
    )
    return lookup(rows, newest, SOURCE, {"CSR_File_Name": "File_Name"}, own_shuffle=True)


def lv_job(
    sub: DataFrame,
    tables: Tables,
    as_of: AsOf,
    config: JobConfig = JobConfig(),
    files: DataFrame | None = None,
    starts: Mapping[str, int] | None = None,
) -> JobResult:
    """Send a source to line verification; a source off the worklist is queued all the same."""
    rows, step = _queue_job(
        sub,
        tables,
        as_of,
        "queue_lv",
        pending(("Is_Rejected", "Sugg_Action"), "any"),
        "This Source_TBL and Source_ID is already pending in Send to LV table",
        "Sent to LV",
        config.lv_note_days,
        config,
        starts,
    )
    named = (
        rows.withColumn("CSR_File_Name", F.lit(None).cast("string"))
        if files is None
        else with_attachment(rows, files)
    )
    items = work_items(
        tables,
        rows,
        {
            "Item_Vendor": "Vendor",
            "Item_BAN": "BAN",
            "Item_BTN": "BTN",
            "Item_WTN": "WTN",
            "Max_CNR_Date": "Max_CNR_Date",
        },
    )
    queue = clean(named).join(items, list(SOURCE), "left").select(
        *SOURCE,
        F.col("Item_Vendor").alias("Vendor"),
        F.col("Item_BAN").alias("BAN"),
        F.col("Item_BTN").alias("BTN"),
        F.col("Item_WTN").alias("WTN"),
        "Macnum",
        F.col("Full_Name").alias("Logged_By"),
        F.coalesce("Assigned_To", "Full_Name").alias("Assigned_To"),
        F.col("Max_CNR_Date").alias("Invoice_Date"),
        F.col("Action_Reason").alias("Comment"),
        "CSR_File_Name",
    )
    result = _moved(rows, step, tables)
    result.appends["queue_lv"] = queue
    return _stamp(result, rows, tables, "Pending LV", as_of, "Action_Reason", "Sent to LV")


def audit_job(sub: DataFrame, tables: Tables, as_of: AsOf) -> JobResult:
    """Send to Audit: the worklist gets the fixed comment."""
    rows = review_rows(sub, tables)
    return _stamp(JobResult(rows), rows, tables, "Audit Review", as_of, None, "Send to Audit")


def other_job(sub: DataFrame, tables: Tables, as_of: AsOf) -> JobResult:
    """Any other listed action: its own name is the audit result."""
    rows = review_rows(sub, tables)
    return _stamp(JobResult(rows), rows, tables, F.col("Action"), as_of, "Action_Comment")


def ticket_job(sub: DataFrame, tables: Tables, as_of: AsOf) -> JobResult:
    """Ticket Opened: the ticket and its status become the worklist comment."""
    checked = validate(review_rows(sub, tables), amount_rules("Ticket"))
    rows = stable(ticket_status(checked, tables["ticket_core"], tables["ticket_status"]))
    return _stamp(JobResult(rows), rows, tables, F.col("Action"), as_of, "Ticket")


def service_master(tables: Tables) -> DataFrame:
    """All service masters as (type, id)."""
    return union_all(
        *[
            tables[kind.lower()].select(
                F.lit(kind).alias("Gs_SrvType"), F.col(key).cast("string").alias("Gs_SrvID")
            )
            for kind, key in SERVICE_KEYS.items()
        ]
    )


def mapped_bridges(tables: Tables) -> DataFrame:
    """Both bridges as (source number, type, id); both are asked whatever the source."""
    return union_all(
        *[
            tables[name].select(
                F.col(key).alias("Source_No"),
                F.col("gs_SrvType").alias("Gs_SrvType"),
                F.col("gs_SrvID").cast("string").alias("Gs_SrvID"),
            )
            for name, key in (("bmb", "BMI_ID"), ("pci_bmb", "PCI_ID"))
        ]
    )


def map_rows(rows: DataFrame, tables: Tables) -> DataFrame:
    """Exploded and checked mapping rows.

    All service types and both sources go through one plan: the masters are one
    keyed table and so are the bridges, instead of one pass per type and source.
    """
    listed = flag_unlisted(rows, "Gs_SrvType", SERVICE_KEYS)
    listed = flag_unlisted(listed, "Source_TBL", ("BMI", "PCI"))
    items = explode_csv(
        listed.withColumn("Gs_SrvID", F.coalesce("Gs_SrvID", F.lit(""))), "Gs_SrvID", "BMB"
    )
    name = F.concat_ws(" ", "Gs_SrvType", "Gs_SrvID")
    absent = F.concat(name, F.lit(" is not found in "), F.col("Gs_SrvType"))
    keys = ["Gs_SrvType", "Gs_SrvID"]
    checked = must_exist(
        items, narrow(service_master(tables), items, keys), keys, SERVICE_TEXT, absent
    )
    multi = checked.withColumn("_multi_no", F.when(F.col("BMB") == 1, F.col("Source_No")))
    pairs = {"_multi_no": "Source_No", "Gs_SrvType": "Gs_SrvType", "Gs_SrvID": "Gs_SrvID"}
    taken = must_not_exist(
        multi,
        narrow(mapped_bridges(tables), multi, pairs),
        pairs,
        SERVICE_TEXT,
        F.concat(F.lit("BMB table is already mapped to "), name),
    ).drop("_multi_no")
    return propagate_error(taken, ["Gs_SrvType", *SOURCE], F.struct("Line_ID", "Gs_SrvID"))


def map_job(sub: DataFrame, tables: Tables, as_of: AsOf) -> JobResult:
    """Map inventory rows to services: bridge rows, inventory write-back and log."""
    rows = stable(map_rows(review_rows(sub, tables), tables))
    good = clean(rows)
    result = JobResult(rows)
    now = as_moment(as_of)
    for source, bridge, target, log, edit in (
        ("BMI", "bmb", "bmm", "unmapped", "edit_Dt"),
        ("PCI", "pci_bmb", "pci", "pci_unmapped", "edit_date"),
    ):
        mine = good.filter(F.col("Source_TBL") == source)
        key = f"{source}_ID"
        result.appends[bridge] = mine.filter(F.col("BMB") == 1).select(
            F.col("Gs_SrvID").alias("gs_SrvID"),
            F.col("Gs_SrvType").alias("gs_SrvType"),
            F.col("Source_No").alias(key),
            F.col("Initials").alias("Rep"),
            now.alias(edit),
        )
        result.snapshots[target] = apply_mapping(
            tables[target], mine, "BMI_ID" if source == "BMI" else "ID", as_of, source == "BMI"
        )
        result.appends[log] = (
            mine.select("Source_No", "Action_Comment", "Comp_Serial", "Initials")
            .distinct()
            .select(
                F.col("Source_No").alias(key),
                F.lit("Mapped").alias("Audit_Result"),
                F.col("Initials").alias("Rep"),
                F.col("Action_Comment").alias("Comment"),
                now.alias("Edit_Date"),
            )
        )
    return result


def start_dates(rows: DataFrame, tables: Tables, as_of: AsOf) -> DataFrame:
    """Start date per row, defaulted from the inventory of the row's source."""
    typed = rows.withColumn("Start_Date", to_day("Start_Date"))
    return union_all(
        *[
            default_start(
                typed.filter(F.col("Source_TBL") == source),
                tables[inventory],
                tables["limitations"],
                as_of,
                key,
            )
            for source, inventory, key in (("BMI", "bmi", "BMI_ID"), ("PCI", "pci", "ID"))
        ]
    )


def dispute_job(
    sub: DataFrame,
    tables: Tables,
    as_of: AsOf,
    cost_types: Iterable[str] = COST_TYPES,
    starts: Mapping[str, int] | None = None,
) -> JobResult:
    """Dispute a source: mine its charges after the start date and open a dispute for each."""
    rows = flag_unlisted(review_rows(sub, tables), "Source_TBL", ("BMI", "PCI"))
    # A date that cannot be read is an error; only a missing one is filled in.
    rows = one_per_source(validate(rows, [is_date("Start_Date")]))
    other = rows.filter(~F.coalesce(F.col("Source_TBL").isin("BMI", "PCI"), F.lit(False)))
    dated = stable(start_dates(rows, tables, as_of))
    mined = stable(mine_cost(clean(dated), tables, carry=True))
    rows = must_derive(
        union_all(dated, other.withColumn("Start_Date", to_day("Start_Date"))),
        mined,
        SOURCE,
        "Source_TBL, Source_ID, Start_Date",
        "Valid cost was not found for the Source_TBL, Source_ID, Start_Date combo",
    )
    opened = review_seed_disputes(
        mined.drop("Full_Name", "Initials"), tables, as_of, cost_types, starts
    )
    result = JobResult(
        union_all(rows, rejected(opened.results)), dict(opened.appends), counters=opened.counters
    )
    return _stamp(result, rows, tables, "Dispute Review", as_of, "Action_Reason", "New Dispute")


ReviewJob = Callable[[DataFrame, Tables, AsOf], JobResult]

# Which job serves which action of the review folder; any other listed action is `other_job`.
REVIEW_JOBS: dict[str, ReviewJob] = {
    "Map": map_job,
    "Dispute": dispute_job,
    "Send to Prov": prov_job,
    "Send to LV": lv_job,
    "Dispute Note": note_job,
    "Escalate Disputes": escalate_job,
    "Paid Disputes": paid_job,
    "Close Disputes": close_job,
    "Send to Audit": audit_job,
    "Ticket Opened": ticket_job,
}
