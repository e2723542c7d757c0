"""New disputes: seeds from a file, seeds mined by a review, and free-form disputes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.config import COST_TYPES, REVIEW_CATEGORY
from ledgerflow.functions import (
    as_moment,
    batch_date,
    batch_label,
    hash_claim_no,
    seed_claim_no,
    to_day,
    to_money,
)
from ledgerflow.functions.dates import AsOf
from ledgerflow.operators.conform import conform, default_where, initial_status, trim_all, with_source
from ledgerflow.operators.enrich import CARRIED, enrich_by_cost_type, enrich_carried
from ledgerflow.operators.filters import clean, flag_unlisted
from ledgerflow.operators.joins import join_chain, join_effective, with_employee
from ledgerflow.operators.keys import number_lines, number_rows, stable
from ledgerflow.operators.validate import (
    amount_rules,
    bill_date_rules,
    date_rules,
    known_employee,
    validate,
)
from ledgerflow.plans.tables import JobResult, Tables, first_free

# The columns a seed file is padded to.
SEED_COLUMNS = (
    "Dispute_Type",
    "Cost_Type",
    "Cost_Type_Seed",
    "Dispute_Category",
    "Audit_Type",
    "Confidence",
    "Dispute_Reason",
    "Record_Type",
    "USI",
    "Dispute_Amt",
    "USOC",
    "USOC_Desc",
    "PON",
    "Phrase_Code",
    "Causing_SO",
    "CLLI",
    "Usage_Rate",
    "MOU",
    "Jurisdiction",
    "Short_Paid",
    "Comment",
    "Dispute_Status",
    "ILEC_Confirmation",
    "ILEC_Comment",
    "Approved_Amt",
    "Received_Amt",
    "Received_Invoice_Date",
    "Vendor",
    "Platform",
    "BAN",
    "Bill_Date",
    "State",
    "Billed_Amt",
    "Source_TBL",
    "Source_ID",
    "CPID",
    "BANMaster_ID",
)

# The columns a free-form dispute file is padded to.
NONSEED_COLUMNS = (
    "Dispute_Type",
    "Stc_Claim_Number",
    "Record_Type",
    "BAN",
    "Bill_Date",
    "Billed_Amt",
    "Dispute_Amt",
    "Dispute_Category",
    "Audit_Type",
    "Confidence",
    "Dispute_Reason",
    "USI",
    "State",
    "USOC",
    "USOC_Desc",
    "PON",
    "Phrase_Code",
    "Causing_SO",
    "CLLI",
    "Usage_Rate",
    "MOU",
    "Jurisdiction",
    "Short_Paid",
    "Comment",
    "Dispute_Status",
    "ILEC_Confirmation",
    "ILEC_Comment",
    "Approved_Amt",
    "Received_Amt",
    "Received_Invoice_Date",
)


def source_label(day: Column) -> Column:
    return F.concat(F.lit("GRT Status: "), day)


def append_dispute(
    rows: DataFrame,
    tables: Tables,
    as_of: AsOf,
    claim: Column,
    submitted: Column | None = None,
    starts: Mapping[str, int] | None = None,
    order: Iterable[str] = ("Line_ID",),
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Linked rows for header, detail, history and current state, and the next free keys.

    `rows` holds clean seed-shaped rows with Line_ID and Full_Name, read from a
    written frame. One dispute has one row in each table, so a single numbering
    serves the three keys, and the keys are carried instead of joined back through
    the claim text. The rows are numbered first and looked up then; what comes of it is
    written once, and the four tables are columns of that copy. The header knows its
    first history key before it is written.
    """
    first = first_free(tables, ("DSB_ID", "DS_ID", "DH_ID"), starts)
    order = tuple(order)
    numbered, total = number_lines(rows, first) if order == ("Line_ID",) else number_rows(rows, order, first)
    now = as_moment(as_of)
    master = tables["ban_master"].select(
        "BAN", "ID", "BDT_Vendor", "Start_Date", "End_Date", "PlatformMasterID", "VendorMasterID"
    )
    dated = join_effective(
        numbered.withColumn("Bill_Day", to_day("Bill_Date")),
        master,
        as_of,
        "Bill_Day",
        {"BM_ID": "ID", "BM_Vendor": "BDT_Vendor", "BM_Platform_ID": "PlatformMasterID"},
    )
    named = join_chain(
        dated.withColumn(
            "Master_ID", F.coalesce(F.col("BANMaster_ID").try_cast("bigint"), F.col("BM_ID"))
        ),
        [
            (tables["platform_master"], {"BM_Platform_ID": "ID"}, {"BM_Platform": "Platform"}),
            (
                master.select("ID", "PlatformMasterID", "VendorMasterID"),
                {"Master_ID": "ID"},
                {"N_Platform_ID": "PlatformMasterID", "N_Vendor_ID": "VendorMasterID"},
            ),
            (tables["platform_master"], {"N_Platform_ID": "ID"}, {"Norm_Platform": "Platform"}),
            (tables["vendor_master"], {"N_Vendor_ID": "ID"}, {"Norm_Vendor": "Vendor"}),
        ],
    )
    settled = named.withColumns(
        {
            "Vendor": F.coalesce("Vendor", "BM_Vendor"),
            "Platform": F.coalesce("Platform", "BM_Platform"),
            "Amount": to_money("Dispute_Amt"),
            "First_Status": initial_status("Dispute_Status", "Dispute_Type"),
            "Batch_DT": batch_date(as_of),
            "Source_File": source_label(F.date_format(now, "yyyyMMdd")),
            "Moment": now,
        }
    )
    # The claim may be made from the new keys.
    keyed = stable(settled.withColumn("Claim_No", claim))

    def pick(**columns: str | Column) -> DataFrame:
        return keyed.select(
            *[(F.col(v) if isinstance(v, str) else v).alias(c) for c, v in columns.items()]
        )

    header = pick(
        DSB_ID="DSB_ID",
        Disputer="Full_Name",
        Dispute_Type="Dispute_Type",
        Norm_Dispute_Category="Dispute_Category",
        Edit_DT="Moment",
        Vendor="Vendor",
        Platform="Platform",
        BAN="BAN",
        STC_Claim_Number="Claim_No",
        Bill_Date="Bill_Day",
        USI="USI",
        Dispute_Amount="Amount",
        BanMaster_ID="Master_ID",
        Source_TBL="Source_TBL",
        Source_ID="Source_ID",
        Orig_DH_ID="DH_ID",
    )
    detail = pick(
        DS_ID="DS_ID",
        DSB_ID="DSB_ID",
        Cost_Type="Cost_Type",
        Cost_Type_Seed="Cost_Type_Seed",
        State="State",
        USOC="USOC",
        USOC_Desc="USOC_Desc",
        CPID="CPID",
        Record_Type="Record_Type",
        Audit_Type="Audit_Type",
        Billed_Amt=to_money("Billed_Amt"),
        Claimed_Amt="Amount",
        Billed_Phrase_Code="Phrase_Code",
        Causing_SO="Causing_SO",
        PON="PON",
        CLLI="CLLI",
        Usage_Rate="Usage_Rate",
        MOU="MOU",
        Jurisdiction="Jurisdiction",
        Short_Paid="Short_Paid",
        Comment="Comment",
        Confidence="Confidence",
        Batch_DT="Batch_DT",
        Edit_DT="Moment",
    )
    history = pick(
        DH_ID="DH_ID",
        DSB_ID="DSB_ID",
        Dispute_Category="Dispute_Category",
        Display_Status="First_Status",
        Date_Submitted=submitted if submitted is not None else F.col("Moment"),
        Dispute_Reason="Dispute_Reason",
        ILEC_Confirmation="ILEC_Confirmation",
        ILEC_Comments="ILEC_Comment",
        Credit_Approved=to_money("Approved_Amt"),
        Credit_Received_Amount=to_money("Received_Amt"),
        Credit_Received_Invoice_Date=to_day("Received_Invoice_Date"),
        GRT_Update_Rep="Full_Name",
        Date_Updated="Moment",
        Source_File="Source_File",
        Edit_DT="Moment",
    )
    current = pick(
        **{
            "DSB_ID": "DSB_ID",
            "Dispute_Type": "Dispute_Type",
            "Vendor": "Vendor",
            "Platform": "Platform",
            "Norm_Vendor": "Norm_Vendor",
            "Norm_Platform": "Norm_Platform",
            "State": "State",
            "BAN": "BAN",
            "Bill_Date": "Bill_Day",
            "USI": "USI",
            "Source_TBL": "Source_TBL",
            "Source_ID": "Source_ID",
            "STC_Claim_Number": "Claim_No",
            "#_Of_Escalations": F.lit(0),
            "Status": F.lit("Open"),
            "Display_Status": "First_Status",
            "Date_Submitted": "Moment",
            "Norm_Dispute_Category": "Dispute_Category",
            "Dispute_Category": "Dispute_Category",
            "Audit_Type": "Audit_Type",
            "Disputer": "Full_Name",
            "Comment": "Comment",
            "Dispute_Amount": "Amount",
            "Dispute_Reason": "Dispute_Reason",
            "Date_Updated": "Moment",
            "Batch": "Batch_DT",
            "Edit_Date": "Moment",
            "Source_File": "Source_File",
            "DH_ID": "DH_ID",
        }
    )
    appends = {
        "dispute_header": header,
        "dispute_detail": detail,
        "dispute_history": history,
        "dispute_current": current,
    }
    return appends, {key: start + total for key, start in first.items()}


def check_employee(df: DataFrame, tables: Tables) -> DataFrame:
    """Add the submitter's names and flag submitters who are not known."""
    return validate(with_employee(df, tables["employee"]), [known_employee()]).drop("_has_employee")


def seed_claim(as_of: AsOf) -> Column:
    return seed_claim_no(batch_label(as_of), "Record_Type", "Cost_Type_Seed")


def seed_disputes(
    sub: DataFrame,
    tables: Tables,
    as_of: AsOf,
    cost_types: Iterable[str] = COST_TYPES,
    folder: str = "02_Seeds",
    starts: Mapping[str, int] | None = None,
) -> JobResult:
    """New disputes from a seed file."""
    rows = with_source(trim_all(conform(sub, SEED_COLUMNS)), folder)
    rows = flag_unlisted(rows, "Cost_Type", cost_types)
    rules = [
        *amount_rules("Dispute_Amt"),
        *amount_rules("Approved_Amt"),
        *amount_rules("Received_Amt"),
        *date_rules("Received_Invoice_Date", as_of),
    ]
    enriched = enrich_by_cost_type(validate(rows, rules), tables, cost_types)
    results = stable(check_employee(enriched, tables))
    appends, counters = append_dispute(clean(results), tables, as_of, seed_claim(as_of), starts=starts)
    return JobResult(results, appends, counters=counters)


def review_seed_disputes(
    mined: DataFrame,
    tables: Tables,
    as_of: AsOf,
    cost_types: Iterable[str] = COST_TYPES,
    starts: Mapping[str, int] | None = None,
) -> JobResult:
    """New disputes from cost rows that a review mined; the category is fixed.

    `mined` has Seed, Cost_Type and Record_Type next to the review columns, and may bring
    along its charges (`mine_cost` with `carry`); else they are looked up.
    """
    renamed = mined.withColumnsRenamed(
        {
            "Seed": "Cost_Type_Seed",
            "Claim_Channel": "Dispute_Type",
            "Action_Comment": "Comment",
            "Action_Reason": "Dispute_Reason",
        }
    )
    rows = conform(renamed, SEED_COLUMNS).withColumns(
        {"Dispute_Category": F.lit(REVIEW_CATEGORY), "Audit_Type": F.lit("CNR Audit")}
    )
    enriched = (
        enrich_carried(rows, cost_types)
        if CARRIED in mined.columns
        else enrich_by_cost_type(rows, tables, cost_types)
    )
    defaulted = default_where(
        enriched,
        F.col("Error_Columns").isNull() & (F.col("Source_TBL") == "PCI"),
        {"Dispute_Type": "Email"},
    )
    results = stable(check_employee(defaulted, tables))
    appends, counters = append_dispute(
        clean(results),
        tables,
        as_of,
        seed_claim(as_of),
        starts=starts,
        order=("Line_ID", "Cost_Type", "Cost_Type_Seed"),
    )
    return JobResult(results, appends, counters=counters)


def nonseed_disputes(
    sub: DataFrame,
    tables: Tables,
    as_of: AsOf,
    folder: str = "03_Non-Seeds",
    starts: Mapping[str, int] | None = None,
) -> JobResult:
    """New disputes that name their own account and amount.

    The claim is made from DSB_ID, which no other batch has: line numbers start
    anew with every file.
    """
    rows = with_source(trim_all(conform(sub, NONSEED_COLUMNS)), folder)
    rules = [
        *bill_date_rules("Bill_Date", as_of),
        *amount_rules("Billed_Amt"),
        *amount_rules("Dispute_Amt"),
        *amount_rules("Approved_Amt"),
        *amount_rules("Received_Amt"),
        *date_rules("Received_Invoice_Date", as_of),
    ]
    results = stable(check_employee(validate(rows, rules), tables))
    unset = {
        c: F.lit(None).cast("string")
        for c in (
            "Vendor",
            "Platform",
            "BANMaster_ID",
            "Source_TBL",
            "Source_ID",
            "Cost_Type",
            "Cost_Type_Seed",
            "CPID",
        )
    }
    appends, counters = append_dispute(
        clean(results).withColumns(unset),
        tables,
        as_of,
        hash_claim_no(batch_label(as_of), "DSB_ID"),
        submitted=F.col("Moment").cast("date").cast("timestamp_ntz"),
        starts=starts,
    )
    return JobResult(results, appends, counters=counters)
