"""Snapshot updates: the new state of a table as a frame."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import as_moment, audit_comment, previous_month_end
from ledgerflow.functions.dates import AsOf
from ledgerflow.operators.conform import ERROR_COLUMNS
from ledgerflow.operators.filters import clean, tag_is, tag_is_not
from ledgerflow.operators.joins import Keys, key_map, lookup, narrow
from ledgerflow.operators.keys import stable
from ledgerflow.operators.relational import first_per

UNMAPPED = "unmapped"


def apply_updates(
    target: DataFrame,
    changes: DataFrame,
    keys: Keys,
    set_cols: Iterable[str],
    order: Iterable[Column] | None = None,
    where: Column | None = None,
    unique: bool = False,
) -> DataFrame:
    """The target with the set columns replaced on matching rows; null replaces too.

    Of several changes with one key the first in `order` wins; without an order, the
    greatest values, so that a repeated key never multiplies the target. `unique` says
    that the changes have one row a key, which saves ranking them. Columns of the change
    that the target lacks are added. `where` limits the target rows.
    """
    pairs = key_map(keys)
    set_cols = list(set_cols)
    if not unique:
        by = [F.col(c).desc_nulls_last() for c in set_cols] if order is None else order
        changes = first_per(changes, pairs.values(), by)
    joined = lookup(
        target, changes, pairs, {f"_new_{c}": c for c in set_cols}, "_hit", own_shuffle=not unique
    )
    hit = F.col("_hit") if where is None else F.col("_hit") & where
    have = {c.lower(): c for c in target.columns}
    values = {}
    for c in set_cols:
        old = have.get(c.lower())
        if old is None:
            values[c] = F.when(hit, F.col(f"_new_{c}"))
        else:
            new = F.col(f"_new_{c}").cast(target.schema[old].dataType)
            values[old] = F.when(hit, new).otherwise(F.col(old))
    return joined.withColumns(values).drop("_hit", *[f"_new_{c}" for c in set_cols])


def default_start(
    df: DataFrame,
    inventory: DataFrame,
    limits: DataFrame,
    as_of: AsOf,
    inventory_key: str = "BMI_ID",
    margin_days: int = 15,
) -> DataFrame:
    """Fill a missing Start_Date from the account's dispute limit, then step to the
    end of the month before."""
    window = limits.groupBy("BAN").agg(F.max("Dispute_Limit").alias("Dispute_Limit"))
    part = narrow(inventory.select(inventory_key, "BAN"), df, {"Source_No": inventory_key})
    found = lookup(df, part, {"Source_No": inventory_key}, {"_ban": "BAN"})
    found = lookup(
        found, window, {"_ban": "BAN"}, {"_limit": "Dispute_Limit"}, own_shuffle=True
    )
    today = as_moment(as_of).cast("date")
    start = F.coalesce(
        F.col("Start_Date"), F.date_add(today, F.lit(margin_days) - F.col("_limit").cast("int"))
    )
    return found.withColumn("Start_Date", previous_month_end(start)).drop("_ban", "_limit")


def mapping_values(df: DataFrame) -> DataFrame:
    """The service id and type to write back: a multi mapping points to its bridge."""
    multi = F.col("BMB") == 1
    bridge = F.when(F.col("Source_TBL") == "PCI", "M2M").otherwise("BMB")
    return df.withColumns(
        {
            "New_SrvID": F.when(multi, F.col("Source_ID").cast("string")).otherwise(
                F.col("Gs_SrvID")
            ),
            "New_SrvType": F.when(multi, bridge).otherwise(F.col("Gs_SrvType")),
        }
    )


def apply_mapping(
    target: DataFrame, mapped: DataFrame, key: str, as_of: AsOf, stamp_frame: bool
) -> DataFrame:
    """Write submitted services back to an inventory; the first submitted row wins."""
    changes = mapping_values(mapped).select(
        F.col("Source_No").alias(key),
        F.col("New_SrvID").alias("gs_SrvID"),
        F.col("New_SrvType").alias("gs_SrvType"),
        as_moment(as_of).alias("Edit_Date"),
        F.col("Initials").alias("frameID"),
        "Line_ID",
    )
    columns = ["gs_SrvID", "gs_SrvType", "Edit_Date"] + (["frameID"] if stamp_frame else [])
    return apply_updates(
        target, changes, [key], columns, order=[F.col("Line_ID").asc(), F.col("gs_SrvID").asc()]
    )


def worklist_log(
    df: DataFrame,
    worklist: DataFrame,
    audit_result: Column | str,
    as_of: AsOf,
    comment: str | None = None,
    action: str | None = None,
) -> DataFrame:
    """The clean submissions that meet a tagged worklist row, as audit log rows.

    `df` carries Initials. One join serves the unmapped and the zero-revenue log,
    for both sources; the caller filters by TAG and Source_TBL.
    """
    items = narrow(worklist, clean(df), ["Source_TBL", "Source_ID"]).select(
        "Source_TBL", "Source_ID", "TAG", F.col("Max_CNR_Date").alias("Invoice_Date")
    )
    result = F.lit(audit_result) if isinstance(audit_result, str) else audit_result
    return (
        clean(df)
        .filter(F.col("Initials").isNotNull())
        .withColumns({"Audit_Result": result, "Comment": audit_comment(action, comment)})
        .select("Line_ID", "Source_TBL", "Source_ID", "Audit_Result", "Initials", "Comment")
        .join(items.filter(F.col("TAG").isNotNull()), ["Source_TBL", "Source_ID"])
        .select(
            "Line_ID",
            "Source_TBL",
            "Source_ID",
            "Invoice_Date",
            F.col("TAG").alias("Tag"),
            "Audit_Result",
            F.col("Initials").alias("Rep"),
            "Comment",
            as_moment(as_of).alias("Edit_Date"),
        )
    )


def stamp_worklist(
    df: DataFrame,
    worklist: DataFrame,
    audit_result: Column | str,
    as_of: AsOf,
    comment: str | None = None,
    action: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(unmapped log, zero-revenue log, new worklist); the last submitted row wins.

    All three come from one written copy of the log, so the worklist is joined once.
    """
    log = stable(worklist_log(df, worklist, audit_result, as_of, comment, action))
    unmapped = log.filter(tag_is(UNMAPPED, "Tag")).drop("Invoice_Date", "Tag")
    zero_revenue = log.filter(tag_is_not(UNMAPPED, "Tag"))
    stamped = apply_updates(
        worklist,
        log,
        ["Source_TBL", "Source_ID"],
        ["Audit_Result", "Rep", "Comment", "Edit_Date"],
        order=[F.col("Line_ID").desc(), F.col("Comment").asc()],
        where=F.col("TAG").isNotNull(),
    )
    return unmapped, zero_revenue, stamped


def assign_reps(df: DataFrame, candidates: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Give each clean row the rep of the first candidate of its key."""
    keys = list(keys)
    order = [F.col("Assign_Rep").asc_nulls_first(), F.col("Date_Submitted").desc()]
    pick = first_per(candidates.select(*keys, "Assign_Rep", "Date_Submitted"), keys, order)
    found = lookup(df, pick, keys, {"_rep": "Assign_Rep"}, own_shuffle=True)
    return found.withColumn(
        "Assigned_To", F.when(F.col(ERROR_COLUMNS).isNull(), F.col("_rep"))
    ).drop("_rep")
