"""Mining disputable cost for reviewed inventory rows."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import is_blank
from ledgerflow.operators.enrich import CARRIED, best_match, payload
from ledgerflow.operators.filters import positive
from ledgerflow.operators.joins import lookup, narrow
from ledgerflow.operators.relational import union_all

# The amounts of a paper bill and the cost types they stand for.
PAPER_AMOUNTS = {"MRC": "PC-MRC", "NRC": "PC-NRC", "FRAC": "PC-FRAC"}
_CIRCUIT = {"Vendor": "Vendor", "BAN": "BAN", "WTN": "BTN", "Circuit_ID": "Circuit_ID"}


# What tells one line of an account from another; a row that names neither is no line.
_LINE = ("WTN", "Circuit_ID")


def _charged(charges: DataFrame, dated: str, since: date | None) -> DataFrame:
    """Charges that any source of the batch may take: dated after the earliest start.

    The bound is a literal, so it prunes the partitions of a table laid out by date.
    """
    return charges.filter(F.col(dated) > F.lit(since).cast("date"))


def _cost(rule: str, seed: str, carry: bool) -> list[Column]:
    """Seed, cost type and record type of a charge, and what it has to offer to the seed."""
    columns = [F.col(seed).cast("string").alias("Seed"), F.lit(rule).alias("Cost_Type")]
    offered = payload(rule)
    columns.append(offered["Record_Type"].alias("Record_Type"))
    if carry:
        columns.append(F.struct(*[v.alias(c) for c, v in offered.items()]).alias(CARRIED))
    return columns


def _aside(sub: DataFrame) -> DataFrame:
    """The sources with their columns put aside, so that a charge's own names are free next to them.

    A charge meets its source with its raw columns; what it offers is made of the charges
    that were met, not of all, and does not travel.
    """
    return sub.select(
        F.struct(*[F.col(f"`{c}`") for c in sub.columns]).alias("_sub"),
        F.col("Source_No").alias("_no"),
        F.col("Start_Date").alias("_start"),
    )


def recurring(sub: DataFrame, mrc: DataFrame, since: date | None, compared: DataFrame | None = None) -> DataFrame:
    """Recurring charges of the sources; `compared` are the matched records, if the payload is wanted."""
    charges = _charged(mrc.filter(positive("Amount")), "Invoice_Date", since)
    later = [F.col("_no") == F.col("BMI_ID"), F.col("Invoice_Date") > F.col("_start")]
    if compared is None:
        return _aside(sub).join(charges, later).select("_sub.*", *_cost("MRC", "BDT_MRC_ID", False))
    offered = charges.withColumns({"CPID": F.lit(None).cast("string"), "BANMasterID": F.lit(None).cast("bigint")})
    found = _aside(sub).join(offered, later).select(
        "_sub.*", F.col("Invoice_Date").alias("_dated"), *_cost("MRC", "BDT_MRC_ID", True)
    )
    found = found.withColumn("_seed", F.col("Seed").cast("bigint"))
    matched = best_match(narrow(_charged(compared, "Invoice_Date", since), found, {"_seed": "BDT_MRC_ID", "_dated": "Invoice_Date"}))
    known = lookup(
        found, matched, {"_seed": "BDT_MRC_ID", "_dated": "Invoice_Date"}, {"_cpid": "CPID", "_bm": "BANMasterID"},
        own_shuffle=True,
    )
    filled = F.col(CARRIED).withField("CPID", F.col("_cpid")).withField("BANMaster_ID", F.col("_bm"))
    return known.withColumn(CARRIED, filled).drop("_dated", "_seed", "_cpid", "_bm")


def one_time(sub: DataFrame, occ: DataFrame, inventory: DataFrame, since: date | None, carry: bool = False) -> DataFrame:
    """One-time charges have no source key: they are met through the circuit of the inventory.

    The sources get their circuits first, so charges are met once, on circuit and date.
    A source or charge with neither a line number nor a circuit is no line and meets nothing.
    """
    owned = narrow(inventory, sub, {"Source_No": "BMI_ID"})
    named = F.lit(False)
    for c in _LINE:
        named = named | ~is_blank(c)
    lines = owned.filter(named).select(
        F.col("BMI_ID").alias("_source"), *[F.col(c).alias(f"_i_{c}") for c in _CIRCUIT]
    )
    billed = F.lit(False)
    for c in _LINE:
        billed = billed | ~is_blank(_CIRCUIT[c])
    charges = _charged(occ.filter(positive("Amount") & billed), "Invoice_Date", since).select(
        *[F.col(c).alias(f"_o_{c}") for c in _CIRCUIT.values()],
        F.col("Invoice_Date").alias("_dated"),
        *_cost("OCC", "BDT_OCC_ID", carry),
    )
    same = [F.col(f"_i_{a}") == F.col(f"_o_{b}") for a, b in _CIRCUIT.items()]
    placed = sub.join(lines, F.col("Source_No") == F.col("_source"))
    return placed.join(charges, [*same, F.col("_dated") > F.col("Start_Date")]).drop(
        "_source", "_dated", *[f"_i_{a}" for a in _CIRCUIT], *[f"_o_{b}" for b in _CIRCUIT.values()]
    )


def paper(sub: DataFrame, paper_cost: DataFrame, since: date | None, carry: bool = False) -> DataFrame:
    """The positive amounts of each paper bill, from one read of the bills."""
    amounts = F.array(
        *[
            F.when(F.col(amount) > 0, F.struct(*_cost(cost_type, "Seed", carry)))
            for amount, cost_type in PAPER_AMOUNTS.items()
        ]
    )
    due = reduce(or_, [F.col(amount) > 0 for amount in PAPER_AMOUNTS])
    charges = _charged(paper_cost.filter(due), "Bill_Date", since)
    later = [F.col("_no") == F.col("PCI_ID"), F.col("Bill_Date") > F.col("_start")]
    met = _aside(sub).join(charges, later)
    return met.select("_sub", F.explode(F.array_compact(amounts)).alias("_a")).select("_sub.*", "_a.*")


def mine_cost(sub: DataFrame, tables: Mapping[str, DataFrame], carry: bool = False) -> DataFrame:
    """Every positive charge of a submitted source after its start date.

    `sub` has one row per source, with Source_No and Start_Date, and is best a written
    frame: its earliest start date is looked up first. Its Error columns are dropped,
    as a mined row starts clean. With `carry` a mined row brings along what its charge has
    to offer to a seed, in the column `CARRIED`, so that it need not be looked up again.
    """
    rows = sub.drop("Error_Columns", "Error_Message", "Cost_Type", "Record_Type", "Seed")
    since = rows.agg(F.min(F.col("Start_Date").cast("date"))).first()[0]
    bmi = rows.filter(F.col("Source_TBL") == "BMI")
    pci = rows.filter(F.col("Source_TBL") == "PCI")
    mined = union_all(
        recurring(bmi, tables["mrc"], since, tables["mrc_cmp"] if carry else None),
        one_time(bmi, tables["occ"], tables["bmi"], since, carry),
        paper(pci, tables["paper_cost"], since, carry),
    )
    return mined.drop("Action", "Start_Date")
