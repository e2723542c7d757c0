"""Seed enrichment: what a cost record adds to a submitted seed, by cost type."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import first_non_blank, is_blank
from ledgerflow.operators.conform import ERROR_COLUMNS, existing
from ledgerflow.operators.joins import lookup, narrow
from ledgerflow.operators.relational import first_per, union_all
from ledgerflow.operators.validate import Rule, validate


@dataclass(frozen=True)
class CostRule:
    """How one cost table fills a seed row.

    `fill` maps a submission column to the cost column used where it is null;
    `usi` lists the columns of which the first non-blank becomes the service id.
    """

    table: str
    key: str
    amount: str
    record_type: str | None = None
    record_type_from: str | None = None
    platform: bool = True
    fill: Mapping[str, str] = field(default_factory=dict)
    usi: tuple[str, ...] = ()
    usi_as_is: bool = False
    source_tbl: str | None = None
    source_id: str | None = None
    compared: bool = False


_LINES = ("WTN", "Circuit_ID", "BTN")
_USOC = {"USOC": "USOC", "USOC_Desc": "USOC_Description"}


def _paper(amount: str) -> CostRule:
    return CostRule(
        "paper_cost",
        "Seed",
        amount,
        record_type=amount,
        platform=False,
        usi=_LINES,
        source_tbl="PCI",
        source_id="PCI_ID",
    )


# The rule of each cost type.
COST_RULES: dict[str, CostRule] = {
    "PC-MRC": _paper("MRC"),
    "PC-NRC": _paper("NRC"),
    "PC-FRAC": _paper("FRAC"),
    "MRC": CostRule(
        "mrc",
        "BDT_MRC_ID",
        "Amount",
        record_type="MRC",
        fill=_USOC,
        usi=_LINES,
        source_tbl="BMI",
        source_id="BMI_ID",
        compared=True,
    ),
    "OCC": CostRule(
        "occ",
        "BDT_OCC_ID",
        "Amount",
        record_type_from="Activity_Type",
        fill=_USOC | {"Phrase_Code": "Phrase_Code", "Causing_SO": "SO", "PON": "PON"},
        usi=("BTN", "Circuit_ID"),
    ),
    "TAS": CostRule(
        "tas",
        "BDT_TAS_ID",
        "Total_Amount",
        record_type="TAS",
        fill={"Jurisdiction": "Jurisdiction_Phrase"},
    ),
    "USAGE": CostRule(
        "usage",
        "BDT_USAGE_ID",
        "Amount",
        record_type="USAGE",
        fill={"Usage_Rate": "Usage_Rate", "Jurisdiction": "Jurisdiction"},
        usi=("BTN",),
        usi_as_is=True,
    ),
    "LPC": CostRule("lpc", "BDT_INVOICE_ID", "Late_Payment_Charges", record_type="LPC"),
    "ADJ": CostRule(
        "adj", "BDT_PAD_ID", "Amount", record_type="ADJ", fill={"Phrase_Code": "Phrase_Code"}
    ),
}

OVERWRITTEN = ("Record_Type", "Vendor", "BAN", "Bill_Date", "State", "Billed_Amt")
FILLED = (
    "Dispute_Amt",
    "USOC",
    "USOC_Desc",
    "Phrase_Code",
    "Causing_SO",
    "PON",
    "Jurisdiction",
    "Usage_Rate",
    "Source_TBL",
    "Source_ID",
)


def seed_number(seed: str) -> Column:
    """A submitted seed as the number that keys the cost tables; other text is no seed."""
    return F.col(seed).cast("string").try_cast("bigint")


# The column in which a mined row brings along what its charge offers.
CARRIED = "_cost"

# The columns a charge may offer, and their types.
OFFERED = {
    "Record_Type": "string",
    "Vendor": "string",
    "BAN": "string",
    "Bill_Date": "date",
    "State": "string",
    "Billed_Amt": "string",
    "Dispute_Amt": "string",
    "Platform": "string",
    "USOC": "string",
    "USOC_Desc": "string",
    "Phrase_Code": "string",
    "Causing_SO": "string",
    "PON": "string",
    "Jurisdiction": "string",
    "Usage_Rate": "string",
    "Source_TBL": "string",
    "Source_ID": "string",
    "USI": "string",
    "CPID": "string",
    "BANMaster_ID": "bigint",
}


def _values(rule: CostRule, amount: Column, record_type: Column) -> dict[str, Column]:
    """What one cost row offers to a seed, under common names."""
    values: dict[str, Column] = {
        "Record_Type": record_type,
        "Vendor": F.col("Vendor"),
        "BAN": F.col("BAN"),
        "Bill_Date": F.col("Bill_Date"),
        "State": F.col("State"),
        "Billed_Amt": amount,
        "Dispute_Amt": amount,
    }
    if rule.platform:
        values["Platform"] = F.col("Platform")
    values |= {c: F.col(source) for c, source in rule.fill.items()}
    if rule.source_tbl:
        values["Source_TBL"] = F.lit(rule.source_tbl)
        values["Source_ID"] = F.col(rule.source_id).cast("string")
    if rule.usi:
        values["USI"] = F.col(rule.usi[0]) if rule.usi_as_is else first_non_blank(*rule.usi)
    if rule.compared:
        values |= {"CPID": F.col("CPID"), "BANMaster_ID": F.col("BANMasterID")}
    return values


def payload(cost_type: str) -> dict[str, Column]:
    """What a row of the type's cost table offers, in the shape that all types share."""
    rule = COST_RULES[cost_type]
    record_type = F.upper(rule.record_type_from) if rule.record_type_from else F.lit(rule.record_type)
    values = _values(rule, F.col(rule.amount), record_type)
    return {c: values.get(c, F.lit(None)).cast(kind) for c, kind in OFFERED.items()}


def _payload(rule: CostRule, cost_type: Column, amount: Column, record_type: Column) -> list[Column]:
    return [
        cost_type.alias("Cost_Type"),
        F.col(rule.key).cast("bigint").alias("Cost_Seed"),
        *[v.alias(c) for c, v in _values(rule, amount, record_type).items()],
    ]


def best_match(compared: DataFrame) -> DataFrame:
    """One matched record of each recurring charge and invoice."""
    order = [F.col("CPID").asc(), F.col("BANMasterID").asc()]
    return first_per(compared, ["BDT_MRC_ID", "Invoice_Date"], order)


def cost_records(
    sub: DataFrame, tables: Mapping[str, DataFrame], cost_types: Iterable[str], seed: str
) -> DataFrame:
    """Every cost row that a submission names, from all cost tables, in one shape.

    Each cost table is read once and cut to the named seeds by a semi join on its
    own key; the paper bills yield their three cost types from the same read.
    """
    wanted = list(cost_types)
    named = sub.select("Cost_Type", seed_number(seed).alias("_seed"))
    frames = []
    by_table: dict[str, list[str]] = {}
    for cost_type in wanted:
        by_table.setdefault(COST_RULES[cost_type].table, []).append(cost_type)
    for table, types in by_table.items():
        rule = COST_RULES[types[0]]
        asked = named.filter(F.col("Cost_Type").isin(types))
        part = narrow(tables[table], asked, {"_seed": rule.key})
        if rule.compared:
            compared = narrow(tables["mrc_cmp"], asked, {"_seed": "BDT_MRC_ID"})
            part = lookup(
                part,
                best_match(compared),
                ["BDT_MRC_ID", "Invoice_Date"],
                {"CPID": "CPID", "BANMasterID": "BANMasterID"},
            )
        if len(types) == 1:
            record_type = (
                F.upper(rule.record_type_from) if rule.record_type_from else F.lit(rule.record_type)
            )
            columns = _payload(rule, F.lit(types[0]), F.col(rule.amount), record_type)
        else:
            choices = [
                F.struct(
                    F.lit(t).alias("cost_type"),
                    F.lit(COST_RULES[t].record_type).alias("record_type"),
                    F.col(COST_RULES[t].amount).alias("amount"),
                )
                for t in types
            ]
            part = part.withColumn("_c", F.explode(F.array(*choices)))
            columns = _payload(
                rule, F.col("_c.cost_type"), F.col("_c.amount"), F.col("_c.record_type")
            )
        frames.append(part.select(*columns))
    return union_all(*frames)


def enrich_by_cost_type(
    sub: DataFrame,
    tables: Mapping[str, DataFrame],
    cost_types: Iterable[str] = tuple(COST_RULES),
    seed: str = "Cost_Type_Seed",
) -> DataFrame:
    """Overwrite and fill the clean seed rows from the cost record they name.

    The cost tables are brought to one shape and met in a single join on (cost
    type, seed). Rows with another cost type pass unchanged; a seed that is not
    found is flagged, and the overwritten columns become null.
    """
    wanted = list(cost_types)
    records = cost_records(sub, tables, wanted, seed)
    records = first_per(
        records, ["Cost_Type", "Cost_Seed"], [F.col(c).asc() for c in records.columns[2:]]
    )
    offered = [c for c in records.columns if c not in ("Cost_Type", "Cost_Seed")]
    keyed = sub.withColumn("_seed", seed_number(seed))
    joined = lookup(
        keyed,
        records,
        {"Cost_Type": "Cost_Type", "_seed": "Cost_Seed"},
        {f"_b_{c}": c for c in offered},
        "_found",
    )
    return _filled(sub, joined, offered, wanted).drop("_seed")


def enrich_carried(mined: DataFrame, cost_types: Iterable[str] = tuple(COST_RULES)) -> DataFrame:
    """As `enrich_by_cost_type`, of rows that bring along their charge in `CARRIED`."""
    sub = mined.drop(CARRIED)
    carried = {f"_b_{c}": F.col(f"{CARRIED}.{c}") for c in OFFERED}
    joined = mined.withColumns(carried | {"_found": F.col(CARRIED).isNotNull()}).drop(CARRIED)
    return _filled(sub, joined, list(OFFERED), list(cost_types))


def _filled(sub: DataFrame, joined: DataFrame, offered: list[str], wanted: list[str]) -> DataFrame:
    """The rows of `sub`, overwritten and filled from the offered columns `_b_...` next to them."""
    active = F.col(ERROR_COLUMNS).isNull() & F.coalesce(
        F.col("Cost_Type").isin(wanted), F.lit(False)
    )
    have = existing(sub)

    def new(column: str) -> Column:
        return F.col(f"_b_{column}").cast(sub.schema[have[column.lower()]].dataType)

    def of_type(test) -> Column:
        return active & F.col("Cost_Type").isin([t for t in wanted if test(COST_RULES[t])])

    guards = {c: active for c in OVERWRITTEN}
    guards["Platform"] = of_type(lambda r: r.platform)
    guards["CPID"] = guards["BANMaster_ID"] = of_type(lambda r: r.compared)
    guards["USI"] = of_type(lambda r: bool(r.usi)) & is_blank("USI")
    guards |= {c: active & F.col(c).isNull() for c in FILLED}
    settled = {
        have[c.lower()]: F.when(guard, new(c)).otherwise(F.col(c))
        for c, guard in guards.items()
        if c in offered
    }
    settled["_missing"] = active & ~F.col("_found")
    filled = joined.withColumns(settled)
    flagged = validate(
        filled,
        [Rule("Cost_Type, Cost_Type_Seed", "Cost_Type_Seed does not exist", F.col("_missing"))],
    )
    return flagged.drop("_found", "_missing", *[f"_b_{c}" for c in offered])
