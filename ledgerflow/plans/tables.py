"""What jobs take and give."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.operators.joins import bucketed
from ledgerflow.operators.keys import next_id

Tables = Mapping[str, DataFrame]

# The business tables by role.
TABLE_NAMES = (
    "employee",
    "ban_master",
    "platform_master",
    "vendor_master",
    "bmi",
    "pci",
    "bmm",
    "bmb",
    "pci_bmb",
    "ll",
    "brd",
    "ded",
    "ld",
    "tf",
    "mrc",
    "mrc_cmp",
    "occ",
    "tas",
    "usage",
    "adj",
    "lpc",
    "paper_cost",
    "limitations",
    "worklist",
    "unmapped",
    "pci_unmapped",
    "zero_revenue",
    "pci_zero_revenue",
    "dispute_header",
    "dispute_detail",
    "dispute_history",
    "dispute_current",
    "dispute_notes",
    "cust_file",
    "queue_prov",
    "queue_lv",
    "ticket_core",
    "ticket_status",
)


# Where each dense key is in use.
KEYED_TABLES = {
    "DSB_ID": "dispute_header",
    "DS_ID": "dispute_detail",
    "DH_ID": "dispute_history",
    "DN_ID": "dispute_notes",
}


def first_free(
    tables: Tables, keys: Iterable[str], starts: Mapping[str, int] | None = None
) -> dict[str, int]:
    """The next free value of each key: as told, else one above the greatest in use."""
    told = starts or {}
    return {k: told[k] if k in told else next_id(tables[KEYED_TABLES[k]], k) for k in keys}


@dataclass
class JobResult:
    """Every submitted row with its outcome, rows to append, and new table states.

    `changes` holds, for a changed table, only the changed rows with their new
    values: for catalogs that can merge them instead of taking the whole state.
    `changed` holds, written, all rows of the changed keys as the jobs of a folder left
    them. A snapshot is the whole table, rows that were appended to it included.
    `counters` names, for each key that the job gave out, the next one that is free.
    """

    results: DataFrame
    appends: dict[str, DataFrame] = field(default_factory=dict)
    snapshots: dict[str, DataFrame] = field(default_factory=dict)
    changes: dict[str, DataFrame] = field(default_factory=dict)
    changed: dict[str, DataFrame] = field(default_factory=dict)
    counters: dict[str, int] = field(default_factory=dict)


def load_tables(spark: SparkSession, root: str, names: tuple[str, ...] = TABLE_NAMES) -> Tables:
    """Business tables kept as parquet folders below one root."""
    return {name: spark.read.parquet(f"{root}/{name}") for name in names}


# The unique keys by which jobs look up the large tables.
BUCKET_KEYS = {
    "dispute_current": ("DSB_ID",),
    "dispute_history": ("DH_ID",),
    "mrc": ("BDT_MRC_ID",),
    "occ": ("BDT_OCC_ID",),
    "tas": ("BDT_TAS_ID",),
    "usage": ("BDT_USAGE_ID",),
    "adj": ("BDT_PAD_ID",),
    "lpc": ("BDT_INVOICE_ID",),
    "paper_cost": ("Seed",),
    "bmi": ("BMI_ID",),
}


def save_bucketed(tables: Tables, buckets: int, prefix: str = "") -> None:
    """Write the large tables into the catalog, in sorted buckets of their keys.

    A batch then meets them without moving them (`narrow`). The number of buckets is
    that of the tasks that a whole table should have.
    """
    for name, keys in BUCKET_KEYS.items():
        if name in tables:
            rows = tables[name].repartition(buckets, *keys)
            rows.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(prefix + name)


def load_bucketed(spark: SparkSession, prefix: str = "", names: Iterable[str] = tuple(BUCKET_KEYS)) -> dict[str, DataFrame]:
    """The tables of `save_bucketed`, marked for what they are."""
    return {name: bucketed(spark.table(prefix + name), BUCKET_KEYS[name]) for name in names}
