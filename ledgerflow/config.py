"""Typed job configuration and session defaults."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

# Inbox folders, in the order in which they are served.
FOLDER_RANK = {
    "01_BMI-PCI": 1,
    "02_Seeds": 2,
    "03_Non-Seeds": 3,
    "04_Dispute-Actions": 4,
}

# Actions accepted by the review folder.
REVIEW_ACTIONS = (
    "Map",
    "Dispute",
    "Send to Prov",
    "Send to LV",
    "Dispute Note",
    "Escalate Disputes",
    "Paid Disputes",
    "Close Disputes",
    "Send to Audit",
    "Ticket Opened",
)

# Actions accepted by the dispute-action folder.
DISPUTE_ACTIONS = ("Escalate", "Close", "Paid", "Denied", "Approved", "Dispute Note")

# Cost types a seed may name.
COST_TYPES = ("PC-MRC", "PC-NRC", "PC-FRAC", "MRC", "OCC", "TAS", "USAGE", "LPC", "ADJ")

# Fixed value: the category that the review jobs work on.
REVIEW_CATEGORY = "GRT CNR"


@dataclass(frozen=True)
class JobConfig:
    """Settings that a site is expected to change."""

    review_actions: tuple[str, ...] = REVIEW_ACTIONS
    other_review_actions: tuple[str, ...] = ()
    dispute_actions: tuple[str, ...] = DISPUTE_ACTIONS
    cost_types: tuple[str, ...] = COST_TYPES
    note_day_limit: int = 30
    prov_note_days: int = 14
    lv_note_days: int = 14
    # Folder of the files that line verification takes along; none are looked up without it.
    attachment_folder: str | None = None
    # Days for which a copy of a served row is refused; copies are served without it.
    copy_days: int | None = None


def session(app_name: str = "ledgerflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans rely on; cluster sizing stays with the caller."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # Call sites are recorded per column call, at several round trips to the JVM each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
