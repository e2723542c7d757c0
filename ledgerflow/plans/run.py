"""Serving whole inbox folders: dispatch, folding of table states, error return."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.config import JobConfig
from ledgerflow.functions.dates import AsOf
from ledgerflow.operators.conform import conform
from ledgerflow.operators.filters import flag_unlisted, rejected, split_by
from ledgerflow.operators.keys import stable
from ledgerflow.operators.relational import collect_errors, union_all
from ledgerflow.operators.validate import outcome_summary
from ledgerflow.plans.dispute import (
    NONSEED_COLUMNS,
    SEED_COLUMNS,
    nonseed_disputes,
    seed_disputes,
)
from ledgerflow.plans.review import REVIEW_COLUMNS, REVIEW_JOBS, other_job
from ledgerflow.plans.state import Layers
from ledgerflow.plans.tables import JobResult, Tables
from ledgerflow.plans.transitions import ACTION_COLUMNS, direct_actions
from ledgerflow.sources.attachments import scan_attachments

# The table of attachments that a stream keeps.
ATTACHMENTS = "attachments"

# Actions whose jobs read the job settings and give out keys.
CONFIGURED = (
    "Dispute Note",
    "Escalate Disputes",
    "Paid Disputes",
    "Close Disputes",
    "Send to Prov",
    "Send to LV",
)


def advance(tables: Tables, result: JobResult) -> dict[str, DataFrame]:
    """The tables after a job."""
    layers = Layers(tables)
    layers.push(result)
    return layers.tables()


def attachments(spark: SparkSession, tables: Tables, config: JobConfig) -> DataFrame | None:
    """The listing that comes with the tables, else one made now if a folder is set."""
    if ATTACHMENTS in tables:
        return tables[ATTACHMENTS]
    return scan_attachments(spark, config.attachment_folder) if config.attachment_folder else None


def review_folder(
    sub: DataFrame,
    tables: Tables,
    as_of: AsOf,
    config: JobConfig = JobConfig(),
    starts: Mapping[str, int] | None = None,
) -> JobResult:
    """All actions of a review file, in the configured order; unlisted actions are errors.

    Each job is planned on the tables as the jobs before it left them: the tables, and
    a layer of changed keys above them. Actions that no row asks for are skipped.
    """
    listed = (*config.review_actions, *config.other_review_actions)
    rows = stable(flag_unlisted(conform(sub, REVIEW_COLUMNS), "Action", listed))
    asked = rows.filter(F.col("Action").isin(list(listed))).select("Action").distinct()
    present = {r[0] for r in asked.collect()}
    slices = split_by(rows, "Action", [a for a in listed if a in present])
    layers = Layers(tables, starts)
    outcomes = [rejected(rows)]
    for action, part in slices.items():
        job = REVIEW_JOBS.get(action, other_job)
        extra: dict = {"config": config} if action in CONFIGURED else {}
        if action == "Dispute":
            extra["cost_types"] = config.cost_types
        if extra:
            extra["starts"] = layers.counters
        if action == "Send to LV":
            extra["files"] = attachments(sub.sparkSession, tables, config)
        result = job(part, layers.tables(), as_of, **extra)
        outcomes.append(result.results)
        layers.push(result)
    return layers.result(union_all(*outcomes))


FOLDER_COLUMNS: dict[str, tuple[str, ...]] = {
    "01_BMI-PCI": REVIEW_COLUMNS,
    "02_Seeds": SEED_COLUMNS,
    "03_Non-Seeds": NONSEED_COLUMNS,
    "04_Dispute-Actions": ACTION_COLUMNS,
}


def own_columns(df: DataFrame, folder: str) -> DataFrame:
    """Without the columns that only other folders use; a stream reads all folders alike."""
    mine = {c.lower() for c in FOLDER_COLUMNS[folder]}
    known = {c.lower() for columns in FOLDER_COLUMNS.values() for c in columns}
    return df.drop(*[c for c in df.columns if c.lower() in known - mine])


def run_folder(
    folder: str,
    sub: DataFrame,
    tables: Tables,
    as_of: AsOf,
    config: JobConfig = JobConfig(),
    starts: Mapping[str, int] | None = None,
) -> JobResult:
    """The job of one inbox folder; `starts` are the next free keys, looked up if not told."""
    if folder not in FOLDER_COLUMNS:
        raise ValueError(f"no job for folder {folder}")
    sub = own_columns(sub, folder)
    if folder == "01_BMI-PCI":
        return review_folder(sub, tables, as_of, config, starts)
    if folder == "02_Seeds":
        return seed_disputes(sub, tables, as_of, config.cost_types, starts=starts)
    if folder == "03_Non-Seeds":
        return nonseed_disputes(sub, tables, as_of, starts=starts)
    return direct_actions(sub, tables, as_of, config, starts=starts)


def error_return(results: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(all rejected rows, each once; error counts per folder and submitter)."""
    errors = collect_errors(
        *[rejected(df).withColumn("Folder_Name", F.lit(name)) for name, df in results.items()]
    )
    return errors, errors.groupBy("Folder_Name", "Comp_Serial").agg(F.count("*").alias("N_Error"))


def action_summary(result: JobResult) -> DataFrame:
    return outcome_summary(result.results, "Folder_Name", "Action")
