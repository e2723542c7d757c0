"""Table state across batches: a base, appended rows, and the rows that a batch changed.

Below one root:

    base/<table>/upto=<n>          all rows as batch n left them; -1 for the start
    appends/<table>/batch_id=<n>   rows that batch n appended
    changes/<table>/batch_id=<n>   all rows of the keys that batch n changed, as it left them
    counters/batch_id=<n>          the next free value of each dense key after batch n

A batch writes only what it touched. `load_state` gives the tables as the batches
before a given one left them, so a replayed batch reads what its first try read and
overwrites what that try wrote. `compact` writes a new base, from time to time.

Within a batch, `Layers` holds the state: the tables as they were, and above each one a
layer of the keys that were changed so far. The layer is a written copy of its own,
however many jobs went into it, so a job's plan reads each table once and does not
grow with the number of jobs before it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerflow.operators.filters import clean
from ledgerflow.operators.joins import narrow
from ledgerflow.operators.keys import stable
from ledgerflow.operators.relational import union_all
from ledgerflow.plans.tables import KEYED_TABLES, TABLE_NAMES, JobResult, Tables, first_free
from ledgerflow.sources.sinks import append_batch

COUNTERS = "key string, next long"

# The key of each table that jobs change, and where a submitted row names it.
CHANGED_BY: dict[str, dict[str, str]] = {
    "dispute_current": {"DSB_ID": "DSB_ID"},
    "worklist": {"Source_TBL": "Source_TBL", "Source_ID": "Source_ID"},
    "bmm": {"Source_No": "BMI_ID"},
    "pci": {"Source_No": "ID"},
}


def changed_rows(result: JobResult) -> dict[str, DataFrame]:
    """Of each new snapshot, all rows of the keys that the job may have changed.

    The optimiser moves the semi join below the update, so that only those keys
    of the table are updated at all.
    """
    out = {}
    for name, snapshot in result.snapshots.items():
        if name in result.changed:
            out[name] = result.changed[name]
            continue
        pairs = CHANGED_BY[name]
        rows = result.changes.get(name)
        if rows is None:
            rows = clean(result.results)
        out[name] = narrow(snapshot, rows.select(*pairs), pairs)
    return out


def _without(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key `other` does not have; null keys are equal."""
    known = other.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return rows.join(known, same, "left_anti")


class Layers:
    """Tables in the course of several jobs, and the next free keys."""

    def __init__(self, tables: Tables, counters: Mapping[str, int] | None = None):
        self.base = dict(tables)
        self.added: dict[str, list[DataFrame]] = {}
        self.changed: dict[str, DataFrame] = {}
        self.counters = dict(counters or {})

    def table(self, name: str) -> DataFrame:
        rows = self.base.get(name)
        added = self.added.get(name, [])
        rows = union_all(*([] if rows is None else [rows]), *added) if added else rows
        top = self.changed.get(name)
        if top is None:
            return rows
        return union_all(_without(rows, top, list(CHANGED_BY[name].values())), top)

    def tables(self) -> dict[str, DataFrame]:
        """The tables as the jobs so far left them."""
        return {name: self.table(name) for name in {**self.base, **self.added}}

    def push(self, result: JobResult) -> None:
        """Take over what a job did."""
        for name, rows in changed_rows(result).items():
            new = rows if name in result.changed else stable(rows)
            old = self.changed.get(name)
            if old is not None:
                keys = list(CHANGED_BY[name].values())
                new = stable(union_all(_without(old, new, keys), new))
            self.changed[name] = new
        for name, rows in result.appends.items():
            self.added.setdefault(name, []).append(rows)
        self.counters |= result.counters

    def result(self, results: DataFrame) -> JobResult:
        """All jobs as one."""
        return JobResult(
            results,
            {name: union_all(*rows) for name, rows in self.added.items()},
            {name: self.table(name) for name in self.changed},
            changed=dict(self.changed),
            counters=dict(self.counters),
        )


def commit(
    parts: Mapping[str, Mapping[str, Iterable[DataFrame]]],
    root: str,
    batch_id: int,
    counters: tuple[SparkSession, Mapping[str, int]] | None = None,
) -> None:
    """Write what a batch appended and changed; a replay overwrites its first try.

    `parts` maps "appends" and "changes" to frames by table; of changed rows of one
    key the last frame wins. `counters` are the session and the next free keys.
    """
    for name, frames in parts.get("appends", {}).items():
        append_batch(union_all(*frames), f"{root}/appends/{name}", batch_id)
    for name, frames in parts.get("changes", {}).items():
        frames = list(frames)
        rows = frames[0]
        if len(frames) > 1:
            placed = union_all(*[f.withColumn("_place", F.lit(i)) for i, f in enumerate(frames)])
            rows = _latest(placed, list(CHANGED_BY[name].values()), "_place")
        append_batch(rows, f"{root}/changes/{name}", batch_id)
    if counters and counters[1]:
        spark, values = counters
        append_batch(spark.createDataFrame(list(values.items()), COUNTERS), f"{root}/counters", batch_id)


def load_counters(spark: SparkSession, root: str, before_batch: int) -> dict[str, int]:
    """The next free keys as the batches before `before_batch` left them; empty if none were kept."""
    kept = _read(spark, f"{root}/counters")
    if kept is None:
        return {}
    newest = kept.filter(F.col("batch_id") < before_batch).groupBy("key")
    return {r["key"]: r["next"] for r in newest.agg(F.max_by("next", "batch_id").alias("next")).collect()}


def _latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """All rows of each key that have the greatest value of `order`."""
    last = F.rank().over(W.partitionBy(*keys).orderBy(F.col(order).desc()))
    return df.withColumn("_last", last).filter("_last = 1").drop("_last", order)


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def save_base(tables: Tables, root: str, upto: int = -1) -> None:
    """Write whole tables as the state that the batches up to `upto` left."""
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{root}/base/{name}/upto={upto}")
    spark = next(iter(tables.values())).sparkSession
    known = load_counters(spark, root, upto + 1)
    keys = [k for k, name in KEYED_TABLES.items() if name in tables]
    if keys:
        commit({}, root, upto, (spark, first_free(tables, keys, known)))


def load_state(
    spark: SparkSession, root: str, before_batch: int, names: Iterable[str] = TABLE_NAMES
) -> dict[str, DataFrame]:
    """The tables as the batches before `before_batch` left them; absent tables are left out."""
    tables = {}
    for name in names:
        base = _read(spark, f"{root}/base/{name}")
        if base is None:
            continue
        # A partition column: answered from the folder names.
        upto = base.filter(F.col("upto") < before_batch).agg(F.max("upto")).first()[0]
        rows = base.filter(F.col("upto") == upto).drop("upto")
        later = (F.col("batch_id") > upto) & (F.col("batch_id") < before_batch)
        added = _read(spark, f"{root}/appends/{name}")
        if added is not None:
            rows = union_all(rows, added.filter(later).drop("batch_id"))
        changed = _read(spark, f"{root}/changes/{name}")
        if changed is not None:
            keys = list(CHANGED_BY[name].values())
            newest = _latest(changed.filter(later), keys, "batch_id")
            rows = union_all(_without(rows, newest, keys), newest)
        tables[name] = rows
    return tables


def compact(spark: SparkSession, root: str, upto: int, names: Iterable[str] = TABLE_NAMES) -> None:
    """A new base as of batch `upto`; older parts stay for replays until they are deleted."""
    save_base(load_state(spark, root, upto + 1, names), root, upto)
