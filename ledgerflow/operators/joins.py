"""Joins against reference tables.

No side is broadcast by hint: the optimiser broadcasts only what its size
statistics (static, then measured at run time) show to be small, and shuffles
otherwise, where adaptive execution splits a partition swollen by a hot key.
Reference sides are reduced to one row per key before they meet the facts, so
a hot key on the fact side is never multiplied and can be split freely.

Adaptive execution splits a join only if both sides come straight from a shuffle.
A reference that was just aggregated by the join key would be joined in place, and
a hot key on the other side would stay in one task. Such references are joined on
the key and its hash (`own_shuffle`): the second key asks for a shuffle of the small
side, and the large side can be split.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import as_moment
from ledgerflow.functions.dates import AsOf

Keys = Iterable[str] | Mapping[str, str]

def key_map(keys: Keys) -> dict[str, str]:
    """Keys as left name -> right name."""
    return dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}


_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def _common(left: str | None, right: str | None) -> str | None:
    """The type in which keys of two types are compared; null: as they are."""
    if left is None or right is None or left == right:
        return None
    if left in _INTEGRAL and right in _INTEGRAL:
        return "bigint"
    if "string" in (left, right):
        other = right if left == "string" else left
        return "bigint" if other in _INTEGRAL else other
    return None


def _aligned(
    df: DataFrame, ref: DataFrame, pairs: Mapping[str, str]
) -> tuple[list[Column], list[Column]]:
    """The key columns of either side in one type each.

    Files are all text, so a key is often text on one side and a number on the
    other; the text is read as a number, and text that is none matches nothing.
    Equality and hash use the same columns, so `007` is 7 for both.
    """
    have = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name.lower(): f.dataType.simpleString() for f in ref.schema.fields}
    left, right = [], []
    for a, b in pairs.items():
        kind = _common(have.get(a.lower()), want.get(b.lower()))
        left.append(F.col(a) if kind is None else F.col(a).try_cast(kind))
        right.append(F.col(b) if kind is None else F.col(b).try_cast(kind))
    return left, right


# Set on the key columns of a table that is kept in buckets of them: the names of all of them.
BUCKETED = "ledgerflow.bucketed_by"


def bucketed(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """The frame of a table that lies in buckets of unique keys, marked as such."""
    names = sorted(k.lower() for k in keys)
    return df.withColumns({k: F.col(k).alias(k, metadata={BUCKETED: names}) for k in keys})


def _lies_in_buckets(ref: DataFrame, keys: Iterable[str]) -> bool:
    names = sorted(k.lower() for k in keys)
    fields = {f.name.lower(): f.metadata for f in ref.schema.fields}
    return all(fields.get(k, {}).get(BUCKETED) == names for k in names)


def narrow(ref: DataFrame, df: DataFrame, keys: Keys) -> DataFrame:
    """The part of a large reference table that a batch can touch.

    A semi join keeps the table on the streamed side: a small batch is sent to
    the scan, a large one is met by a shuffle of the table by key and hash, which
    can be split where a key is hot. The keys are made distinct first, map-side, so
    a key that fills a third of the batch travels once per task.

    A table in buckets of these keys (`bucketed`) is met where it lies: only the
    batch's keys are shuffled. Its keys are unique and the batch's are distinct, so no
    bucket is hot. `lookup` then shuffles the part, which is no larger than the batch.
    """
    pairs = key_map(keys)
    wanted = df.select(*[F.col(a).alias(f"_k_{b}") for a, b in pairs.items()]).distinct()
    left, right = _aligned(ref, wanted, {b: f"_k_{b}" for b in pairs.values()})
    if _lies_in_buckets(ref, pairs.values()):
        return ref.join(wanted, [a == b for a, b in zip(left, right)], "left_semi")
    wanted = wanted.withColumns(
        {f"_q_{i}": c for i, c in enumerate(right)} | {"_h": F.xxhash64(*right)}
    )
    condition = [c == F.col(f"_q_{i}") for i, c in enumerate(left)]
    return ref.join(wanted, [*condition, F.xxhash64(*left) == F.col("_h")], "left_semi")


def lookup(
    df: DataFrame,
    ref: DataFrame,
    keys: Keys,
    columns: Mapping[str, str],
    marker: str | None = None,
    own_shuffle: bool = False,
    spread: str | None = None,
) -> DataFrame:
    """Left join a reference with one row per key; columns are new name -> reference name.

    Set `own_shuffle` where `ref` was grouped or ranked by the same keys; a part of a table
    in buckets of them gets it anyway, so that a hot key of `df` can be split. `spread` names
    a column that tells rows apart: rows without a key, which meet nothing, are dealt out by
    it instead of filling one partition.
    """
    pairs = key_map(keys)
    own_shuffle = own_shuffle or _lies_in_buckets(ref, pairs.values())
    right = ref.select(
        *[F.col(b).alias(f"_k_{b}") for b in pairs.values()],
        *[F.col(source).alias(name) for name, source in columns.items()],
        *([F.lit(True).alias(marker)] if marker else []),
    )
    mine, theirs = _aligned(df, right, {a: f"_k_{b}" for a, b in pairs.items()})
    condition = [a == b for a, b in zip(mine, theirs)]
    dropped = [f"_k_{b}" for b in pairs.values()]
    if own_shuffle or spread:
        right = right.withColumn("_h", F.xxhash64(*theirs))
        mixed = F.xxhash64(*mine)
        if spread:
            absent = reduce(or_, [c.isNull() for c in mine])
            mixed = F.when(absent, F.xxhash64(spread)).otherwise(mixed)
        condition.append(mixed == F.col("_h"))
        dropped.append("_h")
    joined = df.join(right, condition, "left").drop(*dropped)
    return joined.withColumn(marker, F.coalesce(marker, F.lit(False))) if marker else joined


def mark_existing(df: DataFrame, ref: DataFrame, keys: Keys, marker: str) -> DataFrame:
    """Add a boolean column: is the key present in the reference?"""
    pairs = key_map(keys)
    _, theirs = _aligned(df, ref, pairs)
    names = list(dict.fromkeys(pairs.values()))
    as_compared = dict(zip(pairs.values(), theirs))
    # Distinct as compared: `7` and `007` are one key where the other side has numbers.
    known = ref.select(*[as_compared[b].alias(b) for b in names]).distinct()
    return lookup(df, known, pairs, {}, marker, own_shuffle=True)


def with_employee(df: DataFrame, employee: DataFrame, marker: str = "_has_employee") -> DataFrame:
    """Add Full_Name and Initials of the submitter."""
    people = employee.groupBy("Comp_Serial").agg(
        F.min_by(F.struct("Full_Name", "Initials"), F.struct("Full_Name", "Initials")).alias("_who")
    )
    return (
        lookup(df, people, ["Comp_Serial"], {"_who": "_who"}, marker, own_shuffle=True)
        .withColumns({"Full_Name": F.col("_who.Full_Name"), "Initials": F.col("_who.Initials")})
        .drop("_who")
    )


def account_calendar(
    wanted: DataFrame,
    master: DataFrame,
    as_of: AsOf,
    key: str = "BAN",
    start: str = "Start_Date",
    end: str = "End_Date",
) -> DataFrame:
    """The master period of each wanted account and month, one row each.

    `wanted` has the account under the master's name and Month_End. The grain of
    the effective dates is the month. Only accounts and months that a batch names
    are met with the master, whose periods of one account are few; of overlapping
    periods the latest start wins, and `Periods` tells how many there were.
    """
    first = F.last_day(start)
    last = F.last_day(F.coalesce(F.col(end).cast("date"), as_moment(as_of).cast("date")))
    payload = [c for c in master.columns if c != key]
    asked = wanted.select(F.col(key).alias("_account"), "Month_End").distinct()
    order = F.struct(start, *[c for c in payload if c != start])
    covered = master.join(
        asked, [F.col(key) == F.col("_account"), F.col("Month_End").between(first, last)]
    )
    return (
        covered.groupBy("_account", "Month_End")
        .agg(F.max_by(F.struct(*payload), order).alias("_p"), F.count("*").alias("Periods"))
        .select(F.col("_account").alias(key), "Month_End", "Periods", "_p.*")
    )


def join_effective(
    df: DataFrame,
    master: DataFrame,
    as_of: AsOf,
    at: str,
    columns: Mapping[str, str],
    key: str = "BAN",
    master_key: str = "BAN",
    start: str = "Start_Date",
    end: str = "End_Date",
) -> DataFrame:
    """Left join the master period that covers the month of `at`.

    `columns` may ask for `Periods`, which is over 1 where periods overlap.
    """
    dated = df.withColumn("_month", F.last_day(at))
    wanted = dated.select(F.col(key).alias(master_key), F.col("_month").alias("Month_End"))
    calendar = account_calendar(wanted, master, as_of, master_key, start, end)
    months = {key: master_key, "_month": "Month_End"}
    return lookup(dated, calendar, months, columns, own_shuffle=True).drop("_month")


def join_chain(df: DataFrame, steps: Iterable[tuple[DataFrame, Keys, Mapping[str, str]]]) -> DataFrame:
    """Left join a chain of dimensions, each keyed by what the former one added."""
    for ref, keys, columns in steps:
        df = lookup(df, ref, keys, columns)
    return df


def conditional_lookup(
    df: DataFrame, ref: DataFrame, guard: Column, keys: Keys, columns: Mapping[str, str]
) -> DataFrame:
    """Left join where the guard on the left row is part of the join condition."""
    pairs = key_map(keys)
    right = ref.select(
        *[F.col(b).alias(f"_k_{b}") for b in pairs.values()],
        *[F.col(source).alias(name) for name, source in columns.items()],
    )
    mine, theirs = _aligned(df, right, {a: f"_k_{b}" for a, b in pairs.items()})
    condition = [guard, *[a == b for a, b in zip(mine, theirs)]]
    return df.join(right, condition, "left").drop(*[f"_k_{b}" for b in pairs.values()])
