"""Top-one per group, set operations and reshaping."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerflow.functions import split_csv


def latest_by(df: DataFrame, keys: Iterable[str], order: Iterable[str | Column]) -> DataFrame:
    """The row with the greatest order value per key, by a partial aggregate."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_r")).select(*keys, "_r.*")


def first_per(df: DataFrame, keys: Iterable[str], order: Iterable[Column]) -> DataFrame:
    """The first row per key in a mixed ascending and descending order.

    `row_number() = 1` lets the optimiser cut every group to one row per task
    before the shuffle, so a hot group never meets in one place.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def collect_errors(*frames: DataFrame) -> DataFrame:
    """Union by name, missing columns null, exact copies once."""
    return union_all(*frames).dropDuplicates()


def explode_csv(df: DataFrame, column: str, flag: str) -> DataFrame:
    """One row per item of a comma list, and a flag that tells if there were several."""
    items = split_csv(column)
    return df.withColumns(
        {flag: (F.instr(F.col(column), ",") > 0).cast("int"), "_items": items}
    ).withColumn(column, F.explode("_items")).drop("_items")
