"""Dense keys for appended rows, and stable copies of intermediate frames."""

from __future__ import annotations

import atexit
import contextlib
import re
import uuid
from collections.abc import Iterable, Mapping
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# monotonically_increasing_id: the partition number lies above the row position.
POSITION_BITS = 33


# Lines in one bucket of `number_lines`; the driver holds two numbers a bucket.
LINE_BITS = 14


def _remove(folder: str) -> None:
    with contextlib.suppress(Exception):
        system, place = fs.FileSystem.from_uri(folder)
        system.delete_dir(place)


@cache
def _below(warehouse: str) -> str:
    """A folder of this process in the warehouse, removed when the process ends."""
    folder = f"{re.sub('^file:/+', 'file:///', warehouse)}/_work-{uuid.uuid4().hex}"
    atexit.register(_remove, folder)
    return folder


def work_dir(spark: SparkSession) -> str:
    """The folder for written intermediate tables, which all executors share.

    `spark.checkpoint.dir` names it; without the setting it is a folder in the
    session's warehouse, which executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or _below(spark.conf.get("spark.sql.warehouse.dir"))


def stable(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and read it back.

    The copy outlives lost executors and cuts the lineage; being columnar, later
    steps read only the columns they use.
    """
    path = f"{work_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def number_rows(
    df: DataFrame,
    order: Iterable[str],
    starts: Mapping[str, int],
    partitions: int | None = None,
    break_ties: bool = False,
) -> tuple[DataFrame, int]:
    """The rows with dense ids in the given order, and their number.

    The rows are range-partitioned and sorted, written once with their position,
    and numbered by adding to each position the number of rows in the partitions
    before. Only one count per partition is summed in one place. Spark samples the
    input to find the ranges, so it should be a written frame, not a plan to be run twice.

    `order` should identify a row. Where many rows may share it, `break_ties`
    fixes the position of every row first and orders by it last, which keeps a
    crowd of equal rows from falling into one range. Several ids run in step.
    """
    columns = df.columns
    keys = list(order)
    if break_ties:
        df = stable(df.withColumn("_tie", F.monotonically_increasing_id()))
        keys.append("_tie")
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *keys)
    placed = stable(
        ranged.sortWithinPartitions(*keys)
        .select(*columns)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    part = F.shiftright("_pos", POSITION_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).collect()
    total, offsets = 0, []
    for row in sorted(counts, key=lambda r: r["_part"]):
        offsets.append((row["_part"], total))
        total += row["_n"]
    before = F.broadcast(
        df.sparkSession.createDataFrame(offsets or [(0, 0)], "_part long, _before long")
    )
    rank = F.col("_before") + F.col("_pos").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    numbered = (
        placed.withColumn("_part", part)
        .join(before, "_part")
        .select(*columns, *[(rank + F.lit(first)).alias(name) for name, first in starts.items()])
    )
    return numbered, total


def assign_ids(
    df: DataFrame,
    order: list[str],
    start: int | dict[str, int] = 1,
    id_col: str = "id",
    partitions: int | None = None,
    break_ties: bool = False,
) -> DataFrame:
    """Dense ids in the given order, the same for any number of partitions.

    A dict as `start` adds several id columns that run in step; see `number_rows`.
    """
    starts = start if isinstance(start, dict) else {id_col: start}
    return number_rows(df, order, starts, partitions, break_ties)[0]


def number_lines(
    df: DataFrame, starts: Mapping[str, int], line: str = "Line_ID", bits: int = LINE_BITS
) -> tuple[DataFrame, int]:
    """The rows with dense ids in the order of a whole number that no two rows share, and their number.

    Consecutive lines share a bucket. The rows of each bucket are counted (the
    frame should be a written one, of which only this column is read), the counts are
    summed up over the buckets before, and a row's rank in its bucket is added. So
    there are no ranges to be sampled, and no copy to be written: the ids are a
    column of the plan that goes on. A bucket has 2^bits lines at most, whatever
    their distribution.
    """
    bucket = F.shiftright(F.col(line).cast("bigint"), bits)
    counts = df.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).toArrow().sort_by("b")
    n = counts["n"].to_numpy()
    before = pa.table({"_bucket": counts["b"], "_before": pa.array(np.cumsum(n) - n, pa.int64())})
    offsets = df.sparkSession.createDataFrame(before)
    rank = F.row_number().over(W.partitionBy("_bucket").orderBy(line)) - 1
    numbered = (
        df.withColumn("_bucket", bucket)
        .withColumn("_rank", rank)
        .join(offsets, "_bucket")
        .withColumns({name: F.col("_before") + F.col("_rank") + F.lit(first) for name, first in starts.items()})
        .drop("_bucket", "_before", "_rank")
    )
    return numbered, int(n.sum())


def next_id(table: DataFrame, column: str) -> int:
    """One above the greatest key in use."""
    return (table.agg(F.max(F.col(column).cast("long"))).first()[0] or 0) + 1
