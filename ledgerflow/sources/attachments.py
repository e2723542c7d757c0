"""Attachments named after the source they belong to."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.relational import union_all
from ledgerflow.sources.sinks import append_batch

# Fixed value: `<Source_TBL>_<Source_ID>`, the id ending at the first non-digit.
NAME_PATTERN = r"^([A-Za-z]+)_(\d+)(?!\d).*"


def scan_attachments(spark: SparkSession, path: str, after: int | None = None) -> DataFrame:
    """Source key, file name and time of every attachment, or of those that changed after a
    moment (seconds since 1970); file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if after is not None:
        moment = datetime.fromtimestamp(after, UTC).strftime("%Y-%m-%dT%H:%M:%S")
        reader = reader.option("modifiedAfter", moment).option("timeZone", "UTC")
    files = (
        reader.load(path)
        .select("path", "modificationTime", "length")
        .withColumn("File_Name", F.url_decode(F.element_at(F.split("path", "/"), -1)))
    )
    return files.filter(F.col("File_Name").rlike(NAME_PATTERN)).select(
        F.regexp_extract("File_Name", NAME_PATTERN, 1).alias("Source_TBL"),
        F.regexp_extract("File_Name", NAME_PATTERN, 2).alias("Source_ID"),
        "File_Name",
        F.col("modificationTime").alias("Modified"),
        "length",
    )


KEPT = "Source_TBL string, Source_ID string, File_Name string, Modified timestamp, length long"


def kept_listing(spark: SparkSession, root: str, before_batch: int) -> DataFrame:
    """The attachments that the batches before `before_batch` listed."""
    try:
        kept = spark.read.schema(f"{KEPT}, batch_id int").parquet(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], KEPT)
    return kept.filter(F.col("batch_id") < before_batch).drop("batch_id")


def extend_listing(spark: SparkSession, root: str, folder: str, batch_id: int) -> DataFrame:
    """The kept listing, extended by what came since its greatest time; a replay repeats its part.

    Files of the last second are looked at again, as more may have come in it.
    """
    kept = kept_listing(spark, root, batch_id)
    last = kept.agg(F.unix_seconds(F.max("Modified"))).first()[0]
    found = scan_attachments(spark, folder, None if last is None else last - 2)
    same = ["Source_TBL", "Source_ID", "File_Name", "Modified"]
    append_batch(found.join(kept.select(*same), same, "left_anti"), root, batch_id)
    return union_all(kept, spark.read.schema(KEPT).parquet(f"{root}/batch_id={batch_id}"))
