"""Submission files: rowset XML, one `z:row` element per record, attributes as columns."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.config import FOLDER_RANK
from ledgerflow.operators.keys import stable

OPTIONS = {
    "rowTag": "z:row",
    "attributePrefix": "",
    "valueTag": "_text",
    "ignoreNamespace": "false",
    "mode": "PERMISSIVE",
}

PROVENANCE = ("File_Path", "Folder_Name", "Folder_Rank")


def text_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def with_provenance(df: DataFrame) -> DataFrame:
    """The file of each row, the folder it lay in, and the rank of that folder."""
    folder = F.element_at(F.split("File_Path", "/"), -2)
    ranks = F.create_map(*[F.lit(x) for pair in FOLDER_RANK.items() for x in pair])
    return (
        df.select("*", F.col("_metadata.file_path").alias("File_Path"))
        .withColumn("Folder_Name", F.url_decode(folder))
        .withColumn("Folder_Rank", F.element_at(ranks, F.col("Folder_Name")))
    )


def read_rowset(
    spark: SparkSession,
    path: str | list[str],
    columns: Iterable[str],
    row_tag: str = "z:row",
) -> DataFrame:
    """Rows of the rowset files, every listed column as text, with provenance.

    A column may come as an attribute or as a child element of its row.
    """
    options = OPTIONS | {"rowTag": row_tag}
    reader = spark.read.format("xml").options(**options).schema(text_schema(columns))
    return with_provenance(reader.load(path))


# The column that carries, as JSON, the values of attributes that no job lists.
OTHER_VALUES = "Other_Values"
# Set for a record that cannot be read.
UNREAD = "_unread"


def attribute_names(spark: SparkSession, path: str | list[str], row_tag: str = "z:row") -> list[str]:
    """The names that occur in the rows of the files, of attributes or child elements.

    One value a name comes back, however many rows. Values are not taken from here: a
    variant reads `007` as a number.
    """
    options = OPTIONS | {"rowTag": row_tag, "singleVariantColumn": "v"}
    rows = spark.read.format("xml").options(**options).load(path)
    names = F.map_keys(F.expr("try_cast(v AS map<string, string>)"))
    found = rows.select(F.explode(names).alias("name")).distinct().collect()
    return sorted(r["name"] for r in found if r["name"] != OPTIONS["valueTag"])


def read_open_rowset(
    spark: SparkSession,
    path: str | list[str],
    columns: Iterable[str],
    row_tag: str = "z:row",
) -> DataFrame:
    """As `read_rowset`, and no value is lost: unlisted ones are in `OTHER_VALUES`.

    `UNREAD` tells which records could not be read; their other columns are null.
    """
    columns = list(columns)
    listed = {c.lower() for c in columns}
    # Names are compared without case, as the reader does.
    others = {n.lower(): n for n in attribute_names(spark, path, row_tag) if n.lower() not in listed}
    names = list(others.values())
    options = OPTIONS | {"rowTag": row_tag, "columnNameOfCorruptRecord": UNREAD, "ignoreSurroundingSpaces": "false"}
    reader = spark.read.format("xml").options(**options).schema(text_schema((*columns, *names, UNREAD)))
    rows = with_provenance(reader.load(path)).withColumn(UNREAD, F.col(UNREAD).isNotNull())
    given = F.to_json(F.struct(*[F.col(f"`{n}`") for n in names])) if names else F.lit("{}")
    return rows.withColumn(OTHER_VALUES, F.when(given != "{}", given)).drop(*names)


def whole_files(spark: SparkSession, path: str | list[str], root: str = "xml") -> DataFrame:
    """The files (File_Path) that have the closing tag of their root: those that are not cut off.

    Read tag by tag, so that a file of one long line is no long row. A record that stops at
    the end of its file is no record to the reader, so nothing else tells of it.
    """
    tags = spark.read.option("lineSep", ">").text(path)
    ends = tags.filter(F.trim("value").endswith(f"</{root}"))
    return ends.select(F.col("_metadata.file_path").alias("File_Path")).distinct()


def plain_path(c: str, encoded: bool = False) -> Column:
    """A file's path in one spelling, whoever names it."""
    path = F.col(c)
    if encoded:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, "^file:/+", "/")


def literal_path(path: str) -> str:
    """The path with the characters of patterns masked."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def with_line_id(df: DataFrame) -> DataFrame:
    """Number the rows once; the copy keeps the numbers when a task is run again."""
    return stable(df.withColumn("Line_ID", F.monotonically_increasing_id()))


def route(df: DataFrame) -> dict[str, DataFrame]:
    """One lazy slice per inbox folder, in serving order."""
    return {name: df.filter(F.col("Folder_Name") == name) for name in FOLDER_RANK}


def empty_files(df: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Files that gave no row at all, such as truncated ones; to be looked at, not dropped."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.xml")
        .load(path)
        .select(F.regexp_replace("path", "^file:/+", "/").alias("_path"), "length")
    )
    seen = df.select(F.regexp_replace("File_Path", "^file:/+", "/").alias("_path")).distinct()
    return files.join(seen, "_path", "left_anti").withColumnRenamed("_path", "File_Path")
