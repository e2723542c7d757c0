"""Table and error-file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.conform import ERROR_COLUMNS
from ledgerflow.operators.joins import lookup
from ledgerflow.operators.keys import assign_ids, stable
from ledgerflow.sources.rowset import OTHER_VALUES

ROWS_PER_FILE = 100_000


def append(df: DataFrame, path: str, line_number: list[str] | None = None) -> None:
    """Append to a parquet table; `line_number` names the order of a `linenumber` column from 0."""
    rows = assign_ids(df, line_number, 0, "linenumber") if line_number else df
    rows.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch as its own partition; a replay replaces what the first try left."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def error_records(errors: DataFrame) -> DataFrame:
    """Rejected rows as records of named values; null and empty values are left out.

    Values of attributes that no job lists follow the others under their own names.
    """
    fields = [c for c in errors.columns if c not in ("Comp_Serial", OTHER_VALUES)] + ["Comp_Serial"]
    values = F.array(
        *[
            F.struct(F.lit(c).alias("_var_name"), F.col(c).cast("string").alias("_VALUE"))
            for c in fields
        ]
    )
    kept = F.filter(values, lambda v: v["_VALUE"].isNotNull() & (v["_VALUE"] != ""))
    if OTHER_VALUES in errors.columns:
        named = F.map_entries(F.from_json(OTHER_VALUES, "map<string,string>"))
        others = F.transform(named, lambda e: F.struct(e["key"].alias("_var_name"), e["value"].alias("_VALUE")))
        kept = F.concat(kept, F.coalesce(others, F.array().cast("array<struct<_var_name:string,_VALUE:string>>")))
    return errors.select(F.col("Comp_Serial"), kept.alias("var"))


def salted(errors: DataFrame, rows_per_file: int) -> DataFrame:
    """The records with `_salt`: each submitter has as many salts as its rows need files.

    One partial aggregate counts the rows; the counts are joined back in a way that
    adaptive execution may split for a submitter with most of the errors.
    """
    who = F.coalesce(F.col("Comp_Serial").cast("string"), F.lit(""))
    rows = errors.withColumn("_who", who)
    salts = rows.groupBy("_who").agg(F.ceil(F.count("*") / rows_per_file).alias("_salts"))
    sized = lookup(rows, salts, ["_who"], {"_salts": "_salts"}, own_shuffle=True)
    return sized.withColumn("_salt", F.pmod(F.xxhash64(F.to_json("var")), "_salts")).drop("_who", "_salts")


def write_error_files(
    df: DataFrame, path: str, mode: str = "append", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """The rejected rows as XML, one folder per submitter.

    Rows are spread by submitter and a salt, so that a submitter with a large share of
    the errors is written by several tasks, as several files.
    """
    rejected = stable(df.filter(F.col(ERROR_COLUMNS).isNotNull()))
    (
        salted(error_records(rejected), rows_per_file)
        .repartition("Comp_Serial", "_salt")
        .drop("_salt")
        .write.mode(mode)
        .partitionBy("Comp_Serial")
        .format("xml")
        .option("rootTag", "records")
        .option("rowTag", "record")
        .save(path)
    )
