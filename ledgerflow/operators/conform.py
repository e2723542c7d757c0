"""Projections that bring a submission into its expected shape."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions import strip

ERROR_COLUMNS = "Error_Columns"
ERROR_MESSAGE = "Error_Message"


def existing(df: DataFrame) -> dict[str, str]:
    """Column names by their lower-case form."""
    return {c.lower(): c for c in df.columns}


def conform(df: DataFrame, columns: Iterable[str], with_errors: bool = True) -> DataFrame:
    """Add the expected columns that are missing as null text; extra columns stay."""
    wanted = list(columns) + ([ERROR_COLUMNS, ERROR_MESSAGE] if with_errors else [])
    have = existing(df)
    named = {c.lower(): c for c in wanted}
    kept = [F.col(c).alias(named.get(c.lower(), c)) for c in df.columns]
    added = [F.lit(None).cast("string").alias(c) for c in wanted if c.lower() not in have]
    return df.select(*kept, *added)


def trim_all(df: DataFrame) -> DataFrame:
    """Strip white space from every text column."""
    return df.select(
        *[
            strip(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def with_source(df: DataFrame, folder: str) -> DataFrame:
    return df.withColumn("Folder_Name", F.lit(folder))


def project_except(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def as_action_rows(
    df: DataFrame, constants: Mapping[str, object], empty: Mapping[str, str]
) -> DataFrame:
    """Stamp constant columns and add typed null placeholders."""
    columns = {c: v if isinstance(v, Column) else F.lit(v) for c, v in constants.items()}
    columns |= {c: F.lit(None).cast(t) for c, t in empty.items()}
    return df.withColumns(columns)


def coalesce_from(df: DataFrame, pairs: Mapping[str, str], drop: bool = True) -> DataFrame:
    """Fill column `a` from column `b` where `a` is null, for each pair a -> b."""
    filled = df.withColumns({a: F.coalesce(F.col(a), F.col(b)) for a, b in pairs.items()})
    return filled.drop(*pairs.values()) if drop else filled


def default_where(df: DataFrame, guard: Column, values: Mapping[str, object]) -> DataFrame:
    """Set columns on the rows that meet the guard; a null guard counts as not met."""
    return df.withColumns(
        {
            c: F.when(guard, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c))
            for c, v in values.items()
        }
    )


def initial_status(given: Column | str, dispute_type: Column | str) -> Column:
    """The given status, else Filed for Email disputes, else Pending Review."""
    given = F.col(given) if isinstance(given, str) else given
    kind = F.col(dispute_type) if isinstance(dispute_type, str) else dispute_type
    return F.coalesce(given, F.when(kind == "Email", "Filed"), F.lit("Pending Review"))


def prefixed(df: DataFrame, prefix: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The frame with every column (or only those named) under a prefix, so joins stay clear."""
    return df.select(*[F.col(c).alias(prefix + c) for c in (columns or df.columns)])
