"""Row predicates."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.conform import ERROR_COLUMNS, ERROR_MESSAGE


def clean(df: DataFrame) -> DataFrame:
    """The rows without an error."""
    return df.filter(F.col(ERROR_COLUMNS).isNull())


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col(ERROR_COLUMNS).isNotNull())


def flag_unlisted(df: DataFrame, column: str, allowed: Iterable[str]) -> DataFrame:
    """Mark rows whose value is not in the allowed list, so that none is lost in silence."""
    listed = F.coalesce(F.col(column).isin(list(allowed)), F.lit(False))
    bad = ~listed & F.col(ERROR_COLUMNS).isNull()
    text = F.concat(F.coalesce(F.col(column), F.lit("(none)")), F.lit(f" is not a listed {column}"))
    return df.withColumns(
        {
            ERROR_MESSAGE: F.when(bad, text).otherwise(F.col(ERROR_MESSAGE)),
            ERROR_COLUMNS: F.when(bad, column).otherwise(F.col(ERROR_COLUMNS)),
        }
    )


def split_by(df: DataFrame, column: str, allowed: Iterable[str]) -> dict[str, DataFrame]:
    """One lazy slice per allowed value."""
    return {value: df.filter(F.col(column) == value) for value in allowed}


def eligible(
    statuses: Iterable[str] | None,
    category: str,
    or_email: bool = True,
    prefix: str = "",
) -> Column:
    """Open disputes of a category, in one of the statuses or of type Email."""
    test = (F.col(prefix + "Status") == "Open") & (F.col(prefix + "Dispute_Category") == category)
    if statuses is None:
        return test
    allowed = F.col(prefix + "Display_Status").isin(list(statuses))
    if or_email:
        allowed = allowed | (F.col(prefix + "Dispute_Type") == "Email")
    return test & allowed


def pending(columns: Iterable[str], mode: str) -> Column:
    """Still waiting: `all` or `any` of the answer columns are null."""
    nulls = [F.col(c).isNull() for c in columns]
    return reduce(lambda a, b: a & b if mode == "all" else a | b, nulls)


def tag_is(value: str, column: str = "TAG") -> Column:
    return F.col(column) == value


def tag_is_not(value: str, column: str = "TAG") -> Column:
    """Null tags are in neither slice."""
    return F.col(column) != value


def positive(column: str) -> Column:
    return F.col(column) > 0
