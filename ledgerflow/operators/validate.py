"""Row-level validation with an error channel.

A rule is a predicate with a column name and a message. Any number of rules is
folded into one expression, so validating costs no pass of its own; the first
rule that fails decides the error of a row, and an error that a row already
carries is kept.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import as_moment, to_day, to_money
from ledgerflow.functions.dates import AsOf
from ledgerflow.operators.conform import ERROR_COLUMNS, ERROR_MESSAGE
from ledgerflow.operators.filters import clean, rejected
from ledgerflow.operators.joins import Keys, key_map, lookup, mark_existing


@dataclass(frozen=True)
class Rule:
    """`failed` true means the row gets this error; null counts as passed."""

    columns: str | Column
    message: str | Column
    failed: Column

    def when(self, guard: Column) -> Rule:
        return Rule(self.columns, self.message, guard & self.failed)


def validate(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    rules = list(rules)
    if not rules:
        return df
    ours = [
        F.when(
            r.failed,
            F.struct(
                (r.columns if isinstance(r.columns, Column) else F.lit(r.columns)).alias("c"),
                (r.message if isinstance(r.message, Column) else F.lit(r.message)).alias("m"),
            ),
        )
        for r in rules
    ]
    kept = F.when(
        F.col(ERROR_COLUMNS).isNotNull(),
        F.struct(F.col(ERROR_COLUMNS).alias("c"), F.col(ERROR_MESSAGE).alias("m")),
    )
    found = df.withColumn("_error", F.coalesce(kept, *ours))
    return found.withColumns(
        {ERROR_COLUMNS: F.col("_error.c"), ERROR_MESSAGE: F.col("_error.m")}
    ).drop("_error")


def is_numeric(column: str) -> Rule:
    c = F.col(column)
    return Rule(column, f"{column} is not numeric", c.isNotNull() & to_money(c).isNull())


def is_positive(column: str) -> Rule:
    return Rule(column, f"{column} is <= 0", to_money(column) <= 0)


def is_date(column: str) -> Rule:
    c = F.col(column)
    return Rule(column, f"{column} is not a date", c.isNotNull() & to_day(c).isNull())


def not_future(column: str, as_of: AsOf) -> Rule:
    """A bill date may lie in the coming month at the latest."""
    limit = F.last_day(F.add_months(as_moment(as_of).cast("date"), 1))
    return Rule(column, f"{column} is in the future", limit < F.last_day(to_day(column)))


def is_eom(column: str) -> Rule:
    day = to_day(column)
    return Rule(column, f"{column} is not the end of the month", day != F.last_day(day))


def not_past(column: str, as_of: AsOf) -> Rule:
    """The day starts before `as_of`, so the day of `as_of` itself fails as well."""
    begins = to_day(column).cast("timestamp_ntz")
    return Rule(column, f"{column} is in the past", begins < as_moment(as_of))


def amount_rules(column: str) -> list[Rule]:
    return [is_numeric(column), is_positive(column)]


def date_rules(column: str, as_of: AsOf) -> list[Rule]:
    return [is_date(column), is_eom(column), not_past(column, as_of)]


def bill_date_rules(column: str, as_of: AsOf) -> list[Rule]:
    return [is_date(column), not_future(column, as_of)]


def max_value(column: str, limit: int) -> Rule:
    return Rule(column, f"DN max day cap is {limit} day(s)", to_money(column) > limit)


def known_employee(marker: str = "_has_employee") -> Rule:
    return Rule("Comp_Serial", "Comp_Serial does not exist", ~F.col(marker))


def must_exist(
    df: DataFrame, ref: DataFrame, keys: Keys, columns: str, message: str | Column
) -> DataFrame:
    """Flag rows whose key is not in the reference."""
    marked = mark_existing(df, ref, keys, "_known")
    return validate(marked, [Rule(columns, message, ~F.col("_known"))]).drop("_known")


def must_not_exist(
    df: DataFrame, ref: DataFrame, keys: Keys, columns: str, message: str | Column
) -> DataFrame:
    """Flag rows whose key is already in the reference."""
    marked = mark_existing(df, ref, keys, "_known")
    return validate(marked, [Rule(columns, message, F.col("_known"))]).drop("_known")


def must_exist_with(
    df: DataFrame,
    ref: DataFrame,
    key: str,
    wrong: Column,
    columns: str,
    missing_message: str,
    wrong_message: str,
) -> DataFrame:
    """Flag rows whose key is missing, or whose reference row meets `wrong`.

    The reference has one row per key; a null `wrong` counts as right.
    """
    judged = ref.select(F.col(key), F.coalesce(wrong, F.lit(False)).alias("_bad"))
    marked = lookup(df, judged, [key], {"_wrong": "_bad"}, "_known")
    rules = [
        Rule(columns, missing_message, ~F.col("_known")),
        Rule(columns, wrong_message, F.col("_wrong")),
    ]
    return validate(marked, rules).drop("_known", "_wrong")


def must_derive(
    df: DataFrame, derived: DataFrame, keys: Keys, columns: str, message: str
) -> DataFrame:
    """Flag rows for whose key nothing was derived; an empty derivation flags them all."""
    return must_exist(df, derived, keys, columns, message)


def flag_repeats(
    df: DataFrame, keys: Keys, row_key: str, columns: str, message: str
) -> DataFrame:
    """Keep the first clean row per key; flag the later ones.

    The first row is found by a partial aggregate, so a key that fills a third
    of the rows travels as one row per task, and the join back can be split.
    """
    names = list(key_map(keys))
    first = clean(df).groupBy(*names).agg(F.min(row_key).alias("_min"))
    marked = lookup(df, first, names, {"_first": "_min"}, own_shuffle=True)
    return validate(
        marked, [Rule(columns, message, F.col(row_key) != F.col("_first"))]
    ).drop("_first")


def propagate_error(df: DataFrame, keys: Keys, row_key: str | Column) -> DataFrame:
    """An error on one row of a group fails its clean siblings with the same text.

    With several failing rows the one with the lowest row key is passed on. Only
    failing rows are aggregated, map-side first; no group is gathered.
    """
    names = list(key_map(keys))
    failed = (
        rejected(df)
        .groupBy(*names)
        .agg(F.min_by(F.struct(ERROR_COLUMNS, ERROR_MESSAGE), row_key).alias("_e"))
    )
    marked = lookup(df, failed, names, {"_sibling": "_e"}, own_shuffle=True)
    own = F.col(ERROR_COLUMNS).isNotNull()
    return marked.withColumns(
        {
            ERROR_MESSAGE: F.when(own, F.col(ERROR_MESSAGE)).otherwise(
                F.col(f"_sibling.{ERROR_MESSAGE}")
            ),
            ERROR_COLUMNS: F.when(own, F.col(ERROR_COLUMNS)).otherwise(
                F.col(f"_sibling.{ERROR_COLUMNS}")
            ),
        }
    ).drop("_sibling")


def ticket_status(
    df: DataFrame,
    core: DataFrame,
    status: DataFrame,
    column: str = "Ticket",
) -> DataFrame:
    """Decorate a ticket number with its status text; flag numbers that are not known.

    The number is compared by value, so `$1,200` and `1200` are the same ticket.
    """
    number = df.withColumn("_ticket", to_money(column).cast("long"))
    known = core.select(F.col("Ticket_ID").cast("long").alias("_id"), "Ticket_Status_ID")
    found = lookup(number, known, {"_ticket": "_id"}, {"_status_id": "Ticket_Status_ID"})
    named = lookup(
        found, status, {"_status_id": "Ticket_Status_ID"}, {"_status": "Status"}
    )
    usable = F.col(ERROR_COLUMNS).isNull() & F.col("_status_id").isNotNull()
    text = F.concat_ws("", F.col("_ticket").cast("string"), F.lit(" - "), F.col("_status"))
    rule = Rule(column, f"{column} is not a known ticket", F.col("_status_id").isNull())
    return (
        validate(named.withColumn("_usable", usable), [rule])
        .withColumn(column, F.when(F.col("_usable"), text).otherwise(F.col(column)))
        .drop("_ticket", "_status_id", "_status", "_usable")
    )


def split_results(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows)."""
    return clean(df), rejected(df)


def outcome_summary(df: DataFrame, *by: str) -> DataFrame:
    """Clean and rejected row counts per group."""
    return df.groupBy(*by).agg(
        F.count_if(F.col(ERROR_COLUMNS).isNull()).alias("N_Ok"),
        F.count_if(F.col(ERROR_COLUMNS).isNotNull()).alias("N_Error"),
    )
