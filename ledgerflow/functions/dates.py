"""Date helpers. `as_of` stands wherever a plan needs the current moment."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms that are accepted as a date.
ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
ISO_MOMENT = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"
US_DATE = r"^\d{1,2}/\d{1,2}/\d{4}$"

AsOf = Column | dt.date | dt.datetime | str


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_moment(as_of: AsOf) -> Column:
    """The given moment as a zone-free timestamp column."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def to_day(c: Column | str) -> Column:
    """Text in one of the accepted forms to date, else null. Bare years are no dates."""
    text = _col(c).cast("string")
    return (
        F.when(text.rlike(ISO_DATE), text.try_cast("date"))
        .when(text.rlike(ISO_MOMENT), text.try_cast("timestamp_ntz").cast("date"))
        .when(text.rlike(US_DATE), F.try_to_date(text, "M/d/yyyy"))
    )


def month_end(c: Column | str) -> Column:
    return F.last_day(_col(c))


def previous_month_end(c: Column | str) -> Column:
    return F.last_day(F.add_months(_col(c), -1))


def same_day(moment: Column | str, as_of: AsOf) -> Column:
    return _col(moment).cast("date") == as_moment(as_of).cast("date")


def batch_date(as_of: AsOf, day_of_week: int = 4, week_offset: int = -1) -> Column:
    """Day `day_of_week` (Monday is 0) of the week `week_offset` weeks from `as_of`."""
    monday = F.trunc(as_moment(as_of).cast("date"), "week")
    return F.date_add(monday, day_of_week + 7 * week_offset)


def batch_label(as_of: AsOf, day_of_week: int = 4, week_offset: int = -1) -> Column:
    return F.date_format(batch_date(as_of, day_of_week, week_offset), "yyyyMMdd")
