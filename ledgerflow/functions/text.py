"""Text and number helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points that count as white space at either end of a text.
WHITE_SPACE = "".join(
    map(
        chr,
        (
            *range(0x09, 0x0E),
            *range(0x1C, 0x21),
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ),
    )
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove every kind of white space at both ends, not only blanks."""
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def is_blank(c: Column | str) -> Column:
    """True for null and for text of nothing but blanks."""
    return F.coalesce(F.rtrim(_col(c)) == "", F.lit(True))


def first_non_blank(*cols: Column | str) -> Column:
    """The first of the columns that holds more than blanks, untouched."""
    return F.coalesce(*[F.when(~is_blank(c), _col(c)) for c in cols])


def concat_skip_null(*cols: Column) -> Column:
    """Concatenate, reading null as empty text."""
    return F.concat_ws("", *cols)


def audit_comment(action: str | None, comment: Column | str | None) -> Column:
    """`<action> - <comment>`, or whichever of the two there is."""
    if comment is not None and action:
        return concat_skip_null(F.lit(f"{action} - "), _col(comment))
    if comment is not None:
        return _col(comment).cast("string")
    return F.lit(action).cast("string")


def seed_claim_no(batch: Column, record_type: Column | str, seed: Column | str) -> Column:
    """`<batch>_<first letter of the record type><seed>`; null if any part is null."""
    return F.concat(batch, F.lit("_"), F.left(_col(record_type), F.lit(1)), _col(seed).cast("string"))


def hash_claim_no(batch: Column, *row_key: Column | str) -> Column:
    """`<batch>_X<number>`; the number is the first 60 bits of the md5 of the row key's text.

    Claims differ as long as keys do, so the key should be one that is never given
    twice, such as a DSB_ID.
    """
    digits = F.conv(F.left(F.md5(name_key(*row_key)), F.lit(15)), 16, 10)
    return F.concat(batch, F.lit("_X"), digits)


def name_key(*cols: Column | str) -> Column:
    """Key columns joined to one readable text."""
    return F.concat_ws("_", *[_col(c).cast("string") for c in cols])


def split_csv(c: Column | str) -> Column:
    """Comma list to array; a blank after a comma is not part of the next item."""
    return F.split(F.replace(_col(c), F.lit(", "), F.lit(",")), ",")


def to_money(c: Column | str) -> Column:
    """Text to decimal(19,4), null if it is no number; `$` and thousands commas are allowed."""
    plain = F.translate(strip(_col(c).cast("string")), "$,", "")
    return plain.try_cast("decimal(19,4)")
