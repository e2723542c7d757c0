"""Column helpers where the wanted semantics differ from a single Spark built-in."""

from ledgerflow.functions.dates import (
    as_moment,
    batch_date,
    batch_label,
    month_end,
    previous_month_end,
    same_day,
    to_day,
)
from ledgerflow.functions.text import (
    audit_comment,
    concat_skip_null,
    first_non_blank,
    hash_claim_no,
    is_blank,
    name_key,
    seed_claim_no,
    split_csv,
    strip,
    to_money,
)

__all__ = [
    "as_moment",
    "audit_comment",
    "batch_date",
    "batch_label",
    "concat_skip_null",
    "first_non_blank",
    "hash_claim_no",
    "is_blank",
    "month_end",
    "name_key",
    "previous_month_end",
    "same_day",
    "seed_claim_no",
    "split_csv",
    "strip",
    "to_day",
    "to_money",
]
