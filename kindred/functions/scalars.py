"""Small row expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred.config import TEXT_FIELDS

MISSING_TEXT = "Missing"
MISSING_VALUE = 999
_DAY_MICROS = 86_400_000_000


def parse_timestamp(text: Column) -> Column:
    """Null when the text is no timestamp."""
    return F.try_to_timestamp(text.cast("string"))


def age_in_weeks(submitted: Column, as_of: Column) -> Column:
    """Whole weeks from whole elapsed days; days round down, weeks towards zero."""
    elapsed = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(
        submitted.cast("timestamp")
    )
    return (F.floor(elapsed / F.lit(_DAY_MICROS)) / 7).cast("int")


def prefix_before_dash(value: Column) -> Column:
    return F.substring_index(value, "-", 1)


def message(fields: Sequence[str] = TEXT_FIELDS) -> Column:
    """Text fields joined by one space; nulls read ``Missing``."""
    filled = [F.coalesce(F.col(f).cast("string"), F.lit(MISSING_TEXT)) for f in fields]
    return F.concat_ws(" ", *filled)


def message_compat(fields: Sequence[str]) -> Column:
    """The listed columns glued without a separator, id and known duplicate included."""
    filled = [F.coalesce(F.col(f).cast("string"), F.lit(MISSING_TEXT)) for f in fields]
    return F.concat(*filled)


def duplicate_label(related_id: Column, is_duplicate: Column) -> Column:
    return F.when(is_duplicate, F.concat(related_id, F.lit("- duplicate"))).otherwise(
        related_id
    )
