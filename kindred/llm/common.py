"""What several operators share: text expressions and joins of a known shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_of(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def words_in(column: str) -> Column:
    """Number of words, 0 for a null text."""
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text modulo ``divisor``; -1 where the id is null."""
    return F.coalesce(
        F.crc32(F.col(column).cast("string").cast("binary")) % divisor, F.lit(-1)
    )


def rows_of(frame: DataFrame) -> int:
    return frame.agg(F.count(F.lit(1))).first()[0]


def free_name(wanted: str, taken) -> str:
    """``wanted`` with as many ``_`` as make it differ from all names in ``taken``; case does not count."""
    taken = {c.lower() for c in taken}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def kept_names(keep, results) -> list[str]:
    """Names under which columns are handed on beside those of a result: changed where they clash."""
    out = []
    for c in keep:
        others = [k for k in keep if k != c]
        out.append(c if c.lower() not in {r.lower() for r in results} else free_name(c, [*results, *others, *out]))
    return out
