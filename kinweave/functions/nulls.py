"""Missing values in their many spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as missing, by the step that reads.
SENTINELS: dict[str, tuple[str, ...]] = {
    "ingest": (),
    "merge": ("", "None", "null", "N/A", "Unknown"),
    "verified_old": ("", "None", "null"),
    "verified_new": ("", "null", "none", "n/a", "unknown"),
    "literal": ("", "nan", "inf", "-inf"),
}


def null_if_sentinel(c: Column, preset: str = "merge", fold: bool = False) -> Column:
    """Null where trimmed text is a sentinel of the preset; NaN is text "nan" only for the literal preset."""
    t = F.trim(c.cast("string"))
    values = SENTINELS[preset]
    if not values:
        return c
    t = F.lower(t) if fold or preset in ("verified_new", "literal") else t
    return F.when(~t.isin(*values), c)


def zero_as_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0).cast("bigint"))


def present(c: Column) -> Column:
    """Neither null nor blank nor the word null."""
    t = F.trim(c.cast("string"))
    return t.isNotNull() & ~t.isin("", "null")
