"""Dates and amounts from text, with the variants that different steps use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month names.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def age_at(born: Column, on: str = "2026-06-11") -> Column:
    """Full years on a day, by the calendar (a 29 February counts from 1 March); null for a missing date."""
    day = F.lit(on).cast("date")
    before = (F.month(day) < F.month(born)) | ((F.month(day) == F.month(born)) & (F.dayofmonth(day) < F.dayofmonth(born)))
    return F.year(day) - F.year(born) - before.cast("int")


def iso_day(c: Column) -> Column:
    return F.substring(c.cast("string"), 1, 10)


def contract_day(c: Column) -> Column:
    """ISO dates as they are, a year as its 30 June, text that names a month and a year as that month's 28th; else null. Of
    several months the earliest in the year counts, of several years the first."""
    t = F.trim(c)
    low, year = F.lower(t), F.nullif(F.regexp_extract(t, r"(\d{4})", 1), F.lit(""))
    named = F.coalesce(*[F.when(F.contains(low, F.lit(m)), F.concat(year, F.lit(f"-{n:02}-28"))) for n, m in enumerate(MONTHS, 1)])
    return F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t).when(t.rlike(r"^\d{4}$"), F.concat(t, F.lit("-06-30"))).otherwise(named)


#: Text that is a number and nothing else.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _number(t: Column) -> Column:
    t = F.trim(t)
    return F.when(t.rlike(_NUMBER), t).cast("double")


def whole(c: Column) -> Column:
    """A number as whole euros or cm: cut off, null for 0 or less."""
    return F.when(c.cast("bigint") > 0, c.cast("bigint"))


def money(c: Column, variant: str = "merge") -> Column:
    """Whole euros of text like "€30M", "500K", "1 billion"; fractions of a euro are cut off, other text is null.

    Variants: merge and push scale by a million where the text says million or ends in m, by a billion where it says billion or
    ends in b, by a thousand where it has a k; literal scales by an m or b anywhere and reads no k. Numbers go to whole().
    """
    t = F.trim(F.regexp_replace(F.lower(c.cast("string")), "[€$,]", ""))
    if variant == "literal":
        million, billion, thousand = F.contains(t, F.lit("m")), F.contains(t, F.lit("b")), F.lit(False)
    else:
        million, billion, thousand = F.contains(t, F.lit("million")) | F.endswith(t, F.lit("m")), F.contains(t, F.lit("billion")) | F.endswith(t, F.lit("b")), F.contains(t, F.lit("k"))
    of = lambda unit, times: (_number(F.regexp_replace(t, unit, "")) * times).cast("bigint")
    return F.when(million, of("million|m", 1e6)).when(billion, of("billion|b", 1e9)).when(thousand, of("k", 1e3)).otherwise(_number(t).cast("bigint"))


def height(c: Column) -> Column:
    """cm of text that begins with metres ("1.81 m", "1,81m") or with whole cm ("181 cm"), or is a number between 100 and 250,
    both excluded, cut off. The digits after the point of metres are read as cm ("1.8 m" is 108), as ever. Numbers go to
    whole()."""
    t = F.trim(c.cast("string"))
    metres, cm = r"^(\d{1,6})[.,](\d{1,6})\s*m", r"^(\d{1,6})\s*cm"
    part = lambda pattern, n: F.nullif(F.regexp_extract(t, pattern, n), F.lit("")).cast("int")
    bare = _number(t)
    return F.when(t.rlike(metres), part(metres, 1) * 100 + part(metres, 2)).when(t.rlike(cm), part(cm, 1)).when((F.floor(bare) > 100) & (F.floor(bare) < 250), bare.cast("int"))


def fee(c: Column) -> Column:
    """An amount as €M or €K text, half to even; empty for nothing."""
    millions = F.replace(F.format_number(c / 1e6, 1), F.lit(","))
    thousands = F.replace(F.format_number(c / 1e3, 0), F.lit(","))
    return F.when(c >= 1e6, F.concat(F.lit("€"), millions, F.lit("M"))).when(c >= 1e3, F.concat(F.lit("€"), thousands, F.lit("K"))).when(c > 0, F.concat(F.lit("€"), c.cast("bigint").cast("string"))).otherwise("")
