"""Quantities written in different units, brought to one unit per field.

A multi-pattern automaton finds every unit alias in a text in one pass. The longest alias wins; the field a text
belongs to ("height", "money", ...) settles what an alias means there ("m" is a metre in a height and a million in a
value). The parser gives (number, unit) terms only: factors stay in a table and are joined, so a new rate needs no new
code. Texts are parsed once per distinct value, whatever the number of rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from decimal import Decimal, InvalidOperation
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.storage import materialize
from pyspark.sql import types as T

# Unit aliases by field. Units of a height are lengths; units of money are scales and currencies.
ALIASES: dict[str, dict[str, tuple[str, ...]]] = {
    "height": {
        "mm": ("mm", "millimetre", "millimetres", "millimeter", "millimeters"),
        "cm": ("cm", "cms", "centimetre", "centimetres", "centimeter", "centimeters", "centímetros", "centimetros"),
        "m": ("m", "mt", "mts", "metre", "metres", "meter", "meters", "metro", "metros"),
        "ft": ("ft", "ft.", "feet", "foot", "'", "pies"),
        "in": ("in", "in.", "inch", "inches", "\"", "''", "pulgada", "pulgadas", "zoll"),
    },
    "money": {
        "EUR": ("€", "eur", "euro", "euros"),
        "GBP": ("£", "gbp", "pound", "pounds", "libras"),
        "USD": ("$", "usd", "us$", "dollar", "dollars", "dólares", "dolares"),
        "CHF": ("chf", "sfr", "francs"),
        "TRY": ("₺", "try", "lira", "liras"),
        "SEK": ("sek", "kr", "kronor"),
        "k": ("k", "th", "th.", "thousand", "thousands", "tsd", "tsd.", "mil", "miles", "x1000", "x 1000", "x1,000", "'000", "000s"),
        "M": ("m", "mn", "mln", "mio", "mio.", "mill", "mill.", "million", "millions", "millionen", "millón", "millones", "x1000000"),
        "B": ("b", "bn", "billion", "billions", "mrd", "mrd."),
        "k+EUR": ("k€", "keur", "teur", "t€"),
        "M+EUR": ("m€", "meur"),
        "k+GBP": ("k£", "kgbp"),
        "M+GBP": ("m£", "mgbp"),
        "k+USD": ("k$", "kusd"),
        "M+USD": ("m$", "musd"),
    },
}
# Factors to the common unit (cm, one unit of the currency).
FACTORS = {"height": {"mm": "0.1", "cm": "1", "m": "100", "ft": "30.48", "in": "2.54"}, "money": {"": "1", "k": "1000", "M": "1000000", "B": "1000000000"}}
# Words of a note that say which field it is about.
SUBJECTS = {"height": ("height", "ht", "altura", "talla", "estatura", "größe", "grösse"), "money": ("mv", "market value", "value", "valor", "marktwert", "wert")}

TERM = T.ArrayType(T.StructType([T.StructField("number", T.StringType()), T.StructField("unit", T.StringType()), T.StructField("currency", T.StringType())]))
_NUMBER = re.compile(r"\d+(?:[.,'    ]\d{3})+(?:[.,]\d+)?(?!\d)|\d+(?:[.,]\d+)?")
_HEIGHT_NUMBER = re.compile(r"\d+(?:[.,]\d+)?")


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    meaning: dict[str, dict[str, str]] = {}
    for field, units in ALIASES.items():
        for unit, aliases in units.items():
            for alias in aliases:
                meaning.setdefault(alias, {})[field] = unit
    found = ahocorasick.Automaton()
    for alias, by_field in meaning.items():
        found.add_word(alias, (alias, by_field))
    found.make_automaton()
    return found


def fold(text: str) -> str:
    """Lower case, one form of each quote mark."""
    for a, b in (("″", '"'), ("”", '"'), ("“", '"'), ("′", "'"), ("’", "'"), ("´", "'"), ("`", "'"), (" ", " "), (" ", " "), (" ", " ")):
        text = text.replace(a, b)
    return text.lower()


def _units(text: str, field: str) -> list[tuple[int, int, str]]:
    """(start, end, unit) of the longest aliases that mean something in this field and stand alone as a word."""
    spans = []
    for end, (alias, by_field) in _automaton().iter(text):
        start, after = end - len(alias) + 1, end + 1
        if field not in by_field:
            continue
        if alias[0].isalpha() and start and text[start - 1].isalpha() or alias[-1].isalpha() and after < len(text) and text[after].isalpha():
            continue
        spans.append((start, after, by_field[field]))
    kept, until = [], -1
    for start, after, unit in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= until:
            kept.append((start, after, unit))
            until = after
    return kept


def _decimal(raw: str, scale: str) -> Decimal | None:
    """A number with separators of any convention. One separator before exactly three digits groups thousands, unless a
    scale of a million or more follows: then it is a decimal mark."""
    raw = re.sub(r"[' ]", "", raw)
    marks = [c for c in raw if c in ".,"]
    if len(set(marks)) == 2:
        last = max(raw.rfind("."), raw.rfind(","))
        raw = re.sub(r"[.,]", "", raw[:last]) + "." + raw[last + 1 :]
    elif len(marks) > 1 or marks and len(re.split(r"[.,]", raw)[1]) == 3 and scale not in ("M", "B") and not raw.startswith("0"):
        raw = re.sub(r"[.,]", "", raw)
    else:
        raw = raw.replace(",", ".")
    try:
        return Decimal(raw)
    except InvalidOperation:
        return None


def parse_height(text: str) -> list[tuple[str, str, str]]:
    """Terms of a height: 1m83 is a metre and 83 cm, 6ft 4 six feet and four inches; a bare number is read by its size."""
    text = fold(text)
    units, terms = _units(text, "height"), []
    for m in _HEIGHT_NUMBER.finditer(text):
        at = m.end() + (m.end() < len(text) and text[m.end()] == " ")
        unit = next((u for s, _, u in units if s in (m.end(), at)), None)
        number = Decimal(m.group().replace(",", "."))
        if unit is None and terms:
            unit = {"m": "cm", "ft": "in"}.get(terms[-1][1])
        if unit is None and not terms:
            unit = implied_length(number)
        if unit:
            terms.append((str(number), unit, ""))
    return terms


def implied_length(number: Decimal) -> str | None:
    """The unit of a human height given without one."""
    for low, high, unit in ((1, 3, "m"), (3, 9, "ft"), (50, 95, "in"), (100, 260, "cm"), (1000, 2600, "mm")):
        if low <= number < high:
            return unit
    return None


def parse_money(text: str) -> list[tuple[str, str, str]]:
    """One term: the first number, the scale next to it and the currency named anywhere (none: euros)."""
    text = fold(text)
    m = _NUMBER.search(text)
    if not m:
        return []
    scale = currency = ""
    for start, _, unit in _units(text, "money"):
        a, _, b = unit.partition("+")
        if a in ("k", "M", "B"):
            if not scale and start >= m.end():
                scale = a
            currency = currency or b
        else:
            currency = currency or a
    number = _decimal(m.group(), scale)
    return [] if number is None else [(str(number), scale, currency or "EUR")]


def parse_note(text: str, field: str) -> list[tuple[str, str, str]]:
    """What a note says about the unit of a field: at most one term, its number empty."""
    for part in fold(text).split(";"):
        about = {f for f, words in SUBJECTS.items() if any(re.search(rf"(?<!\w){re.escape(w)}(?!\w)", part) for w in words)}
        if field not in about:
            continue
        scale = currency = ""
        for start, _, unit in _units(part, field):
            if field == "height":
                if unit != "ft" and not (unit == "m" and part[start : start + 1] != "m"):
                    scale = scale or unit
                continue
            a, _, b = unit.partition("+")
            if a in ("k", "M", "B"):
                scale, currency = scale or a, currency or b
            else:
                currency = currency or a
        if scale or currency not in ("", "EUR"):  # "value in EUR confirmed" names no other unit; a later part may
            return [("", scale, currency or ("EUR" if field == "money" else ""))]
    return []


def _terms(field: str, note: bool):
    def parse(texts: pd.Series) -> pd.Series:
        one = (lambda x: parse_note(x, field)) if note else parse_height if field == "height" else parse_money
        return texts.map(lambda x: [] if x is None else [dict(zip(("number", "unit", "currency"), t, strict=True)) for t in one(x)])

    return F.pandas_udf(parse, TERM)


def factor_table(spark: SparkSession, field: str, rates: DataFrame | None = None) -> DataFrame:
    """(unit, currency, factor): lengths, or every scale in every currency of rates(currency, eur_per_unit)."""
    base = spark.createDataFrame([(u, f) for u, f in FACTORS[field].items()], "unit string, factor string").withColumn("factor", F.col("factor").cast("decimal(18,6)"))
    if field == "height":
        return base.withColumn("currency", F.lit(""))
    per = rates.groupBy(F.upper(F.trim("currency")).alias("currency")).agg(F.max(F.col("eur_per_unit").cast("decimal(12,6)")).alias("rate"))
    return base.crossJoin(per).select("unit", "currency", (F.col("factor") * F.col("rate")).cast("decimal(24,6)").alias("factor"))  # 4 scales x the currencies


def _small(factors: DataFrame, most: int = 10_000) -> DataFrame:
    """The factors, to be broadcast if they are few: nearly all values are in one unit, which a shuffle would put in one task.
    There are as many as scales times currencies; a longer table is joined as Spark sees fit."""
    return F.broadcast(factors) if factors.count() <= most else factors


def convert_texts(df: DataFrame, keys: Iterable[str], column: str, field: str, rates: DataFrame | None = None) -> DataFrame:
    """(keys..., amount): the quantity each text of `column` states, in whole common units (half up).

    Null, blank and unreadable texts and quantities in a currency without a rate give no row; repeated rows give one.
    Other columns are ignored. An empty table gives an empty result.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(column).alias("_text")).where("trim(_text) <> ''").distinct()
    texts = rows.select("_text").distinct().select("_text", F.posexplode(_terms(field, False)("_text")).alias("_i", "_t"))
    factors = factor_table(df.sparkSession, field, rates)
    known = (
        texts.select("_text", F.expr("try_cast(_t.number as decimal(24,6))").alias("_n"), F.col("_t.unit").alias("unit"), F.col("_t.currency").alias("currency"))
        .join(_small(factors), ["unit", "currency"], "left")
        .groupBy("_text")
        .agg(F.sum(F.col("_n") * F.col("factor")).alias("_sum"), F.count_if(F.col("factor").isNull()).alias("_unknown"))
        .where("_unknown = 0 and _sum > 0")
        .select("_text", _whole(F.col("_sum")).alias("amount"))
    )
    return rows.join(known, "_text").select(*keys, "amount")


def convert_numbers(df: DataFrame, keys: Iterable[str], column: str, note: str, field: str, rates: DataFrame | None = None) -> DataFrame:
    """(keys..., amount) for the values above 0 that aren't in the common unit: of a height by the row's note or its size, of money by the row's note only.

    Nulls and values of 0 or less give no row; a null note says nothing; repeated rows give one.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(column).cast("decimal(24,6)").alias("_n"), F.col(note).alias("_note")).where("_n > 0")
    # written, as filters on what a note says would otherwise be pushed to every row and parse each note again
    notes = materialize(rows.select("_note").where("_note is not null").distinct(), "notes").select("_note", _terms(field, True)("_note").alias("_t"))
    notes = notes.where("size(_t) > 0").select("_note", F.col("_t")[0]["unit"].alias("_unit"), F.col("_t")[0]["currency"].alias("_currency"))
    if field == "height":
        n = F.col("_n")
        size = F.when(n < 3, "m").when(n < 9, "ft").when((n >= 50) & (n < 95), "in").when((n >= 100) & (n < 260), "cm").when((n >= 1000) & (n < 2600), "mm")
        odd = rows.where(~((F.col("_n") >= 100) & (F.col("_n") < 260)))  # the values that can be heights in cm are in cm
        said = odd.join(notes, "_note", "left").select(*keys, "_n", F.coalesce(size, F.col("_unit")).alias("unit"), F.lit("").alias("currency"))
    else:
        said = rows.join(notes, "_note").select(*keys, "_n", F.col("_unit").alias("unit"), F.col("_currency").alias("currency"))
    factors = factor_table(df.sparkSession, field, rates)
    return said.where("unit <> 'cm'").join(_small(factors), ["unit", "currency"]).select(*keys, _whole(F.col("_n") * F.col("factor")).alias("amount")).distinct()


def _whole(x: Column) -> Column:
    return F.round(x, 0).cast("long")


def found(bio: DataFrame, staging: DataFrame, rates: DataFrame) -> DataFrame:
    """(table_name, record_key, field, amount): all quantities of the free-text and the staged table in whole cm and euros."""
    parts = [convert_texts(bio, ["slug"], c, f, rates).select(F.lit("player_bio").alias("table_name"), F.col("slug").alias("record_key"), F.lit(c).alias("field"), "amount") for c, f in (("height", "height"), ("marketvalue", "money"))]
    parts += [
        convert_numbers(staging, ["profile_id"], c, "curation_reason", f, rates).select(F.lit("profile_players_staging").alias("table_name"), F.col("profile_id").alias("record_key"), F.lit(c).alias("field"), "amount")
        for c, f in (("height_cm", "height"), ("market_value_eur", "money"))
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("record_key is not null").distinct()
