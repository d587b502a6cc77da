"""Names, keys and word lists as built-in column expressions; each runs inside whole-stage code generation."""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accent map whose two sides don't line up; kept to reproduce its results.
REF_FROM = "àáâãäåæèéêëìíîïðòóôõöùúûüýÿñçšžőűÀÁÂÃÄÅÆÈÉÊËÌÍÎÏÐÒÓÔÕÖÙÚÛÜÝŸÑÇŠŽŐŰ"
REF_TO = "aaaaaaaeeeeiiiidoooooouuuuyyncszouAAAAAAEEEEIIIIDOOOOOUUUUYYNCSZOU"
CLUB_FROM = "áàâãäéèêëíìîïóòôõöúùûüñçřšžýčůōūāēīöü"
CLUB_TO = "aaaaaeeeeiiiioooooauuuuncrszyculoaieoeu"
# Words that say nothing about which club is meant.
CLUB_STOPWORDS = (
    "football", "club", "fc", "fk", "sc", "sv", "fußball", "futbol", "calcio", "sportiva", "associazione", "società", "sportvereniging", "voetbalvereniging", "koninklijke", "vereniging", "sport",
    "sad", "s.a.d.", "s.a.d", "spa", "s.p.a.", "s.p.a", "de", "do", "da", "das", "del", "der", "die", "des", "du", "le", "la", "los", "las", "les", "el", "al", "e", "the", "and", "of", "for", "und", "für", "von",
    "athletic", "atletik", "athletics", "real", "verein", "sportverein", "association", "limited", "ltd", "plc", "ag", "gmbh", "team", "dubai", "1893", "1907", "1899", "1904", "1905", "1909", "04", "05",
)
# Endings cut off a club's name, in this order, each once.
CLUB_ENDINGS = (" fc", " f.c.", " football club", " s.p.a.", " s.a.", " s.a.s.", " s.c.", " plc", " ltd")
# Short names of clubs and the names they stand for.
CLUB_ALIASES = {
    "man united": "manchester united",
    "man city": "manchester city",
    "spurs": "tottenham",
    "wolves": "wolverhampton",
    "hearts": "heart of midlothian",
    "west ham": "west ham united",
    "newcastle": "newcastle united",
    "nottm forest": "nottingham forest",
    "real sociedad": "real sociedad de futbol",
    "atletico madrid": "atletico de madrid",
    "bayern": "bayern munich",
    "inter": "internazionale",
    "ac milan": "associazione calcio milan",
    "psg": "paris saint-germain",
    "barca": "fc barcelona",
}
# Positions by broad category.
POSITIONS = {
    "fwd": ("centre-forward", "right winger", "left winger", "second striker", "attack", "forward", "striker", "fwd"),
    "mid": ("central midfield", "defensive midfield", "attacking midfield", "right midfield", "left midfield", "midfield", "mid"),
    "def": ("centre-back", "left-back", "right-back", "defender", "def"),
    "gk": ("goalkeeper", "gk"),
}
# Spellings of countries and the one that is kept.
COUNTRIES = {
    "Curacao": "Curaçao",
    "Cote d'Ivoire": "Côte d'Ivoire",
    "Cote d\u2019Ivoire": "Côte d'Ivoire",
    "Ivory Coast": "Côte d'Ivoire",
    "USA": "United States",
    "United States of America": "United States",
}
# Letters whose transliteration isn't their decomposition.
TRANSLITERATED = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ı": "i", "ð": "d", "Ð": "D"}
TRANSLITERATED_LONG = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th"}


@lru_cache(maxsize=1)
def decompositions() -> tuple[str, str]:
    """Accented letters and their base letters by the Unicode character database; combining marks map to nothing."""
    a, b = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFKD", chr(code))
        if len(base) > 1 and base[0].isascii() and all(unicodedata.combining(c) for c in base[1:]):
            a.append(chr(code))
            b.append(base[0])
    return "".join(a) + "".join(map(chr, range(0x300, 0x370))), "".join(b)


def strip_accents(c: Column) -> Column:
    """Base letters only; letters that don't decompose (ø, ß) stay."""
    return F.translate(c, *decompositions())


def strip_accents_ref(c: Column) -> Column:
    """The misaligned map: from ù on each letter gets its neighbour's base letter (ñ becomes y, ç becomes n)."""
    return F.translate(c, REF_FROM, REF_TO)


def transliterate(c: Column) -> Column:
    """ASCII letters: base letters, and ß as ss, ø as o and the like."""
    c = F.translate(c, "".join(TRANSLITERATED), "".join(TRANSLITERATED.values()))
    for a, b in TRANSLITERATED_LONG.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    return strip_accents(c)


def matcher_name(c: Column) -> Column:
    """Transliterated, lower case, hyphens as blanks, apostrophes dropped."""
    return F.replace(F.replace(F.trim(F.lower(transliterate(c))), F.lit("-"), F.lit(" ")), F.lit("'"))


def canonical_name(c: Column) -> Column:
    """Base letters, lower case, nothing but letters, digits, blanks and hyphens; letters without a base are dropped."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(strip_accents(c)), r"[^a-z0-9\s-]", ""), r"\s+", " "))


def combined_name(c: Column) -> Column:
    """As canonical_name, without the restriction to a set of characters."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(c)), r"\s+", " "))


def slug(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(strip_accents(c)), "[^a-z0-9]+", "-"), F.lit("-"))


def last_token(c: Column) -> Column:
    """The last blank-separated token; a trailing blank makes it empty."""
    return F.element_at(F.split(c, " "), -1)


def search_name(c: Column, least: int = 4) -> Column:
    """ASCII letters, digits and blanks, for a search of at least some length; null if shorter."""
    t = F.trim(F.regexp_replace(transliterate(c), "[^A-Za-z0-9 ]", ""))
    return F.when(F.length(t) >= least, t)


def is_abbreviated(c: Column) -> Column:
    """An initial, a full stop and a name."""
    return c.rlike(r"^.{1,2}\.\s")


def club_words(c: Column) -> Column:
    """The words of a club's name that tell it from others, by the misaligned map and the stop words."""
    t = F.translate(F.lower(c), CLUB_FROM, CLUB_TO)
    t = F.replace(F.replace(F.replace(t, F.lit("-"), F.lit(" ")), F.lit("."), F.lit(" ")), F.lit("'"))
    words = F.split(F.trim(F.regexp_replace(t, r"\s+", " ")), " ")
    return F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(*CLUB_STOPWORDS))


def normal_club(c: Column, aliases: dict[str, str] = CLUB_ALIASES) -> Column:
    """Lower case without the usual endings, known short names replaced; null for nothing."""
    t = whole = F.trim(F.lower(c))
    for ending in CLUB_ENDINGS:
        t = F.regexp_replace(t, rf"\Q{ending}\E$", "")  # each step names its input once, so the expression grows by a step only
    ends = reduce(lambda x, y: x | y, [F.endswith(whole, F.lit(e)) for e in CLUB_ENDINGS])
    return F.nullif(recode(F.when(ends, F.trim(t)).otherwise(whole), aliases), F.lit(""))


def normal_position(c: Column) -> Column:
    """The broad category of a position; a position that is in none stays."""
    return recode(F.trim(F.lower(c)), {p: broad for broad, listed in POSITIONS.items() for p in listed})


def comparable(field: Column, value: Column) -> Column:
    """A value as sources are compared on its field: dates by their day, numbers as whole numbers, clubs and positions normalized,
    lists never, other text trimmed in lower case; null for nothing."""
    day = F.substring(F.trim(value), 1, 10)
    number = F.replace(value, F.lit(",")).try_cast("double").cast("bigint").cast("string")
    return (
        F.when(field == "date_of_birth", F.when(F.length(day) >= 8, day))
        .when(field.isin("market_value_eur", "height_cm", "international_caps", "international_goals", "jersey_number"), number)
        .when(field.isin("career_trajectory", "major_trophies"), F.lit(None).cast("string"))
        .when(field == "current_club", normal_club(value))
        .when(field == "position", normal_position(value))
        .otherwise(F.nullif(F.trim(F.lower(value)), F.lit("")))
    )


def recode(c: Column, mapping: dict[str, str]) -> Column:
    """A value by a small map, itself if not in it."""
    if not mapping:
        return c
    return F.coalesce(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[c], c)


def word_count(c: Column) -> Column:
    return F.size(F.split(F.trim(c), r"\s+"))


def longer_name(a: Column, b: Column) -> Column:
    """The name of more words, the first among equals."""
    return F.when(a.isNull(), b).when(b.isNull(), a).when(word_count(b) > word_count(a), b).otherwise(a)


def append_reason(old: Column, new: Column) -> Column:
    """Reasons joined by "; ", missing ones skipped."""
    return F.concat_ws("; ", old, new)


def remove_reason(c: Column, reason: str) -> Column:
    """One reason taken out of the list; null if none is left."""
    return F.nullif(F.array_join(F.array_remove(F.split(c, "; "), reason), "; "), F.lit(""))


def foot(c: Column) -> Column:
    """Left, Right or Both in any case; else null."""
    t = F.initcap(F.lower(F.trim(c)))
    return F.when(t.isin("Left", "Right", "Both"), t)


def sql_literal(c: Column) -> Column:
    """Text as an SQL literal, NULL for missing values."""
    t = c.cast("string")
    return F.when(t.isNull() | F.lower(F.trim(t)).isin("", "nan", "inf", "-inf"), "NULL").otherwise(F.concat(F.lit("'"), F.replace(t, F.lit("'"), F.lit("''")), F.lit("'")))


def sql_array(c: Column) -> Column:
    """An array of text as an SQL array literal."""
    items = F.transform(F.filter(c, lambda x: x.isNotNull()), lambda x: F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("''")), F.lit("'")))
    return F.when(c.isNull() | (F.size(F.filter(c, lambda x: x.isNotNull())) == 0), "'{}'").otherwise(F.concat(F.lit("ARRAY["), F.array_join(items, ", "), F.lit("]")))


def script_escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def render_moves(moves: Column) -> Column:
    """An array of (date, origin, target, fee) as one line of text."""
    return F.array_join(F.transform(moves, lambda m: F.concat(m["date"], F.lit(" — "), m["origin"], F.lit(" → "), m["target"], F.when(m["fee"] != "", F.concat(F.lit(" ("), m["fee"], F.lit(")"))).otherwise(F.lit("")))), " | ")
