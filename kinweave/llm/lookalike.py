"""Texts that look the same but differ in their characters, brought to one form.

Three steps: encodings (full-width forms, ligatures, composed accents, invisible characters, kinds of white space) are
folded character by character; then every token that mixes scripts is repaired towards its dominant script, letter by
look-alike letter, where the result is a word of the corpus; what is left (whole words written in look-alikes, words the
corpus doesn't know) is compared by the shape of its letters. Texts whose characters fold one to one never leave the JVM;
only those with ligatures, combining marks or repaired tokens go to Python.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.storage import materialize

# Letters of other scripts and the Latin letter each looks like.
CYRILLIC = {
    "А": "A", "В": "B", "С": "C", "Е": "E", "Ԍ": "G", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ԛ": "Q", "Ѕ": "S", "Т": "T", "Ѵ": "V", "Ԝ": "W", "Х": "X", "У": "Y",
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
}
GREEK = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    "α": "a", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j",
}
ARMENIAN = {"Օ": "O", "օ": "o", "Տ": "S", "Ս": "U", "ս": "u", "հ": "h", "ո": "n", "ց": "g", "զ": "q"}


def _with_accents(table: dict[str, str]) -> dict[str, str]:
    """The table and every accented letter of it that is one character, by the Unicode character database."""
    every = {chr(code): unicodedata.normalize("NFD", chr(code)) for code in range(0x370, 0x590)}
    return table | {c: unicodedata.normalize("NFC", table[d[0]] + d[1:]) for c, d in every.items() if len(d) > 1 and d[0] in table}


CYRILLIC, GREEK = _with_accents(CYRILLIC), _with_accents(GREEK)
SHAPES = CYRILLIC | GREEK | ARMENIAN | {"ɑ": "a", "ɡ": "g", "ɩ": "i", "‐": "-", "‑": "-"}

_FOREIGN = r"[\p{IsCyrillic}\p{IsGreek}\p{IsArmenian}]"
#: Characters that can't be seen: removed, so that they part no token.
INVISIBLE = r"[\p{Cf}͏ᅟᅠ឴឵᠋-᠏ㅤ︀-️ﾠ]"
#: A Latin letter beside one of another script.
_BESIDE = rf"\p{{IsLatin}}\p{{M}}*{_FOREIGN}|{_FOREIGN}\p{{M}}*\p{{IsLatin}}"
#: A run of letters in which a Latin letter stands beside one of another script.
MIXED = rf"[\p{{L}}\p{{M}}]*(?:\p{{IsLatin}}\p{{M}}*{_FOREIGN}|{_FOREIGN}\p{{M}}*\p{{IsLatin}})[\p{{L}}\p{{M}}]*"


@lru_cache(maxsize=1)
def encodings() -> dict[int, str]:
    """What every character with another encoding of the same look becomes; built from the Unicode character database."""
    table: dict[int, str] = {}
    hidden = [0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10)]
    for code in (*range(0x30000), *range(0xE0000, 0xE0200)):  # no other character has such a form
        if 0xD800 <= code < 0xE000:
            continue
        c = chr(code)
        kind = unicodedata.category(c)
        if c.isspace() or kind in ("Zs", "Zl", "Zp"):
            table[code] = " "
        elif kind in ("Cf", "Cc"):
            table[code] = ""
        else:
            tag = unicodedata.decomposition(c).partition(">")[0]
            if tag in ("<wide", "<narrow") or tag == "<compat" and kind[0] in "LN":
                table[code] = unicodedata.normalize("NFKC", c)
    table.update((code, "") for code in hidden)
    return table


def clean(text: str) -> str:
    """One encoding of the text: the same characters for the same look within a script, one space between words."""
    if text.isascii() and text.isprintable():
        return " ".join(text.split())
    return unicodedata.normalize("NFC", " ".join(text.translate(encodings()).split()))


@lru_cache(maxsize=1)
def _one_to_one() -> tuple[str, str, str]:
    """(from, to, odd): characters and what they fold to, one to one, those that go at the end of `from`; and the characters that
    fold to several."""
    pairs, gone, odd = [], [], []
    table = encodings()
    for code in range(0x10000):
        if 0xD800 <= code < 0xE000:
            continue
        c = chr(code)
        to = unicodedata.normalize("NFC", table.get(code, c))
        if to == c or unicodedata.combining(c):
            continue
        if not to:
            gone.append(c)
        elif len(to) == 1:
            pairs.append((c, to))
        else:
            odd.append(c)
    wide = [c for c, to in SHAPES.items() if len(to) > 1]
    return "".join(a for a, _ in pairs) + "".join(gone), "".join(b for _, b in pairs), "".join(odd + wide)


def holds_any(text: Column, odd: str) -> Column:
    """Whether a text holds one of some characters, or one that depends on its neighbours (marks, syllable parts) or is beyond the
    basic plane. Told by what a translation leaves: a pattern of so many characters would be tried one after another."""
    return (F.length(F.translate(text, odd, "")) < F.length(text)) | text.rlike(r"[\p{M}\u1100-\u11ff\x{10000}-\x{10FFFF}]")


def cleaned(text: Column) -> Column:
    """clean() of texts without odd characters, in built-in functions."""
    a, b, _ = _one_to_one()
    return F.trim(F.regexp_replace(F.translate(text, a, b), " +", " "))


def shaped(text: Column) -> Column:
    """shape() of cleaned texts without odd characters, in built-in functions."""
    table = {a: b for a, b in SHAPES.items() if len(b) == 1}
    return F.translate(text, "".join(table), "".join(table.values()))


@lru_cache(maxsize=1)
def _shape_table() -> dict[int, str]:
    return {ord(k): v for k, v in SHAPES.items()}


def shape(text: str) -> str:
    """The text with every letter of another script written as the Latin letter it looks like: equal for equal looks."""
    return text if text.isascii() else unicodedata.normalize("NFC", text.translate(_shape_table()))


@lru_cache(maxsize=1)
def _caseless_table() -> dict[int, str]:
    """Lower-case letters to one letter for all that are linked by look or by case: H and its Cyrillic look-alike are the
    same, so are their lower-case forms, which don't look alike. Without this, case and disguise couldn't both be ignored."""
    root: dict[str, str] = {}

    def find(c: str) -> str:
        while root.setdefault(c, c) != c:
            c = root[c]
        return c

    for a, b in SHAPES.items():
        x, y = find(a.casefold()), find(b.casefold())
        if x != y:
            x, y = sorted((x, y), key=lambda c: (len(c), c))
            root[y] = x
    return {ord(c): find(c) for c in root if len(c) == 1 and find(c) != c} | {ord("ı"): "i", 0x307: ""}


def caseless(text: str) -> str:
    """clean() without regard to case and to look-alikes."""
    return unicodedata.normalize("NFC", clean(text).casefold()).translate(_caseless_table())


@lru_cache(maxsize=1)
def _caseless_one_to_one() -> tuple[str, str, str]:
    """As _one_to_one(), of caseless()."""
    pairs, gone, odd = [], [], []
    for code in range(0x10000):
        c = chr(code)
        if 0xD800 <= code < 0xE000 or unicodedata.combining(c):
            continue
        to = " " if c.isspace() else caseless(f"{c}.")[:-1]  # beside a full stop, as a blank alone would be trimmed
        if len(to) > 1:
            odd.append(c)
        elif not to:
            gone.append(c)
        elif to != c:
            pairs.append((c, to))
    return "".join(a for a, _ in pairs) + "".join(gone), "".join(b for _, b in pairs), "".join(odd)


def easy(text: Column) -> Column:
    """Whether caselessly() folds a text as caseless() does, but for the number of blanks."""
    return ~holds_any(text, _caseless_one_to_one()[2])


def caselessly(text: Column) -> Column:
    """caseless() in built-in functions, for easy() texts."""
    a, b, _ = _caseless_one_to_one()
    return F.translate(text, a, b)


def script(c: str) -> str | None:
    code = ord(c)
    if code < 0x250 or 0x1E00 <= code < 0x1F00:
        return "latin" if c.isalpha() else None
    if 0x370 <= code < 0x400:
        return "greek"
    if 0x400 <= code < 0x530:
        return "cyrillic"
    if 0x530 <= code < 0x590:
        return "armenian"
    return "latin" if 0x250 <= code < 0x2B0 else None


@lru_cache(maxsize=1)
def _towards() -> dict[str, dict[str, str]]:
    back = {name: {v: k for k, v in table.items()} for name, table in (("cyrillic", CYRILLIC), ("greek", GREEK), ("armenian", ARMENIAN))}
    return {"latin": SHAPES} | back


def repaired(token: str) -> str | None:
    """The token with its other letters replaced by look-alikes of its dominant script (most letters; Latin among equals);
    None if one of them has none."""
    scripts = [script(c) for c in token]
    counts = {s: scripts.count(s) for s in scripts if s}
    if len(counts) < 2:
        return None
    most = max(counts, key=lambda s: (counts[s], s == "latin", s))
    out = []
    for c, s in zip(token, scripts, strict=True):
        if s in (None, most):
            out.append(c)
            continue
        c = c if s == "latin" else SHAPES.get(c)
        c = c if most == "latin" or c is None else _towards()[most].get(c)
        if c is None:
            return None
        out.append(c)
    return unicodedata.normalize("NFC", "".join(out))


def _candidate(tokens: pd.Series) -> pd.Series:
    return tokens.map(lambda t: repaired(clean(t)))


def _repair(text: str, repairs) -> str:
    text = clean(text)
    known = {clean(p["token"]): p["word"] for p in repairs} if repairs is not None else None
    if not known:
        return text
    out, at = [], 0
    for start, end in letter_runs(text):
        word = known.get(text[start:end])
        if word is not None:
            out += (text[at:start], word)
            at = end
    return "".join([*out, text[at:]])


def _forms(texts: pd.Series, repairs: pd.Series) -> pd.DataFrame:
    rows = [(None, None) if t is None else (c := _repair(t, r), shape(c)) for t, r in zip(texts, repairs, strict=True)]
    return pd.DataFrame(rows, columns=["text", "look"])


def letter_runs(text: str):
    """(start, end) of the runs of letters and marks."""
    start = None
    for i, c in enumerate(text):
        if c.isalpha() or unicodedata.category(c)[0] == "M":
            start = i if start is None else start
        elif start is not None:
            yield start, i
            start = None
    if start is not None:
        yield start, len(text)


def forms(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, look): each text in one consistent form, and the form in which it is compared with others.

    Encodings are folded in every text. Of tokens that mix scripts only those change whose repaired form occurs as a word of
    one script somewhere in the corpus; the vocabulary is that of all documents. Null texts stay null, blank ones become "".
    The key should be unique. Candidates and their repairs are joined, never collected; only documents that hold a mixed
    token are joined with repairs, and the vocabulary is reduced to its words before it is shuffled.
    """
    plain = cleaned(F.col(text))
    tokens = docs.where(F.col(text).rlike(_FOREIGN)).where(plain.rlike(_BESIDE)).select(key, F.explode(F.array_distinct(F.regexp_extract_all(plain, F.lit(MIXED), F.lit(0)))).alias("token"))
    mixed = materialize(tokens, "mixed")
    options = mixed.select("token").distinct().select("token", F.pandas_udf(_candidate, "string")("token").alias("word")).where("word is not null")
    options = materialize(options, "options")
    words = docs.select(F.explode(F.split(F.col(text), r"[^\p{L}\p{M}]+")).alias("word")).distinct()
    known = words.join(options.select("word").distinct(), "word", "left_semi")
    repairs = mixed.join(options.join(known, "word"), "token").groupBy(key).agg(F.collect_set(F.struct("token", "word")).alias("_repairs"))
    rows = docs.select(key, text, holds_any(F.col(text), _one_to_one()[2]).alias("_odd"))
    joined = rows.join(repairs, key, "left").select(key, text, "_repairs", (F.col("_odd") | F.col("_repairs").isNotNull()).alias("_hard"))
    made = joined.select(key, F.when(~F.col("_hard"), plain).alias("_plain"), F.pandas_udf(_forms, "text string, look string")(F.when(F.col("_hard"), F.col(text)), F.col("_repairs")).alias("_f"))
    return made.select(key, F.coalesce("_f.text", "_plain").alias(text), F.coalesce("_f.look", shaped(F.col("_plain"))).alias("look"))


def canonical(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) of forms()."""
    return forms(docs, key, text).select(key, text)


#: Members of a group of equal-looking texts that one task pairs with others.
BLOCK = 2_000


def _looks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, _look, _raw): hashes of how each text looks and of what it is."""
    raw = docs.select(key, F.md5(F.col(text)).alias("_raw")).where("_raw is not null")
    return forms(docs, key, text).select(key, F.md5("look").alias("_look")).join(raw, key)


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id, n_strings): every text that looks like another one, its class named by the least key, and how many
    different strings the class holds. One row a document, however many look alike."""
    rows = materialize(_looks(docs, key, text), "looks")
    groups = rows.groupBy("_look").agg(F.min(key).alias("class_id"), F.count_distinct("_raw").alias("n_strings"), F.count("*").alias("_n")).where("_n > 1")
    return rows.join(groups, "_look").select(key, "class_id", "n_strings")


def pairs(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(key_a, key_b), a < b: documents that look the same but aren't the same string.

    Null texts are in no pair; blank ones look the same. Large groups are split into blocks that are paired with copies of
    the group, so that no task holds a whole group; groups of one string give nothing and are dropped before.
    """
    rows = materialize(_looks(docs, key, text), "looks")
    groups = rows.groupBy("_look").agg(F.count("*").alias("_n"), F.min("_raw").alias("_x"), F.max("_raw").alias("_y")).where("_x <> _y").select("_look", F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    members = rows.join(groups, "_look")
    a = members.select(F.col(key).alias(f"{key}_a"), F.col("_raw").alias("_raw_a"), "_look", F.pmod(F.xxhash64(key), F.col("_blocks")).cast("int").alias("_block"))
    b = members.select(F.col(key).alias(f"{key}_b"), F.col("_raw").alias("_raw_b"), "_look", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"))
    return a.join(b, ["_look", "_block"]).where(F.col(f"{key}_a") < F.col(f"{key}_b")).where("_raw_a <> _raw_b").select(f"{key}_a", f"{key}_b").distinct()
