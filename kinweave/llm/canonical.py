"""Freely typed values mapped to the closest entry of a reference list.

The forms of the entries stand in a BK-tree under the Levenshtein distance, a true metric: the triangle inequality prunes
the search and still every form within the radius is found. The list is held in shards of bounded size, one at a time;
each shard gives its own winner and the winners are merged, so a list of any length works. Only different values are mapped,
each once, and joined back to their rows.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.storage import materialize

#: Entries of the list that one tree holds.
SHARD = 20_000

# Typed short forms of the generic words of club names.
SHORT = {
    "atl": "atletico", "ath": "athletic", "bld": "belediye", "bel": "belediye", "c": "club", "depor": "deportivo", "dep": "deportivo", "dyn": "dynamo", "eintr": "eintracht", "et": "etoile",
    "fotb": "fotball", "loko": "lokomotiv", "lok": "lokomotiv", "olymp": "olympique", "ol": "olympique", "r": "real", "rac": "racing", "rvrs": "rovers", "slav": "slavia", "sp": "sporting de",
    "spart": "sparta", "st": "stade", "u": "union", "utd": "united", "wdrs": "wanderers", "wand": "wanderers",
}
# Additions that name no other club or country.
CLUB_NOISE = ("football club", "f c", "s a d", "e v", "1921")
CLUB_ADDED = ("fc", "football", "club")
CLUB_SUFFIXES = ("spor",)
COUNTRY_NOISE = ("team", "nt", "rep of", "rep", "the", "republic of", "republic", "kingdom of")
COUNTRY_ENDINGS = ("ese", "an", "n", "ian")


def fold(text: str) -> str:
    """Lower-case letters and digits without accents, one blank between words."""
    text = text.casefold().replace("ı", "i").replace("ø", "o").replace("æ", "ae").replace("đ", "d").replace("ł", "l")
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return " ".join("".join(c if c.isalnum() else " " for c in text).split())


class Pattern:
    """A text prepared for bit-parallel Levenshtein distances to many others."""

    def __init__(self, text: str):
        self.text, self.n, self.bits = text, len(text), {}
        for i, c in enumerate(text):
            self.bits[c] = self.bits.get(c, 0) | 1 << i

    def distance(self, other: str) -> int:
        if not self.n:
            return len(other)
        full, last = (1 << self.n) - 1, 1 << (self.n - 1)
        up, down, score, get = full, 0, self.n, self.bits.get
        for c in other:
            eq = get(c, 0)
            vertical = eq | down
            horizontal = (((eq & up) + up) ^ up) | eq
            more, less = down | ~(horizontal | up) & full, up & horizontal
            if more & last:
                score += 1
            elif less & last:
                score -= 1
            more = (more << 1 | 1) & full
            up, down = (less << 1 | ~(vertical | more)) & full, more & vertical
        return score


class BKTree:
    def __init__(self):
        self.root: list | None = None

    def add(self, form: str, key: str) -> None:
        if self.root is None:
            self.root = [form, {key}, {}]
            return
        node, p = self.root, Pattern(form)
        while d := p.distance(node[0]):
            if d not in node[2]:
                node[2][d] = [form, {key}, {}]
                return
            node = node[2][d]
        node[1].add(key)

    def within(self, text: str, radius: int) -> Iterator[tuple[int, str, set[str]]]:
        """Every (distance, form, keys) within the radius."""
        p, todo = Pattern(text), [self.root] if self.root else []
        while todo:
            form, keys, children = todo.pop()
            d = p.distance(form)
            if d <= radius:
                yield d, form, keys
            todo.extend(child for k, child in children.items() if d - radius <= k <= d + radius)


def radius(text: str) -> int:
    """Edits allowed: one changed, added or dropped letter or two exchanged ones in a word of some length."""
    return 0 if len(text) < 5 else 1 if len(text) < 7 else 2


@dataclass
class Index:
    """One shard: the forms of its entries, and how a typed value is brought to the same form."""

    entries: list[tuple[str, str]]
    forms: Callable[[str], list[str]]
    reach: Callable[[str], int] = radius
    exact: dict[str, set[str]] = field(default_factory=dict)
    tree: BKTree = field(default_factory=BKTree)

    def __post_init__(self):
        for text, key in self.entries:
            for form in self.forms(text):
                self.exact.setdefault(form, set()).add(key)
        for form, keys in sorted(self.exact.items()):
            for key in sorted(keys):
                self.tree.add(form, key)

    def best(self, typed: list[str]) -> tuple[int, str | None]:
        """(distance, key) of the nearest entry; no key if none is in reach or entries of several keys are as near."""
        for form in typed:
            if keys := self.exact.get(form):
                return 0, min(keys) if len(keys) == 1 else None
        hits: dict[int, set[str]] = {}
        for form in typed:
            for d, _, keys in self.tree.within(form, self.reach(form)):
                hits.setdefault(d, set()).update(keys)
        if not hits:
            return 99, None
        d = min(hits)
        return d, next(iter(hits[d])) if len(hits[d]) == 1 else None


def stem(place: str) -> str:
    """A place without the ending that makes it a club."""
    for suffix in CLUB_SUFFIXES:
        if place.endswith(suffix) and len(place) > len(suffix) + 3:
            return place[: -len(suffix)]
    return place


def club_forms(generic: frozenset[str], lone: frozenset[str], entry: bool) -> Callable[[str], list[str]]:
    """Forms of a club: generic words first, in alphabetical order, then the place. Of an entry whose place is no other's,
    also the place alone. Of a typed value also what is left without additions like FC."""

    def forms(text: str) -> list[str]:
        folded = f" {fold(text)} "
        for noise in CLUB_NOISE if not entry else ():
            folded = folded.replace(f" {noise} ", " ")
        words = folded.split()
        if not entry and len(words) > 2 and words[-1] == "1" and "(1)" in text:
            words = words[:-1]
        if not entry:
            words = " ".join(SHORT.get(w, w) if len(words) > 1 else w for w in words).split()
        first, rest = sorted(w for w in words if w in generic), [w for w in words if w not in generic]
        out = [" ".join(first + rest)] if words else []
        if entry and len(rest) == 1 and stem(rest[0]) in lone:
            out.append(stem(rest[0]))
        if not entry and (bare := [w for w in words if w not in CLUB_ADDED]) and len(bare) < len(words):
            out.append(" ".join(bare))
        if not entry and len(rest) > 1:  # a misspelt generic word may stand on either side
            out.append(" ".join(first + rest[::-1]))
        return out

    return forms


def country_forms(text: str) -> list[str]:
    """Forms of a country: its folded name without additions, words in alphabetical order, the name joined; of an adjective the stem."""
    folded = f" {fold(text)} "
    for noise in COUNTRY_NOISE:
        folded = folded.replace(f" {noise} ", " ")
    words = sorted(folded.split()) or sorted(fold(text).split())
    return [" ".join(words)] if words else []


def typed_country_forms(text: str) -> list[str]:
    out = country_forms(text)
    words = fold(text).split()
    out += [f for f in (" ".join(words[::1]),) if f not in out and len(words) > 1]
    for ending in COUNTRY_ENDINGS:
        if out and out[0].endswith(ending) and len(out[0]) - len(ending) >= 5:
            out.append(out[0][: -len(ending)])
    return out


def _search(shard: Index, typed: Callable[[str], list[str]]) -> Callable[[pd.Series], pd.DataFrame]:
    def look(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shard.best(typed(t)) for t in texts], columns=["d", "k"])

    return look


def nearest(values: DataFrame, entries: DataFrame, value: str, key: str, forms: Callable[[str], list[str]], typed: Callable[[str], list[str]], reach: Callable[[str], int] = radius, size: int = SHARD) -> DataFrame:
    """(value, key, tied) of distinct values(value): the key of the nearest entry, null where none is in reach or, tied, where
    entries of several keys are equally near.

    The list is read in shards of about `size` entries; each goes once against all values, so that neither the driver nor a
    task ever holds more than one tree. Null values and null entries are left out. `reach` says how many edits a form allows.
    """
    rows = entries.select(F.col(value).cast("string").alias("v"), F.col(key).cast("string").alias("k")).where("v is not null and k is not null").distinct()
    n = -(-rows.count() // size) or 1
    parts = []
    for i in range(n):
        shard = Index([(r["v"], r["k"]) for r in rows.where(F.pmod(F.xxhash64("v"), F.lit(n)) == i).sort("v", "k").collect()], forms, reach)
        hit = values.where("value is not null").select("value", F.pandas_udf(_search(shard, typed), "d int, k string")("value").alias("h")).select("value", "h.d", "h.k")
        parts.append(materialize(hit, "nearest") if n > 1 else hit)
    hits = reduce(DataFrame.unionByName, parts)
    if n > 1:
        top = hits.groupBy("value").agg(F.min("d").alias("d"))
        hits = hits.join(top, ["value", "d"]).groupBy("value", "d").agg(F.when((F.count_if(F.col("k").isNull()) == 0) & (F.min("k") == F.max("k")), F.min("k")).alias("k"))
    return hits.select("value", "k", (F.col("k").isNull() & (F.col("d") < 99)).alias("tied"))


def club_rules(clubs: DataFrame) -> tuple[Callable[[str], list[str]], Callable[[str], list[str]]]:
    """How entries and typed values of a list of clubs are brought to the same form. The place of a name is its word that stands
    beside the fewest others (the longest among equals); a word is generic if it is seldom a place. Both are counted over the
    list, in time and memory of its words."""
    names = sorted({fold(r["name"]) for r in clubs.where("name is not null").select("name").distinct().toLocalIterator()})
    beside: dict[str, set[str]] = {}
    times: Counter[str] = Counter()
    for n in names:
        words = set(n.split())
        times.update(words)
        for w in words:
            beside.setdefault(w, set()).update(words - {w})
    as_place = Counter(min(n.split(), key=lambda w: (len(beside[w]), -len(w), w)) for n in names if n)
    generic = frozenset(w for w in beside if 2 * as_place[w] < times[w]) | frozenset(x for s in SHORT.values() for x in s.split())
    stems: Counter[str] = Counter()
    for w in beside:
        if w not in generic:
            stems[stem(w)] += times[w]
    lone = frozenset(w for w, n in stems.items() if n == 1)
    return club_forms(generic, lone, True), club_forms(generic, lone, False)


def country_entries(team_map: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [team_map.select(F.col(c).alias("v"), F.col("team_code").alias("k")) for c in ("nationality_value", "team_name", "team_code")])


#: The typed columns and the list each belongs to.
FIELDS = {"tm_club": "club", "apif_club": "club", "nationality": "country"}


def mapped(pairs: DataFrame, clubs: DataFrame, team_map: DataFrame) -> DataFrame:
    """(tm_id, apif_id, field, value, ref_key, tied): every typed club and nationality that isn't an entry as it stands, with the
    key of its entry or NONE. Null and blank values give no row; repeated rows one."""
    typed = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(kind).alias("kind"), F.col(f).alias("value")) for f, kind in FIELDS.items()])
    rows = pairs.select("tm_id", "apif_id", F.explode(typed).alias("t")).select("tm_id", "apif_id", "t.*").where(F.col("value").rlike(r"\S"))
    exact = clubs.select(F.lit("club").alias("kind"), F.col("name").alias("value")).unionByName(team_map.select(F.lit("country").alias("kind"), F.col("nationality_value").alias("value"))).distinct()
    rows = rows.join(exact, ["kind", "value"], "left_anti")
    values = materialize(rows.select("kind", "value").distinct(), "values")
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, much work: a fixed number isn't coalesced
    of = lambda kind: values.where(F.col("kind") == kind).select("value").repartition(n, "value")
    club_entry, club_typed = club_rules(clubs)
    found = nearest(of("club"), clubs, "name", "club_id", club_entry, club_typed).withColumn("kind", F.lit("club"))
    found = found.unionByName(nearest(of("country"), country_entries(team_map), "v", "k", country_forms, typed_country_forms).withColumn("kind", F.lit("country")))
    keyed = rows.join(materialize(found, "mapped"), ["kind", "value"])
    return keyed.select("tm_id", "apif_id", "field", "value", F.coalesce("k", F.lit("NONE")).alias("ref_key"), "tied").distinct()


def found(pairs: DataFrame, clubs: DataFrame, team_map: DataFrame) -> DataFrame:
    """(tm_id, apif_id, field, ref_key)"""
    return mapped(pairs, clubs, team_map).select("tm_id", "apif_id", "field", "ref_key").distinct()
