"""Records of two sources without a common key, matched by a cascade of deterministic rules.

A rule is an exact join on a combination of attributes. It needs no join operator: both sources' keys go through one
aggregation that keeps the smallest and largest id of each source, and a key that one record of each source holds is a
match. The holders of other keys that both sources have are told apart by birth date, position, height and initials: equal
ones are collapsed before they meet, so that a key shared by a third of all rows doesn't cost its square.
Each pass of the cascade takes weaker combinations, over the records that no earlier pass resolved; matches of the weaker
passes must not contradict each other in birth date, first name or position. Each rule's confidence is its precision
against labelled pairs, smoothed.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.storage import Written, materialize

#: Beta prior of a rule's precision: as if so many labelled pairs had been right and wrong.
PRIOR = (4.0, 1.0)
#: Bits of a key that hold the rule's number.
RULE_BITS = 6
#: Keys of several holders, 8 bytes each, that are broadcast; more are joined by a shuffle.
FEW_KEYS = 500_000
#: Letters of a word that counts as a family name beside the longest word of a name.
LONG = 8


@lru_cache(maxsize=1)
def _letters() -> tuple[str, str]:
    """Accented Latin letters and their plain ones, from the Unicode character database; punctuation becomes a blank,
    combining marks go."""
    a, b = [], []
    for code in [*range(0xDF, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFKD", chr(code))[0]
        if base != chr(code) and base.isascii() and base.isalpha():
            a.append(chr(code))
            b.append(base)
    a += ["ø", "ı", "đ", "ł", "æ", "œ", "ß", *".,-_/()\t\n\xa0'’´`"]
    b += ["o", "i", "d", "l", "a", "o", "s", *" " * 14]
    return "".join(a) + "".join(map(chr, range(0x300, 0x370))), "".join(b)


_UMLAUTS = ("ae", "oe", "ue")


def _unaccented(c: Column) -> Column:
    return F.translate(F.lower(c), *_letters())


def _short_umlauts(c: Column) -> Column:
    return reduce(lambda x, pair: F.replace(x, F.lit(pair), F.lit(pair[0])), _UMLAUTS, c)


def plain(c: Column) -> Column:
    """Lower-case letters without accents; the two-letter spellings of an umlaut become one letter."""
    return _short_umlauts(_unaccented(c))


def _ordered(c: Column) -> Column:
    """A name without accents, the given name first where a comma tells."""
    return _unaccented(F.when(F.contains(c, F.lit(",")), F.concat_ws(" ", F.substring_index(c, ",", -1), F.substring_index(c, ",", 1))).otherwise(c))


def _tokens(c: Column) -> Column:
    """The words of an ordered name. A word of three letters keeps them: Noé is no initial."""
    umlaut = reduce(lambda x, y: x | y, [F.contains(c, F.lit(pair)) for pair in _UMLAUTS])
    words = F.split(c, " ")
    folded = F.when(umlaut, F.transform(words, lambda t: F.when(F.length(t) > 3, _short_umlauts(t)).otherwise(t))).otherwise(words)
    return F.array_remove(folded, "")


def _names(tokens: Column, fallback: Column | None = None) -> Column:
    """(family name, initial, given name) readings of a name: its longest word and every other long one but the first can be the family name."""
    longest = F.array_max(F.transform(tokens, lambda t: F.length(t)))
    families = F.filter(tokens, lambda t, i: ((F.length(t) >= LONG) & (i > 0)) | ((F.length(t) == longest) & (F.length(t) >= 3)))

    def parts(s: Column) -> Column:
        given = F.try_element_at(F.filter(tokens, lambda t: t != s), F.lit(1))
        return F.struct(s.alias("s"), (F.coalesce(given, fallback) if fallback is not None else given).alias("given"))

    # the given name is made once and read three times
    return F.transform(F.transform(families, parts), lambda x: F.struct(x["s"].alias("s"), F.substring(x["given"], 1, 1).alias("i"), F.when(F.length(x["given"]) >= 3, x["given"]).alias("g")))


def _only_name(tokens: Column, fallback: Column | None = None) -> Column:
    """(family name, given name) of one or two words of which one alone can be the family name, else null: most names, read
    without going through their words one by one."""
    one, two = F.try_element_at(tokens, F.lit(1)), F.try_element_at(tokens, F.lit(2))
    first = (F.length(one) >= F.length(two)) & (F.length(one) >= 3)
    last = (F.length(two) >= LONG) | ((F.length(two) >= F.length(one)) & (F.length(two) >= 3))
    read = lambda s, given: F.struct(s.alias("s"), given.alias("given"))
    alone = F.when((F.size(tokens) == 1) & (F.length(one) >= 3), read(one, F.lit(None).cast("string") if fallback is None else fallback))
    return alone.when((F.size(tokens) == 2) & first & ~last, read(one, two)).when((F.size(tokens) == 2) & last & ~first, read(two, one))


_NO_NAMES = "array<struct<s:string,i:string,g:string>>"


def signatures(players: DataFrame) -> DataFrame:
    """(v, names, short, initials, born, pos, height, city, nation, club): what the rules compare, one row for each input row.

    v is the number of the id, negative for the second source; names are readings (s, i, g) of the name and the short name,
    without readings that say less than another. Rows whose id is null or of another form give none. Nulls stay null and
    make no key.
    """
    number = F.expr(r"try_cast(regexp_extract(id, '^\\s*(?:apif_)?([1-9][0-9]{0,17})\\s*$', 1) as bigint)")
    value = lambda c: F.replace(plain(F.col(c)), F.lit(" "), F.lit(""))
    # texts are folded in a projection of their own: each is read several times
    read = players.select("id", "name", "name_short", "date_of_birth", "position", "height_cm", "city_of_birth", "nationality", "current_club_name")
    t = _once(read, v=F.when(F.contains(F.lower("id"), F.lit("apif")), -number).otherwise(number)).select(
        "v", _ordered(F.col("name")).alias("a"), _ordered(F.col("name_short")).alias("b"),
        F.col("date_of_birth").alias("born"), F.lower(F.substring(F.trim("position"), 1, 1)).alias("pos"), F.col("height_cm").alias("height"),
        *[value(c).alias(n) for c, n in (("city_of_birth", "city"), ("nationality", "nation"), ("current_club_name", "club"))],
    ).where("v is not null")
    t = t.withColumns({"a": _tokens(F.col("a")), "b": _tokens(F.col("b"))} | {n: F.when(F.col(n) != "", F.xxhash64(n)) for n in ("city", "nation", "club")})
    given, second = F.try_element_at(F.col("a"), F.lit(1)), F.try_element_at(F.col("a"), F.lit(2))
    none = F.array().cast(_NO_NAMES)
    # one reading of each name, x and y, says all of most rows; the rest goes through its words
    t = t.withColumns({"x": _only_name(F.col("a")), "y": _only_name(F.col("b"), given)})
    for c in ("x", "y"):
        g = F.col(f"{c}.given")
        t = t.withColumn(c, F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}.s").alias("s"), F.substring(g, 1, 1).alias("i"), F.when(F.length(g) >= 3, g).alias("g"))))
    x, y = F.col("x"), F.col("y")
    alone = x.isNotNull() & (F.col("b").isNull() | (F.size("b") == 0))
    both, same_i = x.isNotNull() & y.isNotNull(), F.col("x.i").eqNullSafe(F.col("y.i"))
    more = F.array_distinct(F.concat(F.coalesce(_names(F.col("a")), none), F.coalesce(_names(F.col("b"), given), none)))
    t = t.withColumn("n", F.when(~(alone | both), more))
    names = (
        F.when(alone, F.array(x)).when(both & (F.col("x.s") != F.col("y.s")), F.array(x, y))
        .when(both & F.col("x.g").isNotNull() & F.col("y.g").isNull(), F.array(x)).when(both & F.col("x.g").isNull() & F.col("y.g").isNotNull(), F.array(y))
        .when(both & same_i & F.col("x.g").eqNullSafe(F.col("y.g")), F.array(x)).when(both, F.array(x, y))
        .otherwise(F.expr("filter(n, x -> x.g is not null or not exists(n, y -> y.s = x.s and y.g is not null))"))
    )
    initials = F.when(alone | (both & same_i), F.array("x.i")).when(both, F.array("x.i", "y.i")).otherwise(F.expr("array_distinct(transform(n, x -> x.i))"))
    # "Given S. Second": a given name and the initial of the first family name
    short = F.when((F.length(given) >= 3) & second.isNotNull(), F.concat_ws(" ", given, F.substring(second, 1, 1)))
    return t.select("v", names.alias("names"), short.alias("short"), initials.alias("initials"), "born", "pos", "height", "city", "nation", "club")


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are made once a row: filters on them aren't pushed below, where each would make them again."""
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_once")
    return df.select("*", made).select(*df.columns, *[F.col(f"_once.{n}").alias(n) for n in columns])


def _head(s: Column) -> Column:
    return F.when(F.length(s) >= 7, F.substring(s, 1, 4))


def _tail(s: Column) -> Column:
    """With the head, two parts of a word of which one edit leaves one whole."""
    return F.when(F.length(s) >= 7, F.substring(s, -5, 5))


def _loose(born: Column) -> Column:
    """A date with day and month in either order."""
    return F.year(born) * 10000 + F.least(F.month(born), F.dayofmonth(born)) * 100 + F.greatest(F.month(born), F.dayofmonth(born))


#: The rules of each pass by the attributes that must agree, strongest first; a rule's number is its place in the cascade.
#: s: family name, g: given name, i: initial, head, tail: parts of the family name, short: given name and the next initial.
PASSES: list[list[tuple[str, ...]]] = [
    [("s", "g", "born"), ("s", "i", "born")],
    [("head", "i", "born", "pos"), ("tail", "i", "born", "pos"), ("s", "i", "loose", "pos"), ("s", "g", "year", "pos"), ("s", "g", "day", "pos"), ("s", "i", "year", "pos", "height"), ("short", "born", "pos")],
    [
        ("s", "g", "pos", "city"), ("s", "g", "pos", "club"), ("s", "g", "pos", "height"), ("s", "i", "pos", "city"), ("s", "i", "pos", "club"), ("s", "i", "year", "pos"), ("s", "g", "pos"), ("s", "born", "pos"),
        ("head", "g", "year", "pos"), ("tail", "g", "year", "pos"), ("s", "i", "pos", "height"), ("short", "year", "pos", "nation"),
    ],
    [
        ("head", "g", "born"), ("tail", "g", "born"), ("s", "g", "loose"), ("s", "g", "year", "month"), ("s", "i", "year", "pos", "city"), ("s", "i", "day", "pos"), ("s", "g", "pos", "height", "nation"),
        ("s", "i", "pos", "city", "height"), ("s", "i", "year", "pos", "nation"), ("s", "born", "pos", "height"), ("s", "born", "pos", "city"), ("head", "i", "loose", "pos"), ("tail", "i", "loose", "pos"),
        ("head", "g", "year", "pos", "nation"), ("tail", "g", "year", "pos", "nation"), ("s", "g", "pos", "nation"), ("head", "g", "pos", "city", "height"), ("s", "i", "pos", "height", "nation"),
        ("born", "pos", "city", "height"), ("born", "pos", "club", "height"),
    ],
]

#: Attributes made only to be looked up, with each pass: where one source alone holds a combination, the rules of later
#: passes that ask for more than it need no keys of it.
PROBES: list[list[tuple[str, ...]]] = [[], [("s", "i", "pos")], [], []]
#: What agrees, and is known, wherever an attribute does.
IMPLIED = {"g": ("i",), "born": ("loose", "year", "month", "day"), "loose": ("year",), "day": ("month",)}

#: The rule whose matches may differ in the given name if one is a nickname of the other.
NICKNAMED = ("s", "born", "pos")


def implies(rule: tuple[str, ...], base: tuple[str, ...]) -> bool:
    """Whether records that agree by a rule also agree by a base, which has none but known values."""
    return set(base) <= {*rule, *(i for p in rule for i in IMPLIED.get(p, ()))}


def keys(signed: DataFrame, rules: dict[int, tuple[str, ...]], bases: dict[int, int] | None = None) -> DataFrame:
    """(v, key): the keys that each record makes by rules of these numbers; where a rule has bases, the bits of its number,
    only for records in whose column met they are all set."""
    own = [c for c in ("pos", "height", "city", "nation", "club", "short") if any(c in r for r in rules.values())] + ["met"] * any((bases or {}).get(n) for n in rules)
    read = signed.select("v", "born", *own, F.explode_outer("names").alias("n")).select("v", "born", *own, "n.s", "n.i", "n.g")
    return reading_keys(read, "v", rules, bases or {})


def reading_keys(read: DataFrame, record: str, rules: dict[int, tuple[str, ...]], bases: dict[int, int]) -> DataFrame:
    """(record, key) of readings (record, s, i, g, born, ...): one key for each rule all of whose parts are known. The low bits of
    a key are the rule's number; the rest is a hash, which the rows of one rule share by what they agree in."""
    born, wanted = F.col("born"), {p for r in rules.values() for p in r}
    parts = {"head": _head(F.col("s")), "tail": _tail(F.col("s")), "loose": _loose(born), "year": F.year(born), "month": F.month(born), "day": F.month(born) * 100 + F.dayofmonth(born)}
    read = read.select("*", *[c.alias(n) for n, c in parts.items() if n in wanted])  # what rules share is made once
    may = lambda n: [F.col("met").bitwiseAND(F.lit(bases[n]).cast("long")) == F.lit(bases[n]).cast("long")] if bases.get(n) else []
    made = [F.when(reduce(lambda x, y: x & y, [*may(n), *[F.col(p).isNotNull() for p in r]]), F.shiftleft(F.xxhash64(*r), RULE_BITS).bitwiseOR(F.lit(n).cast("long"))) for n, r in rules.items()]
    return read.select(record, F.explode(F.array(*made)).alias("key")).where("key is not null")


def rule_of(key: Column) -> Column:
    return key.bitwiseAND(F.lit((1 << RULE_BITS) - 1).cast("long")).cast("int")


def nicknames(candidates: DataFrame, least: int = 3, share: float = 0.5) -> DataFrame:
    """(gx, gy): given names of which one stands for the other, learned from candidates (t, a, gx, gy) that agree in all but the
    given name. Relatives of one birth date bring any two names together, each pair seldom; a nickname comes with its own
    name over and over. Counted over all candidates: at least `least` pairs, and that share of all pairs of the rarer name."""
    n = candidates.where("gx <> gy").groupBy("gx", "gy").agg(F.count_distinct("t").alias("n"))
    tx, ty = n.groupBy("gx").agg(F.sum("n").alias("nx")), n.groupBy("gy").agg(F.sum("n").alias("ny"))
    return n.join(tx, "gx").join(ty, "gy").where((F.col("n") >= least) & (F.col("n") >= share * F.least("nx", "ny"))).select("gx", "gy")


def agreeing(x: str, y: str, initials: bool = True) -> Column:
    """Whether two signatures can be of one person: birth dates equal, or one unknown, or one a slip of the other (day and
    month exchanged, a day or a year off, the first of the month or of January for an unknown day); positions equal or one
    unknown; heights within 3 cm; initials of the given names that meet, or unknown ones."""
    b1, b2 = F.col(f"{x}.born"), F.col(f"{y}.born")
    same_year = F.year(b1) == F.year(b2)
    slip = (
        (b1 == b2) | (same_year & (F.month(b1) == F.dayofmonth(b2)) & (F.month(b2) == F.dayofmonth(b1))) | (F.abs(F.datediff(b1, b2)) <= 1)
        | ((F.abs(F.year(b1) - F.year(b2)) == 1) & (F.month(b1) == F.month(b2)) & (F.dayofmonth(b1) == F.dayofmonth(b2)))
        | (same_year & (((F.month(b1) == 1) & (F.dayofmonth(b1) == 1)) | ((F.month(b2) == 1) & (F.dayofmonth(b2) == 1))))
        | (same_year & (F.month(b1) == F.month(b2)) & ((F.dayofmonth(b1) == 1) | (F.dayofmonth(b2) == 1)))
    )
    pos = F.col(f"{x}.pos") == F.col(f"{y}.pos")
    height = F.abs(F.col(f"{x}.height") - F.col(f"{y}.height")) <= 3
    rest = F.coalesce(slip, F.lit(True)) & F.coalesce(pos, F.lit(True)) & F.coalesce(height, F.lit(True))
    return rest & same_initials(x, y) if initials else rest


def same_initials(x: str, y: str) -> Column:
    return F.coalesce(F.arrays_overlap(f"{x}.initials", f"{y}.initials"), F.lit(True))  # null where only an unknown one could meet


def slip_codes(born: Column, left: bool) -> Column:
    """Numbers of which two birth dates, one of each side, share at least one if agreeing() lets them be of one person."""
    year, month, day, at = F.year(born), F.month(born), F.dayofmonth(born), F.unix_date(born)
    start, months = day == 1, year * 12 + month
    new_year = start & (month == 1)
    code = lambda kind, n: F.lit(kind * 10_000_000).cast("long") + n
    any_left, any_right = code(6, F.lit(0)), code(7, F.lit(0))  # an unknown date of the left, of the right side meets every one
    if left:
        swapped = F.when(day <= 12, F.unix_date(F.make_date(year, day, month)))
        made = [at, at - 1, at + 1, F.unix_date(F.add_months(born, -12)), F.unix_date(F.add_months(born, 12)), swapped, code(2, year), F.when(new_year, code(3, year)), code(4, months), F.when(start, code(5, months)), any_right]
    else:
        made = [at, F.when(new_year, code(2, year)), code(3, year), F.when(start, code(4, months)), code(5, months), any_left]
    known = F.array_distinct(F.filter(F.array(*[m.cast("long") for m in made]), lambda c: c.isNotNull()))
    return F.when(born.isNull(), F.array(any_left, any_right)).otherwise(known)


def only_agreeing(members: DataFrame) -> DataFrame:
    """(key, t, a): of the holders of each key in members(key, v, s), those that are each other's only agreeing one.

    Holders are first collapsed to what agreeing() reads, and these meet by date, so that a key costs its different
    signatures, never the square of its rows.
    """
    m = members.withColumn("p", F.to_json("s"))
    kinds = m.groupBy("key", F.col("v") > 0, "p", "s").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    t_side, a_side = m.where("v > 0"), m.where("v < 0")
    x = kinds.where("hi > 0").select("key", F.col("p").alias("px"), F.col("s").alias("x"), F.col("lo").alias("xlo"), F.col("hi").alias("xhi"), F.explode(slip_codes(F.col("s.born"), True)).alias("code"))
    y = kinds.where("hi < 0").select("key", F.col("p").alias("py"), F.col("s").alias("y"), F.col("lo").alias("ylo"), F.col("hi").alias("yhi"), F.explode(slip_codes(F.col("s.born"), False)).alias("code"))
    met = x.join(y, ["key", "code"]).where(agreeing("x", "y"))
    # both sides' partners from one join: the pairs of kinds are made once and never written
    side = lambda left, *c: F.struct(F.lit(left).alias("left"), *[F.col(x).alias(y) for x, y in zip(c, ("p", "lo", "hi"))])
    sides = F.explode(F.array(side(True, "px", "ylo", "yhi"), side(False, "py", "xlo", "xhi"))).alias("of")
    of = materialize(met.select("key", sides).select("key", "of.*").groupBy("key", "left", "p").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "partners")
    of_x, of_y = of.where("left").drop("left"), of.where("not left").drop("left")
    one = lambda side, of: side.join(of, ["key", "p"]).groupBy("key", "v").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo = hi")
    of_t = one(t_side, of_x).select("key", F.col("v").alias("t"), F.col("lo").alias("a"))
    of_a = one(a_side, of_y).select("key", F.col("lo").alias("t"), F.col("v").alias("a"))
    return of_t.join(of_a, ["key", "t", "a"])


def holders(held: DataFrame, remaining: DataFrame, rules: dict[int, tuple[str, ...]], bases: dict[int, int], name: str) -> DataFrame | None:
    """(v, key): the holders of the rules' keys in held that have several on a side; none for no such key."""
    open_keys = held.where("t < t2 or a < a2").select("key", rule_of(F.col("key")).alias("rule")).where(F.col("rule").isin(list(rules)))
    counts = {r["rule"]: r["count"] for r in open_keys.groupBy("rule").count().collect()}  # one row a rule
    if not counts:
        return None
    open_keys = F.broadcast(open_keys.select("key")) if sum(counts.values()) <= FEW_KEYS else open_keys.select("key")  # else the keys are shuffled again
    return materialize(keys(remaining, {n: rules[n] for n in counts}, bases).join(open_keys, "key", "left_semi").distinct(), name)


def cascade(signed: DataFrame, passes: list[list[tuple[str, ...]]] | None = None, probes: list[list[tuple[str, ...]]] | None = None) -> DataFrame:
    """(t, a, rule): matched records of the first and the second source, at most one partner each, and the strongest rule
    that matched them.

    A record that several keys of one pass lead to different partners goes to the partner of the strongest rule, as if each rule
    were a pass of its own; of partners by the same rule to the one that more rules lead to, and to none if that is not mutual. The first pass needs no further agreement where one record of each source holds a key; of
    several holders those match who are each other's only agreeing one.

    The records left for a pass are some of those of the pass before. So a rule can match none of those whose keys by a weaker
    combination, a rule or probe of an earlier pass, only one source held, and these make no key by it.
    """
    probes = (PROBES if passes is None else []) if probes is None else probes
    passes = PASSES if passes is None else passes
    numbers = iter(range(1, 1 << RULE_BITS))
    ruled = [{next(numbers): r for r in rules} for rules in passes]
    probed = [{next(numbers): r for r in rules} for rules in [*probes, *[[]] * len(passes)][: len(passes)]]
    looked = [r | p for r, p in zip(ruled, probed)]
    bases = {m: sum(1 << b for early in looked[:n] for b, base in early.items() if implies(r, base)) for n, own in enumerate(looked) for m, r in own.items()}
    matched, remaining = [], signed
    for n, rules in enumerate(ruled):
        t, a = F.when(F.col("v") > 0, F.col("v")), F.when(F.col("v") < 0, F.col("v"))
        made = keys(remaining, looked[n], bases)
        held = materialize(made.groupBy("key").agg(F.min(t).alias("t"), F.max(t).alias("t2"), F.min(a).alias("a"), F.max(a).alias("a2")).where("t is not null and a is not null"), f"held{n + 1}")
        rule = rule_of(F.col("key"))
        single = held.where("t = t2 and a = a2").where(rule <= max(rules, default=0)).select("t", "a", rule.alias("rule"))
        about = remaining.select("v", F.struct("born", "pos", "height", "initials").alias("s"), F.expr("try_element_at(filter(transform(names, x -> x.g), g -> g is not null), 1)").alias("g"))
        # keys of several holders on a side: only those who agree count
        several = holders(held, remaining, rules, bases, f"several{n + 1}")
        if several is not None:
            few = F.broadcast(several) if several.count() <= FEW_KEYS else several
            members = materialize(about.select("v", "s").join(few, "v").distinct(), f"members{n + 1}")
            single = single.unionByName(only_agreeing(members).select("t", "a", rule.alias("rule")))
        fit = single.repartition("t").groupBy("t", "a").agg(F.min("rule").alias("rule"), F.count("*").cast("int").alias("n"))
        if n:
            x, y = about.withColumnsRenamed({"v": "t", "s": "x", "g": "gx"}), about.withColumnsRenamed({"v": "a", "s": "y", "g": "gy"})
            met = fit.join(x, "t").join(y, "a").where(agreeing("x", "y", initials=False)).select("t", "a", "rule", "n", "gx", "gy", same_initials("x", "y").alias("same"))
            met = materialize(met, "met")
            exact = next((m for m, r in rules.items() if r == NICKNAMED), None)
            if exact is not None:  # the same family name, birth date and position under another given name
                other = met.where(~F.col("same") & (F.col("rule") == exact)).select("t", "a", "rule", "n", "gx", "gy")
                known = other.join(nicknames(other), ["gx", "gy"]).select("t", "a", "rule", "n")
                met = met.where("same").select("t", "a", "rule", "n").unionByName(known)
            else:
                met = met.where("same")
            fit = met.repartition("t").groupBy("t", "a").agg(F.min("rule").alias("rule"), F.max("n").alias("n"))
        # the strongest rule first, then how many rules agree, as one number: aggregated by hash, without sorting
        rank = F.col("n") - F.col("rule") * 128
        of_t = fit.groupBy("t").agg(F.max(rank).alias("best"))
        of_a = fit.groupBy("a").agg(F.max(rank).alias("best"))
        top = fit.withColumn("rank", rank).join(of_t, "t").where("rank = best").drop("best").join(of_a, "a").where("rank = best")
        one_t = top.groupBy("t").agg(F.min("a").alias("a"), F.max("a").alias("a2"), F.min("rule").alias("rule")).where("a = a2")
        one = one_t.groupBy("a").agg(F.min("t").alias("t"), F.max("t").alias("t2"), F.min("rule").alias("rule")).where("t = t2").select("t", "a", "rule")
        found = materialize(one, f"pass{n + 1}")
        matched.append(found)
        if n + 1 < len(passes):
            # bit 0: resolved; the bits of the combinations that both sources held, as far as later rules ask for them
            asked = {m: looked[n][m] for m in looked[n] if any(bases[later] >> m & 1 for own in looked[n + 1 :] for later in own)}
            marks = [found.select(F.explode(F.array("t", "a")).alias("v"), F.lit(1).cast("long").alias("bits"))]
            if asked:
                bit = F.expr("shiftleft(1L, rule)")
                marks.append(held.where("t = t2 and a = a2").select(F.explode(F.array("t", "a")).alias("v"), rule.alias("rule")).where(F.col("rule").isin(list(asked))).select("v", bit.alias("bits")))
                probe = holders(held, remaining, {m: r for m, r in asked.items() if m in probed[n]}, bases, f"probe{n + 1}") if set(asked) & set(probed[n]) else None
                marks += [h.select("v", rule.alias("rule")).where(F.col("rule").isin(list(asked))).select("v", bit.alias("bits")) for h in (several, probe) if h is not None]
            marked = reduce(DataFrame.unionByName, marks).groupBy("v").agg(F.bit_or("bits").alias("bits")).hint("shuffle_hash")  # never more rows than records
            left = remaining.join(marked, "v", "left").where("bits is null or bits & 1 = 0")
            seen = F.coalesce("bits", F.lit(0).cast("long"))
            met_by = F.col("met").bitwiseOR(seen) if "met" in remaining.columns else seen
            rest = Written(left.select(*signed.columns, met_by.alias("met")), f"rest{n + 1}")
            if n:
                previous.drop()
            previous, remaining = rest, rest.df
    return reduce(DataFrame.unionByName, matched)


def rule_precision(matches: DataFrame, labels: DataFrame, prior: tuple[float, float] = PRIOR) -> DataFrame:
    """(rule, right, wrong, confidence): each rule's matches held against labelled pairs (t, a): right if labelled, wrong if
    the labels pair its t with others only; confidence is the smoothed share of right ones."""
    known = labels.select("t", "a").distinct()
    agree = known.withColumn("hit", F.lit(1))
    judged = matches.join(known.select("t").distinct(), "t").join(agree, ["t", "a"], "left")
    counts = judged.groupBy("rule").agg(F.count("hit").alias("right"), F.count_if(F.col("hit").isNull()).alias("wrong"))
    every = matches.select("rule").distinct().join(counts, "rule", "left").fillna(0, ["right", "wrong"])
    return every.select("rule", "right", "wrong", ((F.col("right") + prior[0]) / (F.col("right") + F.col("wrong") + sum(prior))).alias("confidence"))


def match(players: DataFrame) -> DataFrame:
    signed = Written(signatures(players), "signatures")
    matches = cascade(signed.df)
    signed.drop()
    return matches


def ids(matches: DataFrame) -> DataFrame:
    return matches.select(F.col("t").cast("string").alias("tm_id"), F.concat(F.lit("apif_"), (-F.col("a")).cast("string")).alias("apif_id"), *[c for c in matches.columns if c not in ("t", "a")])


def found(players: DataFrame) -> DataFrame:
    """(tm_id, apif_id): the same person in both sources."""
    return ids(match(players)).select("tm_id", "apif_id").distinct()


def with_confidence(players: DataFrame, proposed: DataFrame) -> DataFrame:
    """(tm_id, apif_id, rule, confidence), the labels being the proposed pairs: they are neither complete nor always right,
    so the confidence is that of agreeing with them, a lower bound where proposals are wrong."""
    digits = lambda c: F.expr(rf"try_cast(regexp_extract({c}, '([1-9][0-9]*)', 1) as bigint)")
    labels = proposed.select(digits("tm_id").alias("t"), (-digits("apif_id")).alias("a")).where("t is not null and a is not null")
    matches = match(players)
    return ids(matches.join(rule_precision(matches, labels).select("rule", "confidence"), "rule")).distinct()
