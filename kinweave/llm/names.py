"""Variant spellings of people's names linked to the person they mean.

The words of the typed short names meet the words of the reference names in a set-similarity join on token q-grams, equal
words and misspelt ones alike: rarest q-grams first, only a prefix of them is joined, and pairs are kept that share as many
q-grams as the allowed slips leave. A typed name then keeps the rarest of its words as its prefix: a reference that shares
none of them can't reach the least similarity. Names meet by a word of that prefix within further evidence (a birth date or
a slip of it, a place), and every meeting is verified by a soft weighted similarity of the names' words, in which a rare word
counts more, and by attributes that must not contradict each other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm.linkage import _loose, _once, _unaccented, agreeing, plain
from kinweave.storage import Written, materialize

#: Letters of a q-gram; slips (changed, added, dropped or exchanged letters) of a word.
Q, SLIPS = 3, 1
#: The least similarity of two names whose birth dates are equal, and of others; the share of the long name's words that a reference must know.
SIMILAR, DOUBTFUL, LONG_NAME = 0.5, 0.6, 0.5
#: Numbers that q-grams are hashed to when their prefixes meet: bounds the table of their counts, whatever the alphabet.
GRAMS = 1 << 15
#: Share of the weight of a word that one reference holds which a typed word weighs that no reference holds.
UNKNOWN = 0.75
#: How alike words must be, edits against length, to stand for each other once two names have met.
ALIKE = 0.7


def grams(words: DataFrame) -> DataFrame:
    """(word, gram, pos): the positional q-grams of distinct words, their ends marked, as numbers of bounded range."""
    padded = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    at = F.sequence(F.lit(1), F.length("word") + 3 - Q)
    number = F.pmod(F.xxhash64(F.expr(f"substring(p, pos, {Q})")), F.lit(GRAMS)).cast("int")
    return words.select("word", padded.alias("p"), F.explode(at).alias("pos")).select("word", number.alias("gram"), "pos")


def prefixes(words: DataFrame, common: DataFrame, length: int) -> DataFrame:
    """(word, gram, pos): the rarest q-grams of each word. common(gram, n) has at most GRAMS rows."""
    known = grams(words).join(F.broadcast(common), "gram", "left")
    order = F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "pos")))
    return known.groupBy("word").agg(F.slice(order, 1, length).alias("g")).select("word", F.explode("g").alias("g")).select("word", "g.gram", "g.pos")


def lost_grams(a: str, b: str) -> Column:
    """How many different q-grams the word of more of them has that the other one hasn't, read from the words themselves; null if
    they share none."""
    every = lambda c: F.array_distinct(F.regexp_extract_all(F.concat(F.lit("^"), F.col(c), F.lit("$")), F.lit(f"(?=({'.' * Q}))"), F.lit(1)))
    shared = F.size(F.array_intersect(every(a), every(b)))
    return F.when(shared > 0, F.greatest(F.size(every(a)), F.size(every(b))) - shared)


def letters(c: str | Column) -> Column:
    return F.array_join(F.sort_array(F.split(c, "")), "")


def spellings(typed: DataFrame, reference: DataFrame, slips: int = SLIPS) -> DataFrame:
    """(word, other, sim): words of typed(word) and the words of reference(word) they may stand for, equal or up to `slips`
    edits or exchanges of neighbours away. Distinct words of two letters or more in.

    A slip costs a word at most Q + 1 of its q-grams, so partners share at least the longer one's number less that for each
    slip, and one of the rarest (Q + 1) * slips + 1 at places no further apart than the slips. At least one q-gram must be
    shared: only the middle letter of a word of three and an exchange within one of four leave none.
    """
    lost = (Q + 1) * slips
    common = grams(reference).groupBy("gram").agg(F.count("*").alias("n"))
    # where a shared q-gram can stand in the other word, and how long that can be: dropped or added letters move it
    moves = F.array(*[F.struct(F.lit(n).alias("longer"), F.lit(p).alias("later")) for n in range(-slips, slips + 1) for p in range(-slips, slips + 1) if abs(p) + abs(n - p) <= slips])
    place = lambda later, longer: F.xxhash64("gram", F.col("pos") + later, F.length("word") + longer).alias("place")
    a = prefixes(typed, common, lost + 1).select("*", F.explode(moves).alias("m")).select("word", place(F.col("m.later"), F.col("m.longer")))
    b = prefixes(reference, common, lost + 1).select(F.col("word").alias("other"), place(0, 0))
    longer = F.greatest(F.length("word"), F.length("other"))
    # an exchange is two edits that leave the letters as they are
    n = int(typed.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, many pairs: a fixed number isn't coalesced
    met = a.repartition(n, "place").join(b.repartition(n, "place"), "place").select("word", "other", F.levenshtein("word", "other", 2 * slips).alias("d")).where("d >= 0")
    near = met.groupBy("word", "other").agg(F.min("d").alias("d"))
    kept = near.where(F.when((F.col("d") <= slips) | (F.levenshtein(letters("word"), letters("other")) <= 2 * (2 * slips - F.col("d"))), lost_grams("word", "other") <= lost))
    return kept.select("word", "other", (1 - F.col("d") / longer).alias("sim"))


def folded(c: Column) -> Column:
    """A typed name in lower-case letters without accents, one blank between words, the given name first where a comma tells;
    "Thom." becomes an initial."""
    c = F.when(F.contains(c, F.lit(",")), F.concat_ws(" ", F.substring_index(c, ",", -1), F.substring_index(c, ",", 1))).otherwise(c)
    c = _unaccented(F.when(F.contains(c, F.lit(".")), F.regexp_replace(c, r"(\p{L})\p{L}{1,3}\.", "$1 ")).otherwise(c))
    return F.trim(F.when(F.contains(c, F.lit("  ")), F.regexp_replace(c, " +", " ")).otherwise(c))


def _tokens(name: str) -> Column:
    """The different words and initials of a folded name; a blank name has one empty word."""
    return F.array_distinct(F.split(name, " "))


def _hashed(c: str) -> Column:
    value = F.replace(plain(F.col(c)), F.lit(" "), F.lit(""))
    return F.when(value != "", F.hash(value))


def references(players: DataFrame) -> DataFrame:
    """(ref, player_id, born, height, city, nation, full, called, known) of the reference persons; known are the words of all their
    names, nicknames too. ref is a hash that only leads rows to each other: the id decides."""
    nick = F.expr("array_join(transform(from_json(nicknames, 'array<struct<nickname:string>>'), n -> n.nickname), ' ')")
    t = players.where("id is not null").select(
        F.xxhash64("id").alias("ref"), F.col("id").alias("player_id"), F.col("date_of_birth").alias("born"), F.col("height_cm").alias("height"), _hashed("birth_city").alias("city"),
        _hashed("nationality_primary").alias("nation"), folded(F.coalesce("full_legal_name", F.lit(""))).alias("full"), folded(F.coalesce("known_as", F.lit(""))).alias("called"), folded(F.coalesce(nick, F.lit(""))).alias("nicks"),
    ).withColumn("names", F.concat_ws(" ", "full", "called", "nicks"))
    return t.select("ref", "player_id", "born", "height", "city", "nation", "full", "called", F.filter(_tokens("names"), lambda t: F.length(t) > 1).alias("known")).distinct()


def records(rows: DataFrame) -> DataFrame:
    """(rec, record_id, short, name, born, height, city, nation) of the rows whose short name is not null; rec numbers them once
    they are written. The long name is an attribute: it tells a given name that the short one leaves out, but leads to no
    reference."""
    return rows.where("id is not null and name_short is not null").select(
        F.monotonically_increasing_id().alias("rec"), F.col("id").alias("record_id"), folded(F.col("name_short")).alias("short"), folded(F.coalesce("name", F.lit(""))).alias("name"),
        F.col("date_of_birth").alias("born"), F.col("height_cm").alias("height"), _hashed("city_of_birth").alias("city"), _hashed("nationality").alias("nation"),
    )


def typed_names(rec: DataFrame, dictionary: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """records() with (typed, unknown, prefix), those whose words can reach the least similarity. typed are the words some
    reference holds, heaviest first, with weight and partners (others); unknown is the weight of each other word; prefix the
    number of words that a similar reference can't all miss."""
    split = rec.select("rec", F.explode(_tokens("short")).alias("word")).where(F.length("word") > 1)
    held = split.join(dictionary, "word").groupBy("rec").agg(F.sort_array(F.collect_list(F.struct("w", "word", "others")), asc=False).alias("typed"), F.max("rare").alias("rare"))
    t = held.join(rec, "rec").withColumn("unknown", F.col("rare") * UNKNOWN).drop("rare")
    single = F.size("typed") == 1  # most short names: spared the loops over words
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda x, y: x + y["w"])
    initials = F.size(F.filter(_tokens("short"), lambda t: F.length(t) == 1))
    missed = F.size(_tokens("short")) - initials - F.size("typed")
    t = t.withColumn("need", F.lit(similar) * (F.when(single, F.col("typed")[0]["w"]).otherwise(total("typed")) + F.col("unknown") * missed + initials) - initials)
    # words from the i-th on may be left out if they weigh less than what is needed
    reach = F.transform("typed", lambda x, i: total(F.slice("typed", i + 1, F.size("typed"))))
    prefix = F.when(single, (F.col("typed")[0]["w"] >= F.col("need")).cast("int")).otherwise(F.size(F.filter(reach, lambda s: s >= F.col("need"))))
    return _once(t, prefix=prefix).where("prefix > 0").drop("need")


def _keys(t: DataFrame, key: str, missing: tuple[int, int]) -> DataFrame:
    """(key, k): hashes of a word together with evidence, from rows (key, word, sure, i, j, born, city, nation). A word that
    isn't sure to be meant needs the birth date. A date that one side doesn't know is replaced by nationality and initial;
    which side that is parts the two kinds `missing`."""
    born = F.col("born")
    turn = F.when(F.dayofyear(born) == 1, F.date_sub(born, 1))  # the day before in another year
    made = [F.when(c.isNotNull(), F.xxhash64(F.lit(1), "word", _loose(c))) for c in (born, turn)] + [F.when(F.col("city").isNotNull() & F.col("sure"), F.xxhash64(F.lit(4), "word", "city"))]
    for i in ("i", "j"):
        kinds = [(2, F.year(born), born.isNotNull()), (3, F.month(born) * 100 + F.dayofmonth(born), born.isNotNull()), (missing[0], F.col("nation"), F.lit(True)), (missing[1], F.col("nation"), born.isNull())]
        made += [F.when(F.col("sure") & F.col(i).isNotNull() & c.isNotNull() & when, F.xxhash64(F.lit(n), "word", i, c)) for n, c, when in kinds]
    return t.select(key, F.explode(F.array(*made)).alias("k")).where("k is not null")


def _initials(word: Column, *names: str) -> list[Column]:
    """i, j: the first letters of what stands first in two names besides the word; j null where it's the same."""
    tokens = lambda c, n: F.try_element_at(F.split(c, " "), F.lit(n))
    i, j = [F.nullif(F.substring(F.when(tokens(c, 1) != word, tokens(c, 1)).otherwise(tokens(c, 2)), 1, 1), F.lit("")) for c in names]
    return [F.coalesce(i, j).alias("i"), F.when(i != j, j).alias("j")]


def candidates(typed: DataFrame, ref: DataFrame) -> DataFrame:
    """(rec, ref) that share a word of the typed prefix, or one it may stand for, and further evidence. A typed word that some
    reference holds as it stands is taken for a slip of another one only with a birth date."""
    x = typed.select("rec", "short", "name", "born", "city", "nation", F.explode(F.slice("typed", F.lit(1), F.col("prefix"))).alias("t"))
    x = x.select("rec", "born", "city", "nation", *_initials(F.col("t.word"), "short", "name"), "t", F.explode("t.others").alias("word"))
    x = x.withColumn("sure", (F.col("word") == F.col("t.word")) | ~F.array_contains("t.others", F.col("t.word")))
    y = ref.select("ref", "full", "called", "born", "city", "nation", F.explode("known").alias("word"), F.lit(True).alias("sure"))
    y = y.select("*", *_initials(F.col("word"), "full", "called"))
    return _keys(x, "rec", (6, 5)).join(_keys(y, "ref", (5, 6)), "k").select("rec", "ref").distinct()


def alike(t: Column, u: Column) -> Column:
    """How far one word stands for another: equal, begun by it (an abbreviation), or spelt alike."""
    d, longer = F.levenshtein(t, u), F.greatest(F.length(t), F.length(u))
    same = 1 - F.when((d == 2) & (letters(t) == letters(u)), 1).otherwise(d) / longer  # an exchange is one slip
    return F.when(t == u, 1.0).when(F.startswith(u, t), 0.9).when(same >= ALIKE, same).otherwise(0.0)


def soft_similarity(typed: Column, others: Column, unknown: Column, known: Column) -> Column:
    """How much of the typed words' weight the known words account for: each typed word takes its best partner. typed are
    (w, word) pairs; others are typed words that no reference holds, of the weight `unknown`; initials weigh 1."""
    best = lambda t: F.array_max(F.transform(known, lambda u: alike(t, u)))
    total = lambda c, f: F.aggregate(c, F.lit(0.0), lambda x, y: x + f(y))
    weight = lambda t: F.when(F.length(t) > 1, unknown).otherwise(1.0)
    got = total(typed, lambda x: x["w"] * best(x["word"])) + total(others, lambda t: weight(t) * best(t))
    return got / (total(typed, lambda x: x["w"]) + total(others, weight))


def verified(pairs: DataFrame) -> DataFrame:
    """(record_id, player_id, level, similarity): pairs of a record (x) and a reference (y) that can be of one person.

    anchor is the known word that the heaviest typed word stands for; the given name is the first word besides it. Birth
    dates must be equal or a slip (3, 2) or one unknown (1); a slip asks for the initial of the given name or the place besides, an
    unknown date for the given name and the place or nation, or the initial and the birth place. The level is twice that
    number, one more for the whole given name. The long name must not be somebody else's.
    """
    hit = F.transform("typed", lambda x: F.array_max(F.transform("known", lambda u: F.struct(alike(x["word"], u).alias("s"), u.alias("u")))))
    p = _once(pairs.where(agreeing("x", "y", initials=False)), anchor=F.try_element_at(F.filter(hit, lambda h: h["s"] >= ALIKE), F.lit(1))["u"]).where("anchor is not null")
    given = lambda c: F.try_element_at(F.filter(F.split(c, " "), lambda t: (t != "") & ((F.length(t) == 1) | (alike(t, F.col("anchor")) == 0))), F.lit(1))
    both = lambda a, b: F.array_distinct(F.array_compact(F.array(given(a), given(b))))
    p = _once(p, givens=both("short", "name"), own=both("full", "called"))
    first = lambda c: F.transform(c, lambda t: F.substring(t, 1, 1))
    i = F.when((F.size("givens") > 0) & (F.size("own") > 0), F.arrays_overlap(first("givens"), first("own")))
    g = F.arrays_overlap(F.filter("givens", lambda t: F.length(t) > 2), "own")
    same = lambda c: F.coalesce(F.col(f"x.{c}") == F.col(f"y.{c}"), F.lit(False))
    level = F.when(same("born"), 3).when(F.col("x.born").isNotNull() & F.col("y.born").isNotNull(), 2).otherwise(1)
    long_name = F.filter(F.split("name", " "), lambda t: F.length(t) > 2)
    heard = F.size(F.filter(long_name, lambda t: F.exists("known", lambda u: alike(t, u) > 0))) >= LONG_NAME * F.size(long_name)
    others = F.array_except(F.split("short", " "), F.transform("typed", lambda x: x["word"]))
    sim = soft_similarity(F.col("typed"), others, F.col("unknown"), F.col("known"))
    p = _once(p, i=i, g=F.coalesce(g, F.lit(False)), level=level, heard=heard, similarity=F.round(sim, 6))
    known_i = F.coalesce(F.col("i"), F.lit(False))
    enough = F.when(F.col("level") == 3, True).when(F.col("level") == 2, known_i | same("city")).otherwise((F.col("g") & (same("nation") | same("city"))) | (same("city") & (known_i | same("height"))))
    p = p.where(F.coalesce(F.col("i"), F.lit(True)) & F.col("heard") & enough & (F.col("similarity") >= F.when(F.col("level") == 3, SIMILAR).otherwise(DOUBTFUL)))
    return p.select("record_id", "player_id", (F.col("level") * 2 + F.col("g").cast("int")).alias("level"), "similarity")


def scored(rows: DataFrame, players: DataFrame, slips: int = SLIPS) -> DataFrame:
    """(record_id, player_id, level, similarity, tied): for each row with a short name its best reference, and whether another
    reference is as good.

    Null names, ids and attributes make no key; names without a word of two letters are linked to nobody; repeated rows are
    linked once. A word that a third of all names hold makes no key on its own, only together with further evidence, and
    any number of references may hold a key: verification tells them apart.
    """
    ref_table, rec_table = Written(references(players), "references"), Written(records(rows), "records")
    ref, rec = ref_table.df, rec_table.df
    distinct = lambda t, c: t.select(F.explode(c).alias("word")).where(F.length("word") > 1).distinct()
    counts = ref.select("player_id", F.explode("known").alias("other")).groupBy("other").agg(F.count_distinct("player_id").alias("n"))
    total = ref.agg(F.log(1 + F.count("*")).alias("rare"), F.count("*").alias("total"))
    # a word's weight is its rarity among the reference names, a misspelt one's that of its rarest partner
    weight = F.log(1 + F.col("total") / F.col("n"))
    spelt = spellings(distinct(rec, _tokens("short")), distinct(ref, "known"), slips).join(counts, "other").crossJoin(F.broadcast(total))
    dictionary = Written(spelt.groupBy("word").agg(F.coalesce(F.max(F.when(F.col("word") == F.col("other"), weight)), F.max(weight)).alias("w"), F.collect_list("other").alias("others"), F.max("rare").alias("rare")), "spellings")
    typed = Written(typed_names(rec, dictionary.df), "typed")
    dictionary.drop()
    rec_table.drop()
    met = materialize(candidates(typed.df, ref), "candidates")
    about = lambda t, s: t.withColumn(s, F.struct("born", F.lit(None).cast("string").alias("pos"), "height", "city", "nation")).drop("born", "height", "city", "nation")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # comparing costs more than its bytes tell: a fixed number isn't coalesced
    pairs = met.join(about(ref, "y"), "ref").repartition(n, "rec").join(about(typed.df, "x").drop("prefix").repartition(n, "rec"), "rec")
    # two orders of equally good references: where they end differently, several are as good
    order = lambda tie: F.max(F.struct("level", "similarity", tie.alias("tie"), "player_id"))
    tie = F.shiftright(F.xxhash64("player_id"), 1)
    best = verified(pairs).groupBy("record_id").agg(order(tie).alias("a"), order(-tie).alias("b"))
    return best.select("record_id", "a.player_id", "a.level", "a.similarity", (F.col("a.player_id") != F.col("b.player_id")).alias("tied"))


def link(rows: DataFrame, players: DataFrame) -> DataFrame:
    """(player_id, record_id, level, similarity): the links that a single best reference gives."""
    return scored(rows, players).where("not tied").select("player_id", "record_id", "level", "similarity")


def unlinked(rows: DataFrame, players: DataFrame) -> DataFrame:
    """(record_id, reason): rows with a short name that are linked to nobody, because no reference is similar or several are
    equally good."""
    best = scored(rows, players).select("record_id", "tied")
    named = rows.where("id is not null and name_short is not null").select(F.col("id").alias("record_id")).distinct()
    return named.join(best, "record_id", "left").where("tied is null or tied").select("record_id", F.when(F.col("tied"), "several").otherwise("none").alias("reason"))


def found(rows: DataFrame, players: DataFrame) -> DataFrame:
    """(player_id, record_id)"""
    return link(rows, players).select("player_id", "record_id")
