"""Fuzzy deduplication of a list against a base: token blocking, scoring of candidates, routing by score."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinweave.functions.metrics import pair_score
from kinweave.functions.text import matcher_name
from kinweave.storage import materialize

AUTO, REVIEW = 85, 70
#: Rows of open sets or of their first holders that are broadcast; more are joined by a shuffle.
FEW_ROWS = 500_000


def _word_rows(rows: DataFrame, ids: list[str], min_length: int) -> DataFrame:
    """(ids, words, places, sets): of each id all words of its names by their places, the places where they aren't 0, 1, 2, ...,
    and each different word with its count and first place, in alphabetical order."""
    words = F.filter(F.split(matcher_name(F.col("name")), r"\s+"), lambda w: F.length(w) >= min_length)
    t = rows.select(*ids, F.transform(words, lambda w, i: F.struct(i.alias("pos"), w.alias("word"))).alias("t")).groupBy(*ids).agg(F.array_sort(F.flatten(F.collect_list("t"))).alias("t"))
    t = t.where(F.size("t") > 0).select(*ids, F.col("t.word").alias("words"), F.col("t.pos").alias("places"))
    once = "array_sort(transform(words, (w, i) -> struct(w as word, 1 as n, places[i] as pos)))"
    every = "transform(array_sort(array_distinct(words)), w -> struct(w as word, size(filter(words, x -> x = w)) as n, places[cast(array_position(words, w) as int) - 1] as pos))"
    every = F.expr(f"if(size(array_distinct(words)) = size(words), {once}, {every})")
    return t.select(*ids, "words", F.expr("if(places = sequence(0, size(places) - 1), null, places)").alias("places"), every.alias("sets"))


def _few(df: DataFrame, count: int) -> DataFrame:
    return F.broadcast(df) if count <= FEW_ROWS else df


def candidates(queries: DataFrame, base: DataFrame, keep: int = 20, min_length: int = 3) -> DataFrame:
    """(q_id, b_id, n, rank): for each query the base rows that share most words of its name, ties by the first shared word's
    place, then the base row's order. queries(q_id, name), base(b_id, b_ord, name). A report of the best `keep`: a cap that
    is the feature. Words are counted with multiplicity on both sides.

    Exact without the product of a common word's holders. Base rows that share exactly the same words with a query, equally
    often, differ by their order alone, so the first `keep` holders of a set of words stand for all of them. A set of few
    holders is closed: its rows meet in full. An open one gives its first holders, and is made again with each further word
    of its rows until it is closed; so a pair is found by the set of all words it shares, or by a closed one in it. A set
    whose product is smaller than all sets that its rows could still make is closed too.
    """
    q = materialize(_word_rows(queries, ["q_id"], min_length), "queries")
    b = materialize(_word_rows(base, ["b_id", "b_ord"], min_length), "base")
    # sets of one word; rest: the words of the row that come after it. ones: every count is 1
    first = "posexplode(sets) as (i, w)"
    rest = lambda c: F.expr(f"slice({c}, i + 2, size({c}))").alias("rest")
    xq = q.select("*", F.expr(first)).select("q_id", "words", "places", F.col("w.word").alias("set"), F.array("w.n").alias("ns"), F.col("w.pos").alias("pos"), rest("sets"))
    xb = b.select("*", F.expr(first)).select("b_id", "b_ord", "words", F.col("w.word").alias("set"), F.array("w.n").alias("ns"), rest("sets"))
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda x, y: x + y)
    met, opened, firsts = [], [], []
    while True:
        own = lambda x, at: x.select("set", F.lit(1 - at).alias("q"), F.lit(at).alias("b"), (F.array_max("ns") * at).alias("most"), F.pow(F.lit(2.0), F.size("rest")).alias("more"))
        sets = own(xq, 0).unionByName(own(xb, 1)).groupBy("set").agg(F.sum("q").alias("q"), F.sum("b").alias("b"), F.max("most").alias("most"), F.sum("more").alias("more"))
        is_open = materialize(sets.where((F.col("q") > 0) & (F.col("b") > keep) & (F.col("q").cast("double") * F.col("b") > F.col("more"))).select("set", "most"), "open")
        count = is_open.count()
        is_open = _few(is_open, count)
        left, right = (x.join(is_open.select("set"), "set", "left_anti") if count else x for x in (xq, xb))
        meet = left.select("q_id", F.col("words").alias("x"), "places", "set").join(right.select("b_id", "b_ord", F.col("words").alias("y"), "set"), "set")
        met.append(meet.select("q_id", "b_id", "b_ord", "x", "y", "places"))
        if not count:
            break
        xq, xb = xq.join(is_open, "set"), xb.join(is_open.select("set"), "set")
        # how well its holders share at least, and at most
        opened.append(xq.select("q_id", "set", "ns", "pos", total("ns").alias("least"), "most"))
        order = Window.partitionBy("set", "ns").orderBy("b_ord", "b_id")
        firsts.append(xb.select("set", "ns", "b_id", "b_ord").withColumn("r", F.row_number().over(order)).where(F.col("r") <= keep).drop("r"))
        # one more word
        longer = [F.concat_ws(" ", "set", "w.word").alias("set"), F.concat("ns", F.array("w.n")).alias("ns")]
        xq = xq.select("*", F.expr("posexplode(rest) as (i, w)")).select("q_id", "words", "places", *longer, F.least("pos", "w.pos").alias("pos"), rest("rest"))
        xb = xb.select("*", F.expr("posexplode(rest) as (i, w)")).select("b_id", "b_ord", "words", *longer, rest("rest"))
    found = reduce(DataFrame.unionByName, met).withColumn("both", F.array_intersect("x", "y"))
    single = (F.size(F.array_distinct("x")) == F.size("x")) & (F.size(F.array_distinct("y")) == F.size("y"))
    n = F.when(single, F.size("both").cast("long")).otherwise(F.expr("aggregate(x, 0L, (n, w) -> n + size(filter(y, v -> v = w)))"))
    at = F.array_position("x", F.element_at("both", 1)).cast("int") - 1
    pos = F.when(F.col("places").isNull(), at).otherwise(F.get("places", at))
    # a candidate by what ranks it
    found = found.select("q_id", F.struct((-n).alias("n"), pos.cast("int").alias("pos"), "b_ord", "b_id").alias("c"))
    if not opened:
        found = found.groupBy("q_id").agg(F.collect_list("c").alias("c"))
    else:
        firsts = materialize(reduce(DataFrame.unionByName, firsts).groupBy("set", "ns").agg(F.collect_list(F.struct("b_ord", "b_id")).alias("holders")), "firsts")
        firsts = _few(firsts.withColumnsRenamed({"set": "s", "ns": "m"}), firsts.count() * keep)
        # an open set has more than `keep` holders: what shares less than all of them is out
        sets = reduce(DataFrame.unionByName, opened).select("q_id", F.struct("set", "ns", "least", "most", "pos").alias("o"), F.struct("least", (-F.col("pos")).alias("p")).alias("l"))
        none = lambda df, c: F.lit(None).cast(df.schema[c].dataType)
        each = found.withColumns({"o": none(sets, "o"), "l": none(sets, "l")}).unionByName(sets.withColumn("c", none(found, "c")))
        each = each.groupBy("q_id").agg(F.collect_list("c").alias("c"), F.collect_list("o").alias("o"), F.max("l").alias("l"))
        each = each.withColumns({
            "c": F.expr("if(l is null, c, filter(c, x -> struct(-x.n as least, -x.pos as p) >= l))"),
            "o": F.expr("filter(o, x -> struct(x.least * x.most as least, -x.pos as p) >= l)"),
        })
        own = each.select("q_id", "c", F.explode_outer("o").alias("o")).join(firsts, F.expr("o.set = s"), "left")
        n = F.expr("if(array_max(m) = 1, o.least, aggregate(zip_with(o.ns, m, (x, y) -> cast(x as long) * y), 0L, (x, y) -> x + y))")
        held = own.select("q_id", "c", "holders", F.col("o.pos").alias("pos"), (-n).alias("n"))
        held = held.select("q_id", "c", F.expr("transform(holders, h -> struct(n as n, pos as pos, h.b_ord as b_ord, h.b_id as b_id))").alias("h"))
        found = held.groupBy("q_id").agg(F.any_value("c").alias("c"), F.flatten(F.collect_list("h")).alias("h")).select("q_id", F.concat("c", "h").alias("c"))
    # of the sets that lead to a row the one of all shared words counts: it comes first
    best = found.select("q_id", F.sort_array("c").alias("c"))
    once = F.expr("if(size(array_distinct(transform(c, x -> x.b_id))) = size(c), c, filter(c, (x, i) -> not exists(slice(c, 1, i), y -> y.b_id <=> x.b_id and y.b_ord <=> x.b_ord)))")
    return best.select("q_id", F.posexplode(F.slice(once, 1, keep)).alias("i", "c")).select("q_id", "c.b_id", (-F.col("c.n")).alias("n"), (F.col("i") + 1).alias("rank"))


def scored(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """pairs with columns a and b, structs (name, born, club, nationality), gets score and reason."""

    def score(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        x, y = x.astype(object).where(x.notna(), None), y.astype(object).where(y.notna(), None)
        return pd.DataFrame([pair_score(tuple(p), tuple(q)) for p, q in zip(x.itertuples(index=False), y.itertuples(index=False), strict=True)], columns=["score", "reason"])

    got = F.pandas_udf(score, "score int, reason string")
    return pairs.withColumn("_s", got(a, b)).select("*", F.col("_s.score").alias("score"), F.col("_s.reason").alias("reason")).drop("_s")


def profile(name: str, born: str, club: str, nationality: str):
    return F.struct(matcher_name(F.col(name)).alias("name"), F.col(born).cast("string").alias("born"), matcher_name(F.col(club)).alias("club"), matcher_name(F.col(nationality)).alias("nationality"))


def resolve(queries: DataFrame, base: DataFrame) -> DataFrame:
    """(q_id, b_id, score, reason, route): each query's best candidate and where it goes: merge, review, or new.

    queries(q_id, name, born, club, nationality), base(b_id, b_ord and the same). Nationalities that both sides state and
    that differ block a merge: the query goes to review and is new as well. Queries without a candidate are new.
    """
    best = candidates(queries.select("q_id", "name"), base.select("b_id", "b_ord", "name"))
    q = queries.select("q_id", profile("name", "born", "club", "nationality").alias("a"))
    b = base.select("b_id", profile("name", "born", "club", "nationality").alias("b"))
    top = scored(best.join(q, "q_id").join(b, "b_id")).groupBy("q_id").agg(F.max(F.struct("score", (-F.col("rank")).alias("r"), "b_id", "reason", F.col("a.nationality").alias("x"), F.col("b.nationality").alias("y"))).alias("m"))
    blocked = F.coalesce(F.lower("m.x") != F.lower("m.y"), F.lit(False))
    route = F.when(F.col("m.score").isNull() | (F.col("m.score") == 0), "new:no_candidates").when((F.col("m.score") >= AUTO) & blocked, "review:nat_block").when(F.col("m.score") >= AUTO, "merge").when(F.col("m.score") >= REVIEW, "review").otherwise("new:no_match")
    return queries.select("q_id").join(top, "q_id", "left").select("q_id", F.col("m.b_id").alias("b_id"), F.col("m.score").alias("score"), F.col("m.reason").alias("reason"), route.alias("route"))


def merged(base: DataFrame, routed: DataFrame, queries: DataFrame, fields: list[str]) -> DataFrame:
    """The base with the given fields of its merged query, the last query winning, and the other queries as new rows.
    queries(q_id, q_ord, fields...), base(b_id, fields...)."""
    hits = routed.where("route = 'merge'").join(queries.select("q_id", "q_ord", *[F.col(f).alias(f"_{f}") for f in fields]), "q_id")
    winners = hits.groupBy("b_id").agg(F.max(F.struct("q_ord", "q_id", *[f"_{f}" for f in fields])).alias("w"))
    kept = base.join(winners, "b_id", "left").select(*[c for c in base.columns if c not in fields], *[F.coalesce(F.col(f"w._{f}"), F.col(f)).alias(f) for f in fields], F.col("w.q_id").alias("q_id"))
    new = routed.where("route <> 'merge'").join(queries, "q_id").select("q_id", *fields)
    return kept.unionByName(new, allowMissingColumns=True)
