import random

import pytest
from pyspark.sql import functions as F

from kinweave.operators import dml, exact, fuzzy, quality, ranking, readonly, reconcile


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_quarantine_touches_both_sides(spark):
    p = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y"), ("c", "z")], "l string, r string")
    assert rows(exact.quarantined(p, "l", "r")) == [("a", "x"), ("a", "y"), ("b", "y")]
    assert rows(exact.clean(p, "l", "r")) == [("c", "z")]
    assert rows(exact.duplicates(p, "l", "left")) == [("left", "a", 2)]
    assert exact.clean(p.limit(0), "l", "r").count() == 0


VALUES = "entity string, field string, source string, value string, prio int"


@pytest.mark.parametrize(("values", "outcome", "severity", "status"), [
    (["A", "A"], "agreed", "CRITICAL", "none"), (["A", "A", "B"], "dismissed", "CRITICAL", "none"), (["B", "A", "A"], "conflict", "CRITICAL", "needs_review"), (["A", "B"], "conflict", "CRITICAL", "needs_review"),
    (["A", "B", "C"], "conflict", "CRITICAL", "needs_review"), (["A", "A", "B", "B"], "conflict", "INFORMATIONAL", "auto_resolved"), (["A", "A", "B", "C"], "conflict", "INFORMATIONAL", "auto_resolved"), (["C", "A", "A", "B"], "conflict", "CRITICAL", "needs_review"), (["Man City FC", "manchester city ", None, "B"], "dismissed", "CRITICAL", "none"), (["A"], None, None, None),
])
def test_votes(spark, values, outcome, severity, status):
    v = spark.createDataFrame([("e", "current_club", f"s{i}", x, i) for i, x in enumerate(values) if x], VALUES)
    got = reconcile.vote(v).collect()
    assert [(r["outcome"], r["severity"], r["status"]) for r in got] == ([(outcome, severity, status)] if outcome else [])


def test_reconcile_chain(spark):
    v = spark.createDataFrame([("e", "position", "s1", "A", 1), ("e", "position", "s2", "B", 2), ("e", "current_club", "s1", "X", 1), ("e", "current_club", "s2", "Y", 2), ("f", "height_cm", "s2", "1", 2), ("f", "height_cm", "s1", "1", 1)], VALUES)
    votes = reconcile.vote(v)
    assert rows(reconcile.merge(v)) == [("e", "current_club", "X", "s1", 2), ("e", "position", "A", "s1", 2), ("f", "height_cm", "1", "s1", 2)]
    assert rows(reconcile.blocked(votes)) == [("e", 2, True), ("f", 0, False)]
    assert {r["field"]: (r["status"], r["resolved_value"]) for r in reconcile.resolve_by_priority(votes).where("entity = 'e'").collect()} == {"position": ("resolved", "A"), "current_club": ("needs_review", None)}
    assert {r["field"]: r["all_sources"] for r in reconcile.attributed(v).where("entity = 'e'").collect()}["position"] == {"s1": "A", "s2": "B"}


def test_verified_null_overwrites(spark):
    current = spark.createDataFrame([("e", "club", "A"), ("f", "club", None), ("g", "club", "C")], "entity string, field string, value string")
    verified = spark.createDataFrame([("e", "club", None), ("f", "club", "B"), ("g", "club", " c ")], "entity string, field string, value string")
    d = reconcile.diff(current, verified)
    assert rows(d) == [("e", "club", 3, "A", None, False), ("f", "club", 3, None, "B", True)]
    assert rows(reconcile.apply_changes(current, d).select("entity", "value")) == [("e", None), ("f", "B"), ("g", "C")]


def test_words_for_nothing_tiers_and_flags(spark):
    schema = "entity string, field string, value string"
    current = spark.createDataFrame([("e", "current_club", "A"), ("e", "international_caps", None), ("e", "date_of_birth", "null"), ("e", "contract_expires", "2027")], schema)
    verified = spark.createDataFrame([("e", "current_club", "Unknown"), ("e", "international_caps", "N/A"), ("e", "date_of_birth", "2000-01-01"), ("e", "contract_expires", "2028"), ("e", "position_primary", "GK"), ("x", "current_club", "B")], schema)
    d = reconcile.diff(current, verified)
    assert rows(d) == [("e", "contract_expires", 3, "2027", "2028", False), ("e", "current_club", 1, "A", None, False), ("e", "date_of_birth", 2, "null", "2000-01-01", True), ("e", "position_primary", 1, None, "GK", True)]
    assert rows(reconcile.diff(current, verified, tier=2)) == [("e", "date_of_birth", 2, "null", "2000-01-01", True)]
    assert rows(reconcile.diff(current, verified, fields=["contract_expires"])) == [("e", "contract_expires", 3, "2027", "2028", False)]
    assert rows(reconcile.not_found(current, verified)) == [("x",)]
    assert rows(reconcile.change_counts(d)) == [("filled", 2), ("tier1", 1), ("tier3", 1)]
    assert rows(reconcile.curation_flags(d)) == [("e", "recency_check: T1:current_club:A->NULL; T1:position_primary:NULL->GK; T2:date_of_birth:null->2000-01-01; T3:contract_expires:2027->2028")]


def test_player_issues(spark):
    import datetime as dt

    day = dt.date(1999, 1, 1)
    schema = "id string, name string, position string, nationality string, date_of_birth date, team_code string"
    squad = [(f"{i:02}", f"n{i}", "Defender", "X", day, "AAA") for i in range(22)] + [(f"{i:02}", "same " if i == 40 else "Same" if i == 41 else f"m{i}", "gk", "X", day, "BBB") for i in range(30, 57)]
    odd = [("a", " ", None, "", dt.date(2015, 1, 1), None), ("b", "old", "x", "y", dt.date(1970, 1, 1), None), ("c", None, "x", "y", None, None)]
    p, s = spark.createDataFrame(odd, schema), spark.createDataFrame(squad, schema)
    got = {(r["source_id"] or r["player_name"], r["check"], r["severity"]) for r in quality.player_issues(p, s).collect()}
    assert got == {("a", "missing_name", "critical"), ("a", "missing_position", "warning"), ("a", "missing_nationality", "warning"), ("a", "age_too_young", "error"), ("b", "age_too_old", "warning"), ("c", "missing_name", "critical"), ("TEAM:AAA", "squad_incomplete", "warning"), ("TEAM:AAA", "no_goalkeeper", "error"), ("TEAM:BBB", "squad_too_large", "warning"), ("Same", "duplicate_in_team", "error")}
    assert quality.player_issues(p.limit(0), s.limit(0)).count() == 0


def test_upserts(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3)], "k int, n string, v int")
    n = spark.createDataFrame([(2, "B", 2), (3, "c", None), (4, "d", 4), (4, "d", 4)], "k int, n string, v int")
    assert rows(dml.insert_missing(t, n, ["k"])) == [(1, "a", 1), (2, "b", None), (3, "c", 3), (4, "d", 4)]
    assert rows(dml.upsert(t, n, ["k"])) == [(1, "a", 1), (2, "B", 2), (3, "c", 3), (4, "d", 4)]
    assert rows(dml.upsert(t, n, ["k"], keep_old_if_null=False)) == [(1, "a", 1), (2, "B", 2), (3, "c", None), (4, "d", 4)]
    assert rows(dml.update_from(t, n, ["k"], {"v": F.col("s_v")})) == [(1, "a", 1), (2, "b", 2), (3, "c", None)]
    assert rows(dml.delete_in(t, n, ["k"])) == [(1, "a", 1)]
    assert rows(dml.snapshot_diff(t, n.distinct(), ["k"])) == [(1, "removed"), (2, "changed"), (3, "changed"), (4, "added")]


def test_flags_are_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, None), (3, "x; y")], "k int, curation_reason string")
    once = dml.flag_in(t, t.where("k > 1"), ["k"], "y")
    assert rows(once) == rows(dml.flag_in(once, t.where("k > 1"), ["k"], "y")) == [(1, "a"), (2, "y"), (3, "x; y")]
    assert rows(dml.unflag(once, "y")) == [(1, "a"), (2, None), (3, "x")]


def test_gates_at_their_bounds(spark):
    df = spark.createDataFrame([(i, "x" if i < 8 else None) for i in range(10)], "id int, c string")
    gates = lambda least: [quality.at_least("rows", 10), quality.coverage("c", F.col("c"), least), quality.unique("id", F.col("id"))]
    assert quality.require(df, gates(80.0)) == []
    assert quality.require(df, gates(80.1), strict=False) == ["c=80.0"]
    with pytest.raises(quality.GateError):
        quality.require(df, gates(90))
    assert set(quality.require(df.limit(0), gates(1), strict=False)) == {"rows=0.0", "c=None"}


def test_rankings_break_ties(spark):
    df = spark.createDataFrame([("g", 1, 5), ("g", 2, 5), ("g", 3, None), ("h", 4, 1)], "g string, id int, v int")
    assert rows(ranking.top_n(df, ["g"], [F.desc_nulls_last("v"), F.asc("id")], 2).select("g", "id", "rank")) == [("g", 1, 1), ("g", 2, 2), ("h", 4, 1)]
    assert rows(ranking.counted_ids(df, "g", [F.col("id")]).select("id", "uid")) == [(1, "g"), (2, "g_2"), (3, "g_3"), (4, "h")]
    assert rows(ranking.sample(df, "id", 2)) == rows(ranking.sample(df.repartition(3), "id", 2))


def test_candidates_and_routes(spark):
    q = spark.createDataFrame([("q1", "Juan Perez Garcia", "2000-01-01", None, "X", 1), ("q2", "Juan Perez Garcia", None, None, "Y", 2), ("q3", "Nobody Known", None, None, None, 3)], "q_id string, name string, born string, club string, nationality string, q_ord int")
    b = spark.createDataFrame([("b1", 1, "Juan Perez Garcia", "2000-01-01", None, "X"), ("b2", 2, "Perez Lopez", None, None, None)], "b_id string, b_ord int, name string, born string, club string, nationality string")
    assert rows(fuzzy.candidates(q, b)) == [("q1", "b1", 3, 1), ("q1", "b2", 1, 2), ("q2", "b1", 3, 1), ("q2", "b2", 1, 2)]
    routed = fuzzy.resolve(q, b)
    assert [(r["q_id"], r["b_id"], r["route"]) for r in routed.orderBy("q_id").collect()] == [("q1", "b1", "merge"), ("q2", "b1", "review:nat_block"), ("q3", None, "new:no_candidates")]
    out = fuzzy.merged(b, routed, q, ["name", "club"])
    assert out.count() == 4


def test_candidates_of_common_words_against_brute_force(spark):
    r = random.Random(5)
    name = lambda words, most: None if r.random() < 0.03 else " ".join(r.choice(words) for _ in range(r.randint(0, most)))
    for keep, words, most in ((3, "aaa bbb ccc ddd xy", 5), (2, "aaa bbb ccc ddd eee fff", 7)):
        q, b = [(f"q{i}", name(words.split(), most)) for i in range(60)], [(f"b{i}", i % 17 if i % 13 else None, name(words.split(), most)) for i in range(120)]
        expected = []
        for q_id, x in q:
            scores = []
            for b_id, b_ord, y in b:
                xs, ys = ([w for w in (t or "").split() if len(w) >= 3] for t in (x, y))
                if shared := [w for w in xs if w in ys]:
                    scores.append((-sum(ys.count(w) for w in xs), xs.index(shared[0]), (b_ord is not None, b_ord or 0), b_id))
            expected += [(q_id, s[3], -s[0], k + 1) for k, s in enumerate(sorted(scores)[:keep])]
        assert rows(fuzzy.candidates(spark.createDataFrame(q, "q_id string, name string"), spark.createDataFrame(b, "b_id string, b_ord int, name string"), keep)) == sorted(expected, key=str)


def test_candidates_of_a_word_of_all_rows_make_no_product(spark):
    q = spark.range(3000).select(F.concat(F.lit("q"), "id").alias("q_id"), F.concat(F.lit("mateo "), F.when(F.col("id") % 2 == 0, F.concat(F.lit("silva only"), "id")).otherwise(F.concat(F.lit("own"), "id"))).alias("name"))
    b = q.select(F.concat(F.lit("b"), F.substring("q_id", 2, 9)).alias("b_id"), F.substring("q_id", 2, 9).cast("int").alias("b_ord"), "name")
    sc = spark.sparkContext

    def moved() -> int:
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = moved()
    got = fuzzy.candidates(q, b, 3).where("q_id in ('q0', 'q1', 'q2998')").collect()
    assert sorted(map(tuple, got)) == [("q0", "b0", 3, 1), ("q0", "b2", 2, 2), ("q0", "b4", 2, 3), ("q1", "b0", 1, 2), ("q1", "b1", 2, 1), ("q1", "b2", 1, 3), ("q2998", "b0", 2, 2), ("q2998", "b2", 2, 3), ("q2998", "b2998", 3, 1)]
    assert fuzzy.candidates(q, b, 3).count() == 9000
    assert moved() - before < 300_000


@pytest.mark.parametrize("sql", [
    "drop table t", "select 1; select 2", "select * from secret", "with x as (select * from secret) select * from x", "select * from t join secret on true", "insert into t select 1", "select * from t, secret",
    "select reflect('java.lang.System', 'exit') from t", "with secret as (select * from secret) select * from secret", "select k from t union all table secret", "select k from t where k in (select k from secret)", "select * from parquet.`/root`", "select k from nowhere",
])
def test_guard_rejects(spark, sql):
    df = spark.range(3).withColumnRenamed("id", "k")
    df.createOrReplaceTempView("secret")
    try:
        with pytest.raises(readonly.Rejected):
            readonly.answer(spark, sql, {"t": df})
    finally:
        spark.catalog.dropTempView("secret")


def test_guard_accepts(spark):
    df = spark.range(200).withColumnRenamed("id", "k")
    assert readonly.check("select 'drop; x' from t -- c").startswith("select")
    assert readonly.answer(spark, "with x as (select k from t) select * from x", {"t": df}).count() == readonly.MOST
    assert not spark.catalog.tableExists("t")
    assert len(readonly.rows(spark, "select count(*) c from t where k in (select k from T)", {"t": df})) == 1


def test_guard_stops_slow_answers(spark):
    df = spark.range(4_000_000_000).withColumnRenamed("id", "k")
    with pytest.raises(Exception, match="(?i)cancel"):
        readonly.rows(spark, "select count(distinct k) c from t", {"t": df}, seconds=1.0)
