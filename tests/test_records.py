from pyspark.sql import functions as F

from kinweave.operators import records


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_lookup_takes_the_first_hit(spark):
    r = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, "z")], "id int, slug string, alt string")
    t = spark.createDataFrame([("a", 1), ("y", 2), ("y", 1), ("x", 9)], "k string, v int")
    assert rows(records.lookup(r, t, "k", ["slug", "alt"], ["v"], "v")) == [(1, "a", "x", 1), (2, "b", "y", 2), (3, None, "z", None)]


def test_name_rules(spark):
    df = spark.createDataFrame([("José Pérez", "Perez"), ("Al Li", "Bo Li"), ("X Yz Abc", "Q Abc"), ("Ann", "Bob"), ("", "Bob")], "a string, b string")
    assert [r[0] for r in df.select(records.names_match(F.col("a"), F.col("b"))).collect()] == [True, False, True, False, False]
    teams = spark.createDataFrame([("T", "José Pérez")], "team string, name string")
    listed = spark.createDataFrame([("T", "Perez", 2), ("T", "J Pérez", 1), ("U", "José Pérez", 0)], "team string, other string, ord int")
    assert rows(records.first_match(teams, listed, "team", "name", "other", F.col("ord"))) == [("T", "José Pérez", "J Pérez", 1)]


def test_plausible(spark):
    df = spark.createDataFrame([("Spain", ["Kingdom of Spain"]), ("Peru", ["Chile", None]), (None, ["x"]), ("x", None), ("Peru", ["Chile"])], "v string, a array<string>")
    assert [r[0] for r in df.select(records.plausible(F.col("v"), F.col("a"))).collect()] == [True, True, True, True, False]


def test_search_prefers_exact(spark):
    df = spark.createDataFrame([(1, "Zoé Ann"), (2, "ZOE"), (3, "Bo")], "id int, name string")
    assert [r["id"] for r in records.search(df, "zoë", ["name"], [F.col("id")]).collect()] == [2, 1]


def test_paths_and_presence(spark):
    df = spark.createDataFrame([("e", ("A", 1)), ("f", ("B", 2))], "k string, career struct<club:string,n:int>")
    resolved = spark.createDataFrame([("e", "club", None), ("f", "other", "x")], "k string, field string, value string")
    assert [(r["k"], r["career"]["club"], r["career"]["n"]) for r in records.apply_paths(df, resolved, "k", {"club": "career.club"}).orderBy("k").collect()] == [("e", None, 1), ("f", "B", 2)]


def test_lists_of_any_shape(spark):
    df = spark.createDataFrame([('[{"nickname": "A"}, "B", 3, {"x": 1}]',), ('{"nickname": "C"}',), ('"D"',), ("[",), (None,), ("[]",)], "t string")
    assert [r[0] for r in df.select(records.as_list(F.col("t"), "nickname")).collect()] == [["A", "B"], ["C"], ["D"], None, None, []]


def test_golden_and_live(spark):
    i = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    c = spark.createDataFrame([("a", "X"), ("a", "W")], "k string, club string")
    assert [(r["k"], r["career"]["club"]) for r in records.golden(i, {"career": (c, ["club"], "club")}, "k").orderBy("k").collect()] == [("a", "X"), ("b", None)]
    known = spark.createDataFrame([("a", "X", "p", 180), ("b", "Y", None, 170), ("c", "Z", None, 160)], "k string, club string, photo string, h int")
    live = spark.createDataFrame([("a", "X", None, 300), ("b", "Q", "new", 175)], "k string, club string, photo string, h int")
    assert rows(records.live_changes(known, live, "k", ["club"], ["photo"], "h")) == [("a", "X", "p", 180, "no_changes"), ("b", "Q", "new", 175, "updated"), ("c", "Z", None, 160, "not_found")]
