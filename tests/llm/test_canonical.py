import random

from hypothesis import given, settings
from hypothesis import strategies as st

from kinweave.llm.canonical import BKTree, Pattern, fold, found, mapped, nearest

CLUBS = ["AS Nissomeac", "Olympique Nissomeac", "FK Linelstad", "1. FC Bunalebrück", "FC Bunalebrück", "VfL Bunalebrück", "Sporting de Rosivaado", "Sporting de Donavales", "Bameladağspor", "Gunoldeton Town", "FK Diggildbø", "AS Yemedssi", "VfL Lesserningen", "Olympique Butameeuil", "Gunoldston Lions"]
TEAMS = [("Costa Lumbre", "CLU", "Costa Lumbre"), ("Republic of Costa Lumbre", "CLU", "Costa Lumbre"), ("Île-Tonnelle", "ITO", "Tonnelle Island"), ("Velichka", "VLK", "Velichka")]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i] + row[1:], row
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
@settings(max_examples=300, deadline=None)
def test_distance(a, b):
    assert Pattern(a).distance(b) == levenshtein(a, b)


def test_tree_finds_everything_in_reach():
    rng = random.Random(5)
    forms = {"".join(rng.choices("abcd", k=rng.randint(3, 9))) for _ in range(200)}
    tree = BKTree()
    for f in forms:
        tree.add(f, f)
    for _ in range(50):
        q = "".join(rng.choices("abcd", k=6))
        assert {f for _, f, _ in tree.within(q, 2)} == {f for f in forms if levenshtein(f, q) <= 2}


def tables(spark, rows):
    pairs = spark.createDataFrame([(*r, "x", 1) for r in rows], "tm_id string, apif_id string, tm_club string, apif_club string, nationality string, value string, field int")
    clubs = spark.createDataFrame([(i, c, "x") for i, c in enumerate(CLUBS)], "club_id int, name string, v string")
    return pairs, clubs, spark.createDataFrame([(*t, 1) for t in TEAMS], "nationality_value string, team_code string, team_name string, k int")


def test_typed_values(spark):
    typed = {
        "nissomeac olympique": "Olympique Nissomeac", "Olymp. Nissomeac": "Olympique Nissomeac", "Nissomeac": "NONE", "LINELSTAD": "FK Linelstad", "Linelstad F.C.": "FK Linelstad",
        "FC Bunalebrück 1.": "1. FC Bunalebrück", "vfl bunalebruck": "VfL Bunalebrück", "Sp. Donavales": "Sporting de Donavales", "Donavales de Sporting": "Sporting de Donavales", "BAMELADAG": "Bameladağspor",
        "Gunolbeton Town": "Gunoldeton Town", "Diggildbo football": "FK Diggildbø", "Sporting de Rosivaado (1)": "Sporting de Rosivaado", "Free agent": "NONE", "Old Boys Zork": "NONE", "---": "NONE",
    }
    got = {r["value"]: r["ref_key"] for r in mapped(*tables(spark, [(str(i), "a", t, None, None) for i, t in enumerate(typed)])).collect()}
    assert got == {t: "NONE" if c == "NONE" else str(CLUBS.index(c)) for t, c in typed.items()}


def test_nationalities(spark):
    typed = {"COSTA LUMBRE": "CLU", "Costa Lumbre NT": "CLU", "Rep. of Costa Lumbre": "CLU", "clu": "CLU", "Velichkan": "VLK", "vellichka": "VLK", "Tonnelle Island": "ITO", "Isla Cobre": "NONE", "SIR": "NONE"}
    got = {r["value"]: r["ref_key"] for r in mapped(*tables(spark, [(str(i), "a", None, None, t) for i, t in enumerate(typed)])).collect()}
    assert got == typed


def test_exact_blank_null_and_repeated_values(spark):
    rows = [("1", "a", "AS Nissomeac", " ", None), ("1", "a", "as nissomeac", None, "Velichka"), ("1", "a", "as nissomeac", None, "Velichka"), (None, None, "x" * 20_000, "\n", "")]
    got = {tuple(r) for r in found(*tables(spark, rows)).collect()}
    assert got == {("1", "a", "tm_club", "0"), (None, None, "tm_club", "NONE")}


def test_shards_agree_with_one_tree(spark):
    rng = random.Random(2)
    entries = ["".join(rng.choices("abcde", k=8)) for _ in range(60)]
    df = spark.createDataFrame([(e, str(i)) for i, e in enumerate(entries)], "v string, k string")
    forms = lambda t: [fold(t)]
    typed = spark.createDataFrame([(e[:3] + "z" + e[4:],) for e in entries] + [(None,), ("",)], "value string")
    one, many = nearest(typed, df, "v", "k", forms, forms), nearest(typed, df, "v", "k", forms, forms, size=15)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, many.collect()), key=str)
    assert one.where("k is not null").count() > 0


def test_ties_are_told_and_the_reach_is_a_parameter(spark):
    df = spark.createDataFrame([("abcdefgh", "1"), ("abcdefgk", "2")], "v string, k string")
    forms = lambda t: [fold(t)]
    typed = spark.createDataFrame([("abcdefgz",), ("abcdzfgh",), ("abczzzgh",)], "value string")
    for size in (20, 1):
        assert sorted(map(tuple, nearest(typed, df, "v", "k", forms, forms, size=size).collect())) == [("abcdefgz", None, True), ("abcdzfgh", "1", False), ("abczzzgh", None, False)]
    assert {tuple(r) for r in nearest(typed, df, "v", "k", forms, forms, reach=lambda t: 3).collect()} >= {("abczzzgh", "1", False)}


def test_empty(spark):
    assert found(*tables(spark, [])).count() == 0
