import json

from hypothesis import given, settings
from hypothesis import strategies as st

from kinweave.operators import shred

CAREER = "player_id string, career_trajectory string, updated_at string, node string, field string"
CUP = "player_id string, clutch_moments string, previous_wc_appearances string, updated_at string"


def paths(text):
    return [n[0] for n in shred.nodes(text) if n[4] == "object"]


def test_paths():
    assert paths('[{"a": 1}, "x", null, {"s": [{"c": "[{\\"d\\": 1}, 2, {}]"}, 5, {}]}]') == ["0", "3", "3.s.0", "3.s.2", "3.s.0.c.0", "3.s.0.c.2"]
    assert paths('{"s": {"t": {}}}') == ["0", "0.s.0", "0.s.0.t.0"]
    assert paths(json.dumps(json.dumps([{"a": 1}]))) == ["0"]
    assert paths('["{\\"a\\": 1}"]') == ["0"]
    assert paths(None) == paths("") == paths("[") == paths("[{") == paths('"x"') == paths("7") == paths("[]") == []
    assert paths("[" * 100_000) == []


def objects(value, path, out):
    for i, x in enumerate(value if isinstance(value, list) else [value]):
        if isinstance(x, dict):
            out.append(p := f"{path}{i}")
            for k, v in x.items():
                if isinstance(v, (dict, list)):
                    objects(v, f"{p}.{k}.", out)
    return out


_plain = st.recursive(st.none() | st.integers(), lambda x: st.lists(x.filter(lambda v: not isinstance(v, list)), max_size=3) | st.dictionaries(st.sampled_from("abc"), x, max_size=3), max_leaves=12)


@given(_plain)
@settings(max_examples=200, deadline=None)
def test_every_object_once(value):
    expected = objects(value, "", []) if isinstance(value, (dict, list)) else []
    assert sorted(paths(json.dumps(value))) == sorted(expected)


def test_found_takes_the_latest_row(spark):
    from pyspark.sql import functions as F

    career = spark.createDataFrame([("p", '[{"a": 1}]', "2024-01-01", "x", "y"), ("p", '[{}, {"s": [{}]}]', "2025-01-01", "x", "y"), ("p", '[{}, {"s": [{}]}]', "2025-01-01", "x", "y"), ("p", "[{}]", None, "x", "y"), ("q", None, "2024-01-01", "x", "y"), (None, "[{}]", "2024-01-01", "x", "y")], CAREER).withColumn("updated_at", F.to_timestamp("updated_at"))
    cup = spark.createDataFrame([("p", "{}", "nonsense", "2024-01-01")], CUP).withColumn("updated_at", F.to_timestamp("updated_at"))
    got = sorted(map(tuple, shred.found(career, cup).collect()))
    assert got == [("p", "career_trajectory", "0"), ("p", "career_trajectory", "1"), ("p", "career_trajectory", "1.s.0"), ("p", "clutch_moments", "0")]
    assert shred.found(career.limit(0), cup.limit(0)).count() == 0


def test_entity_tables_round_trip(spark):
    value = [{"club": "A", "goals": 3, "seasons": [{"season": "1", "x": None}, {"season": "2"}]}, {"club": "B", "seasons": {"season": "3"}}]
    df = spark.createDataFrame([(7, json.dumps(value))], "player_id long, career string")
    a = shred.entities(shred.shred(df, "player_id", ["career"]), "player_id").cache()
    tops = {r["node"]: (r["club"], r["goals"]) for r in shred.entity(a, "player_id", "career", None, ["club", "goals"]).collect()}
    assert tops == {"0": ("A", "3"), "1": ("B", None)}
    inner = {(r["parent"], r["node"], r["season"]) for r in shred.entity(a, "player_id", "career", "seasons", ["season"]).collect()}
    assert inner == {("0", "0.seasons.0", "1"), ("0", "0.seasons.1", "2"), ("1", "1.seasons.0", "3")}


def test_every_object_with_its_scalars(spark):
    value = [{"club": "A", "n": 1, "n2": [1, {"deep": {"k": "v"}}]}, "x", {}, None]
    df = spark.createDataFrame([(7, json.dumps(value)), (8, None), (9, "[")], "player_id long, career string")
    a = shred.shred(df, "player_id", ["career"])
    got = {r["node"]: (r["parent"], r["label"], r["ordinal"], r["scalars"]) for r in shred.entities(a, "player_id").collect()}
    objects = {r["node"] for r in a.where("kind = 'object'").collect()}
    assert set(got) == objects and got["0"] == (None, None, 0, {"club": "A", "n": "1"}) and got["2"][3] == {}
    assert got["0.n2.1.deep.0"] == ("0.n2.1", "deep", 0, {"k": "v"})


def test_json_text_wrapped_many_times():
    text = json.dumps([{"a": 1}])
    for _ in range(12):
        text = json.dumps(text)
    assert [n[0] for n in shred.nodes(text) if n[4] == "object"] == ["0"]
