import pytest
from pyspark.sql import functions as F

from kinweave.operators.quality import at_least
from kinweave.plans.pipeline import Run, Stage
from kinweave.sources import files, literals, sinks
from kinweave.streaming import live


def test_squad_literals(spark):
    source = 'export const SQUADS = {\n  // the first\n  ARG: [\n    { name: "Ann \\"A\\" One", number: 10, position: "FW", club: "X", age: 20, captain: true },\n    { name: "Bo Two", position: "GK" },\n  ],\n  BRA: [ { name: "Cy", number: 1 } ],\n};'
    df = spark.createDataFrame([(source,)], "text string")
    got = [tuple(r) for r in literals.squads(df).orderBy("team", "pos").collect()]
    assert got == [("ARG", 0, 'Ann "A" One', 10, "FW", "X", 20, True), ("ARG", 1, "Bo Two", None, "GK", None, None, False), ("BRA", 0, "Cy", 1, None, None, None, False)]


def test_bio_literals_last_file_wins(spark):
    a = 'const B = { "ann": { height: "1.81 m", intlCaps: 10, previousClubs: ["X", "Y {z}"] }, "bo": { foot: "Left" } }'
    b = '"ann": { height: "1.82 m", marketValue: "€80M" }'
    df = spark.createDataFrame([(1, a), (2, b)], "rank int, text string")
    got = {r["slug"]: (r["height"], r["caps"], r["value"], r["clubs"]) for r in literals.bios(df, F.col("rank")).collect()}
    assert got == {"ann": ("1.82 m", None, "€80M", None), "bo": (None, None, None, None)}


def test_generated_source_reads_back(spark):
    df = spark.createDataFrame([("ARG", 'A "q" B', 9, "FW", False), ("ARG", "C", 4, "GK", True)], "team string, name string, number int, position string, captain boolean")
    back = literals.squads(sinks.squad_source(df).select("text")).orderBy("pos").collect()
    assert [(r["name"], r["number"], r["captain"]) for r in back] == [("C", 4, True), ('A "q" B', 9, False)]


def test_csv_and_optional(spark, tmp_path):
    p = tmp_path / "players.csv"
    header = ",".join(c.split()[0] for c in files.PLAYERS_CSV.split(", "))
    p.write_text(header + "\n" + '1,A,B,"A, B",2000-01-02 00:00:00,X,,,Attack,,left,180.0,7.0,Club,L1,1500000.9,,,,,2026-06-30 00:00:00\n' + "2,A,B,AB,,,,,,,,,,,,,,,,,\n")
    got = files.active_players(spark, str(p)).collect()
    assert [(r["source_id"], r["name"], r["date_of_birth"], r["height_cm"], r["market_value_eur"], r["contract_expires"]) for r in got] == [("1", "A, B", "2000-01-02", 180, 1500000, "2026-06-30")]
    assert files.optional(spark, str(tmp_path / "none"), "a int, b string").count() == 0


def test_versions_roll_back(spark, tmp_path):
    v = sinks.Versions(spark, f"file://{tmp_path}/t")
    assert v.list() == [] and v.current() is None
    v.publish(spark.range(3))
    v.publish(spark.range(5))
    assert v.list() == [1, 2] and v.read().count() == 5
    v.point(1)
    assert v.read().count() == 3
    with pytest.raises(ValueError):
        v.point(9)


def test_seed_lines(spark):
    df = spark.createDataFrame([(2, "O'Neil", ["a'b"], None), (1, None, None, True)], "k int, n string, t array<string>, f boolean")
    lines = [r["line"] for r in sinks.insert_lines(df, "x", [F.col("k")]).collect()]
    assert lines == ["INSERT INTO x (k, n, t, f) VALUES (1, NULL, '{}', true) ON CONFLICT DO NOTHING;", "INSERT INTO x (k, n, t, f) VALUES (2, 'O''Neil', ARRAY['a''b'], NULL) ON CONFLICT DO NOTHING;"]


def test_stream_resumes(spark, tmp_path):
    schema = "k long, at long, v string"
    write = lambda rows, n: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run = lambda: sorted(map(tuple, live.replace_each_batch(spark, f"{tmp_path}/in", schema, "k", ["at"], ["v"], f"{tmp_path}/state", f"{tmp_path}/cp").select("k", "v").collect()))
    write([(1, 1, "a"), (2, 5, "b")], 0)
    assert run() == [(1, "a"), (2, "b")]
    write([(1, 2, "c"), (2, 4, "old"), (3, 1, "d")], 1)
    assert run() == [(1, "c"), (2, "b"), (3, "d")]
    assert run() == [(1, "c"), (2, "b"), (3, "d")]


def test_stages_resume_and_stop(spark, tmp_path):
    from kinweave.operators.quality import GateError

    store = lambda name: sinks.Versions(spark, f"file://{tmp_path}/{name}")
    stages = [Stage("ingest", (), lambda: spark.range(4)), Stage("filter", ("ingest",), lambda df: df.where("id > 1"), [at_least("rows", 2)]), Stage("strict", ("filter",), lambda df: df, [at_least("rows", 3)])]
    with pytest.raises(GateError):
        Run(stages, store).execute()
    stages[2].strict = False
    assert Run(stages, store).execute("filter") == {"filter": [], "strict": ["rows=2.0"]}
    with pytest.raises(ValueError):
        Run(stages, store).execute("none")
