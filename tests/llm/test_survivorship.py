from kinweave.llm.survivorship import found, profile_survivors

SCHEMA = "profile_id string, tm_id string, apif_id string, source_records string, current_club string, market_value_eur long, data_confidence string, updated_at string, group_id string, k int"


def staged(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).withColumn("updated_at", __import__("pyspark.sql.functions").sql.functions.to_timestamp("updated_at"))


def run(spark, rows):
    return {(r["group_id"], r["field"]): r["profile_id"] for r in found(staged(spark, rows)).collect()}


def test_confidence_then_time_then_id(spark):
    rows = [
        ("P1", "7", None, None, "Old FC", 5, "partial", "2024-01-01"),
        ("P2", "7", None, None, "New FC", None, " Verified ", "2023-01-01"),
        ("P3", None, "apif_9", "TM:7 + APIF:9", "-", 0, "VERIFIED", "2025-01-01"),
        ("P4", None, None, "apif:apif_9", "Last FC", 3, "PARTIAL", "2024-01-01"),
    ]
    assert run(spark, rows) == {("P1", "current_club"): "P2", ("P1", "market_value_eur"): "P1"}


def test_later_row_wins_and_null_time_is_oldest(spark):
    rows = [("P1", "7", None, None, "A", 1, None, None), ("P2", "7", None, None, "B", 1, None, "2020-01-01"), ("P3", "7", None, None, None, 2, None, "2021-01-01")]
    assert run(spark, rows) == {("P1", "current_club"): "P2", ("P1", "market_value_eur"): "P3"}


def test_singles_placeholders_repeats_and_nulls(spark):
    rows = [
        ("P1", "1", None, None, "A", 1, "VERIFIED", "2020-01-01"), ("P1", "1", None, None, "A", 1, "VERIFIED", "2020-01-01"),
        ("P2", "2", None, None, "unknown", -1, "ORPHAN", "2020-01-01"), ("P3", "2", None, None, "N/A", 0, "ORPHAN", "2020-01-01"),
        (None, "1", None, None, "B", 1, "VERIFIED", "2030-01-01"), ("P4", None, None, None, "C", 1, None, None),
    ]
    assert run(spark, rows) == {}


def test_written_ways_of_sources(spark):
    ways = ["TM:5", "tm: #5", "TM #5", "tm:#5;", "APIF:apif_6 + TM:5", "TM:5, APIF:apif_6", "TM: 5 | APIF: 6", "tm:5+apif:6"]
    rows = [(f"P{i}", None, None, w, "A", 1, "ORPHAN", "2020-01-01") for i, w in enumerate(ways)]
    assert run(spark, rows) == {("P0", "current_club"): "P0", ("P0", "market_value_eur"): "P0"}


def test_values_come_along(spark):
    best = profile_survivors(staged(spark, [("P1", "7", None, None, "A", 1, None, None), ("P2", "7", None, None, "B", 9, "VERIFIED", None)]), ["current_club"]).collect()
    assert [(r["group_id"], r["current_club"]["key"], r["current_club"]["value"]) for r in best] == [("P1", "P2", "B")]


def test_empty(spark):
    assert run(spark, []) == {}
