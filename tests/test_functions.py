import pytest
from pyspark.sql import functions as F

from kinweave.functions import metrics, nulls, parse, text


def one(spark, expr, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(expr(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()[0]


@pytest.mark.parametrize(("f", "value", "expected"), [
    (text.strip_accents, "Muñoz Čech ő ű À ø", "Munoz Cech o u A ø"), (text.strip_accents_ref, "ñ ç š ž ù ú ý À ő ű", "y n c s o u u u z o"), (text.transliterate, "ß ø Æsir ı", "ss o AEsir i"),
    (text.matcher_name, " Jean-Luc O'Brien ", "jean luc obrien"), (text.canonical_name, "Søren  D'Été-X", "sren dete-x"), (text.combined_name, "Été  d'Or.", "ete d'or."), (text.slug, " Été d'Or! ", "ete-d-or"),
    (text.last_token, "a b ", ""), (text.last_token, "a b", "b"), (text.search_name, "é-b", None), (text.search_name, "Étés x", "Etes x"), (text.foot, " LEFT ", "Left"), (text.foot, "none", None),
    (text.sql_literal, "O'Neil", "'O''Neil'"), (text.sql_literal, " ", "NULL"), (text.sql_literal, "NaN", "NULL"), (text.script_escape, 'a"\\', 'a\\"\\\\'), (text.normal_club, "Arbon FC ", "arbon"),
    (parse.contract_day, "2025", "2025-06-30"), (parse.contract_day, "June 2025", "2025-06-28"), (parse.contract_day, "2025-01-31", "2025-01-31"), (parse.contract_day, "soon", None),
    (parse.height, "1.81 m", 181), (parse.height, "1.8 m", 108), (parse.height, "181 cm", 181), (parse.height, "99", None), (parse.height, "250", None), (parse.height, "100", None), (parse.height, "249", 249), (parse.height, "180.5", 180), (parse.height, "99 cm", 99), (parse.height, "181 cm (x)", 181), (parse.height, "1,81m", 181), (parse.height, "tall", None),
    (parse.contract_day, "30 June 2025", "2025-06-28"), (parse.contract_day, "until MAY 2027", "2027-05-28"), (parse.contract_day, "June", None),
])
def test_text_functions(spark, f, value, expected):
    assert one(spark, f, value) == expected


@pytest.mark.parametrize(("value", "merge", "push", "literal"), [
    ("€30M", 30_000_000, 30_000_000, 30_000_000), ("€500K", 500_000, 500_000, None), ("1 billion", 1_000_000_000, 1_000_000_000, 1_000_000_000), ("30 million", 30_000_000, 30_000_000, 30_000_000),
    ("", None, None, None), ("N/A", None, None, None), ("0", 0, 0, 0), ("1 bn", None, None, None), ("ca. 30M", None, None, None), ("180.5", 180, 180, 180), ("99 cm", None, None, None), ("-5", -5, -5, -5), ("2b", 2_000_000_000, 2_000_000_000, 2_000_000_000), ("1.5k", 1500, 1500, None), ("1,500,000", 1_500_000, 1_500_000, 1_500_000),
])
def test_money_variants(spark, value, merge, push, literal):
    assert tuple(one(spark, lambda c, v=v: parse.money(c, v), value) for v in ("merge", "push", "literal")) == (merge, push, literal)


def test_fee(spark):
    got = [one(spark, lambda c: parse.fee(c.cast("double")), v) for v in ("250000", "1250000", "35000000", "500", "0")]
    assert got == ["€250K", "€1.2M", "€35.0M", "€500", ""]


def test_age(spark):
    assert [one(spark, lambda c: parse.age_at(c.cast("date")), v) for v in ("2000-06-11", "2000-06-12", "2004-02-29")] == [26, 25, 22]


def test_reasons_and_names(spark):
    assert one(spark, lambda c: text.append_reason(c, F.lit("b")), "a") == "a; b"
    assert one(spark, lambda c: text.append_reason(c, F.lit("b")), None) == "b"
    assert one(spark, lambda c: text.remove_reason(c, "x"), "a; x; b") == "a; b"
    assert one(spark, lambda c: text.remove_reason(c, "x"), "x") is None
    assert one(spark, text.longer_name, "A B", "A B C") == "A B C"
    assert one(spark, text.longer_name, None, "A") == "A"
    assert one(spark, text.club_words, "Real F.C. de Arbon-Süd") == ["arbon", "sud"]
    assert one(spark, lambda c: text.sql_array(F.array(c).cast("array<string>")), None) == "'{}'"


def test_comparable_values(spark):
    cases = [("date_of_birth", "2000-01-02T00:00", "2000-01-02"), ("date_of_birth", "2000", None), ("market_value_eur", "1,500,000.9", "1500000"), ("height_cm", "tall", None), ("career_trajectory", "x", None), ("current_club", "Man City F.C.", "manchester city"), ("current_club", " ", None), ("position", "Left Winger", "fwd"), ("position", "Libero", "libero"), ("agent", " Bob ", "bob")]
    df = spark.createDataFrame(cases, "f string, v string, e string")
    assert [r for r in df.select("f", "v", "e", text.comparable(F.col("f"), F.col("v")).alias("x")).collect() if r["x"] != r["e"]] == []
    assert one(spark, lambda c: text.recode(c, text.COUNTRIES), "USA") == "United States"


def test_missing_values(spark):
    assert [one(spark, lambda c, p=p: nulls.null_if_sentinel(c, p), v) for v, p in (("N/A", "merge"), ("x", "merge"), ("NULL", "verified_new"), ("inf", "literal"), ("", "ingest"))] == [None, "x", None, None, ""]
    assert one(spark, nulls.present, " null ") is False


def test_ratios():
    assert metrics.ratio("abcd", "abcd") == 100 and metrics.ratio("abcd", "abed") == 75 and metrics.ratio("", "") == 100
    assert metrics.token_sort("fc barca", "barca fc") == 100
    assert metrics.token_set("vinicius", "vinicius tobias") == 100
    assert metrics.partial("messi", "lionel messi") == 100


def test_longest_common_subsequence_against_table():
    import random

    rng = random.Random(3)
    for _ in range(100):
        a, b = ("".join(rng.choices("abcd", k=rng.randint(0, 12))) for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                t[i][j] = t[i - 1][j - 1] + 1 if x == y else max(t[i - 1][j], t[i][j - 1])
        assert metrics._lcs(a, b) == t[-1][-1]


@pytest.mark.parametrize(("a", "b", "expected"), [
    (("juan perez garcia", "2000-01-01", None, None), ("juan perez garcia", "2000-01-01", None, None), (100, "name=100|dob_exact")),
    (("juan perez garcia", "2000-01-01", None, None), ("juan perez garcia", "2001-01-01", None, None), (80, "name=100|dob_mismatch")),
    (("juan perez garcia", None, None, "X"), ("juan perez garcia", None, None, "Y"), (90, "name=100|nat_mismatch")),
    (("pele", None, None, None), ("pele", None, None, None), (75, "name=100|generic_name|capped_generic")), (("pele", None, None, "X"), ("pele", None, None, "Y"), (65, "name=100|generic_name|nat_mismatch_generic|capped_generic")),
    (("maxwell", None, "cruzeiro", "brazil"), ("maxwell", None, "cruzeiro", "ivory coast"), (65, "name=100|generic_name|club=100|nat_mismatch_generic|capped_generic")), (("joao silva", "2000-01-01", "santos", "brazil"), ("joao silva", "1999-01-01", "gremio", "brazil"), (80, "name=100|dob_mismatch|nat_match")),
    (("aaaa bbbb", None, None, None), ("xxxx yyyy", None, None, None), (0, "name_too_different")), ((None, None, None, None), ("x", None, None, None), (0, "name_too_different")),
])
def test_pair_score(a, b, expected):
    assert metrics.pair_score(a, b) == expected
