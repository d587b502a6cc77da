import pytest

from kinweave.operators import units


@pytest.mark.parametrize(("text", "cm"), [
    ("184 cm", 184), ("1.78 m", 178), ("1,84m", 184), ("1760 mm", 176), ("1780mm", 178), ("74 inches", 188), ('67"', 170), ("72 in", 183), ("5 ft 8 in", 173), ("6ft 4", 193), ("5' 7''", 170), ("5′11″", 180),
    ("6'6\"", 198), ("1m83", 183), ("2m", 200), ("ca. 184 cm", 184), ("189", 189), ("1.88", 188), ("1,79", 179), ("174 CM", 174),
])
def test_heights(spark, text, cm):
    assert convert(spark, [text], "height") == {text: cm}


@pytest.mark.parametrize(("text", "euros"), [
    ("2650000", 2650000), ("€1.72m", 1720000), ("1.9M €", 1900000), ("£90K", 112500), ("USD 180,000", 162000), ("82 700 000 €", 82700000), ("€43'300'000", 43300000), ("1.62 mn EUR", 1620000), ("€250 thousand", 250000),
    ("€2.020.000", 2020000), ("170 Tsd. €", 170000), ("€1,02 Mio", 1020000), ("170 mil €", 170000), ("6,3 millones de euros", 6300000), ("2,27 mill. €", 2270000), ("CHF 1.27 million", 1346200), ("€120.000", 120000),
    ("€0.4M", 400000), ("270 Th. €", 270000), ("GBP 1.32m", 1650000), ("1.5 bn €", 1500000000), ("€1.234M", 1234000),
])
def test_money(spark, text, euros):
    assert convert(spark, [text], "money") == {text: euros}


def rates(spark):
    return spark.createDataFrame([("GBP", 1.25), ("USD", 0.9), ("EUR", 1.0), ("CHF", 1.06), ("EUR", 1.0), (None, 2.0)], "currency string, eur_per_unit double")


def convert(spark, texts, field):
    df = spark.createDataFrame([(t, t, 1, "x") for t in texts], "k string, t string, amount int, unit string")
    return {r["k"]: r["amount"] for r in units.convert_texts(df, ["k"], "t", field, rates(spark)).collect()}


def test_texts_without_a_quantity(spark):
    nothing = ["", " ", "-", "n/a", "unknown", "TBC", None, "0", "x" * 50_000]
    assert convert(spark, nothing, "height") == {} and convert(spark, nothing, "money") == {}
    assert convert(spark, ["SEK 100"], "money") == {}  # a currency without a rate here
    assert convert(spark, [], "money") == {}


def test_long_text_and_repeated_rows(spark):
    text = "talk " * 10_000 + "180 cm"
    df = spark.createDataFrame([("a", text)] * 3 + [("b", text)], "k string, t string")
    assert sorted(map(tuple, units.convert_texts(df, ["k"], "t", "height").collect())) == [("a", 180), ("b", 180)]


def test_staged_values(spark):
    rows = [("a", 70, 5, "needs_dob"), ("b", 1830, 440000, "valor por confirmar; mv in pounds (GBP)"), ("c", 180, 950, "height in inches; mv kEUR"), ("d", None, 4, "value in EUR confirmed; valor en millones"), ("e", -1, 0, "MV x1000"), ("f", 75, 7, "Marktwert in Tsd. EUR"), ("f", 75, 7, "Marktwert in Tsd. EUR"), ("g", 181, 9, None), (None, 70, 3, "MV in M€"), ("h", 71, 2, "value (k€)")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "profile_id string, height_cm int, market_value_eur long, curation_reason string, currency string")
    bio = spark.createDataFrame([("s", None, "£1K"), ("s", None, "£1K"), (None, "180 cm", None)], "slug string, height string, marketvalue string")
    got = {tuple(r)[1:] for r in units.found(bio, df, rates(spark)).collect()}
    assert got == {("s", "marketvalue", 1250), ("a", "height_cm", 178), ("b", "height_cm", 183), ("b", "market_value_eur", 550000), ("c", "market_value_eur", 950000), ("d", "market_value_eur", 4000000), ("f", "height_cm", 191), ("f", "market_value_eur", 7000), ("h", "height_cm", 180), ("h", "market_value_eur", 2000)}
