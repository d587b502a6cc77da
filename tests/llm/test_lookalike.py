import itertools

from hypothesis import given, settings
from hypothesis import strategies as st

from kinweave.llm.lookalike import canonical, caseless, clean, pairs, repaired, shape


def test_encodings():
    assert clean("Ｆｕｌｌ ｗｉｄｔｈ，　ﬁn") == "Full width, fin"
    assert clean(" a​­b⁠ \r\n\t c ") == "ab c"
    assert clean("José") == "José"
    assert clean("x² ½") == "x² ½"


def test_repair_needs_a_dominant_script():
    assert repaired("сlub") == "club"
    assert repaired("гoл") == "гол"
    assert repaired("club") is None
    assert repaired("жclub") is None


def test_case_and_look_alikes_together():
    assert caseless("НELMILDEBØ") == caseless("helmildebø")
    assert caseless("İLKER Işık") == caseless("ilker ışık")


@given(st.text(max_size=40))
@settings(max_examples=200, deadline=None)
def test_clean_and_shape_are_idempotent(text):
    once = clean(text)
    assert clean(once) == once
    assert shape(shape(once)) == shape(once)


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, token string")


def test_canonical_uses_the_corpus(spark):
    got = {r["doc_id"]: r["text"] for r in canonical(docs(spark, ["the clubs meet", "tһe сlubs", "zеbrа", None, "", "матч", "мaтч"])).collect()}
    assert got == {0: "the clubs meet", 1: "the clubs", 2: "zеbrа", 3: None, 4: "", 5: "матч", 6: "матч"}


def test_pairs_against_brute_force(spark):
    texts = ["Same text here", "Same text  here", "Same text here", "Sаme text here", "same text here", "Same text, here", "а", "a", None, "", "  ", "o" * 30_000, "о" + "o" * 29_999]
    expected = {(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(texts), 2) if a is not None and b is not None and a != b and shape(clean(a)) == shape(clean(b))}
    got = [(r[0], r[1]) for r in pairs(docs(spark, texts), block=2).collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_empty(spark):
    assert pairs(docs(spark, [])).count() == 0
