import numpy as np

from kinweave.llm.leakage import Items, align, found, leaks, words

ITEM = "In the year nobody remembers the old keeper walked slowly from the harbour to the empty stadium and counted every single seat twice"


def smith_waterman(a, b):
    h, best, run, longest = {}, 0, {}, 0
    for i in range(len(a)):
        for j in range(len(b)):
            same = a[i] == b[j]
            h[i, j] = max(0, h.get((i - 1, j - 1), 0) + (2 if same else -1), h.get((i - 1, j), 0) - 1, h.get((i, j - 1), 0) - 1)
            run[i, j] = run.get((i - 1, j - 1), 0) + 1 if same else 0
            best, longest = max(best, h[i, j]), max(longest, run[i, j])
    return best, longest


def test_alignment_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(40):
        a, b = rng.integers(-1, 5, rng.integers(0, 15)), rng.integers(0, 5, rng.integers(1, 12))
        assert align(a, b) == smith_waterman(list(a), list(b))


def test_words():
    assert words("It's 3-0, Ｔｅａｍ!") == ["it", "s", "3", "0", "team"]
    assert words(None) == [] and words("…") == []


def test_unknown_words_break_ngrams():
    items = Items([(1, "a b c d e f")], 5)
    assert len(items.hits(items.numbers("a b c d e"))) == 1
    assert len(items.hits(items.numbers("a b x c d e"))) == 0


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, 0, 0) for i, t in enumerate(docs)], "doc_id long, text string, k int, n int"),
        spark.createDataFrame([(i + 1, t, "g") for i, t in enumerate(items)], "item_id int, text string, g string"),
    )


def test_found(spark):
    w = ITEM.split()
    docs = [
        "Before. " + " ".join(w[3:16]) + " after", " ".join(w[3:15]) + " stop " + " ".join(w[16:]), ITEM.upper().replace(" ", " -- "), "nothing here", None, "",
        ("filler " * 20_000) + " ".join(w[:13]), " ".join(w[5:18]).replace("o", "о"),
    ]
    got = {(r[0], r[1]) for r in found(*frames(spark, docs, [ITEM, "short item", None, ITEM])).collect()}
    assert got == {(d, i) for d in (0, 2, 6, 7) for i in (1, 4)}


def test_edited_copies_are_scored(spark):
    w = ITEM.split()
    edited = " ".join(x for i, x in enumerate(w) if i % 7 != 6)
    rows = leaks(*frames(spark, [edited, "other words only"], [ITEM])).collect()
    assert [(r["doc_id"], r["run"]) for r in rows] == [(0, 6)] and rows[0]["share"] > 0.7


def test_blocks_of_items_and_empty_tables(spark):
    docs, items = frames(spark, [ITEM, "x"], [ITEM, ITEM + " more", "one two three four five six"])
    assert {(r["doc_id"], r["item_id"]) for r in leaks(docs, items, item_block=1).collect()} == {(0, 1), (0, 2)}
    assert found(*frames(spark, [], [ITEM])).count() == 0
    assert found(*frames(spark, [ITEM], [])).count() == 0
