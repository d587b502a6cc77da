import itertools
import random

import pytest

from kinweave.llm.mixing import Target, budgets, fit, knapsack, mix, token_counts


def total(taken):
    return sum(s * m for s, m in taken.items())


def test_knapsack_against_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        counts = {rng.randint(1, 15): rng.randint(1, 3) for _ in range(3)}
        budget = rng.randint(0, 60)
        sums = {sum(s * m for s, m in zip(counts, ms)) for ms in itertools.product(*(range(m + 1) for m in counts.values()))}
        taken = knapsack(counts, budget)
        assert all(0 <= m <= counts[s] for s, m in taken.items())
        assert abs(total(taken) - budget) == min(abs(x - budget) for x in sums)


def test_fit_hits_the_budget():
    rng = random.Random(2)
    counts = {rng.randint(20, 900): rng.randint(1, 40) for _ in range(300)}
    available = total(counts)
    for share in (0.0, 0.1, 0.37, 0.9, 1.0, 1.5):
        taken = fit(counts, int(available * share))
        assert all(0 <= m <= counts[s] for s, m in taken.items())
        assert total(taken) == min(available, int(available * share))
    big = fit(counts, available // 3, limit=5_000)
    assert total(big) == available // 3


def test_no_lengths_are_preferred():
    """Many lengths of one document each, more left over than the knapsack takes: short and long ones are chosen alike."""
    counts = {s: 1 for s in range(200, 4_000)}
    taken = fit(counts, total(counts) // 2)
    assert total(taken) == total(counts) // 2
    for low in range(200, 4_000, 950):
        part = [taken.get(s, 0) for s in range(low, min(low + 950, 4_000))]
        assert 0.4 < sum(part) / len(part) < 0.6


def test_budgets():
    got = budgets({"a": 100, "b": 50}, {"a": Target(0.5, 1), "b": Target(0.5, 4)})
    assert got == {"a": 100, "b": 100}
    lacking = budgets({"a": 100, "b": 100}, {"a": Target(0.4, 1), "b": Target(0.4, 1), "c": Target(0.2, 9)})
    assert lacking == {"a": 100, "b": 100}
    assert budgets({}, {"a": Target(1.0, 1)}) == {}


def frames(spark, docs, targets):
    return (
        spark.createDataFrame([(i, t, s, 1, 2) for i, (s, t) in enumerate(docs)], "doc_id long, text string, source string, tokens int, uses int"),
        spark.createDataFrame([(*t, 0) for t in targets], "source string, target_share double, max_repeat int, extra int"),
    )


def test_counts_whole_texts(spark):
    docs, _ = frames(spark, [(" News ", "hello world"), ("news", None), (None, ""), ("x", "a b " * 5_000)], [])
    got = {r["doc_id"]: (r["source"], r["tokens"]) for r in token_counts(docs).collect()}
    assert got[0] == ("news", 2) and got[1] == ("news", 0) and got[2] == (None, 0) and got[3][1] >= 10_000


def test_mix_reaches_shares_and_caps(spark):
    rng = random.Random(3)
    docs = [("big", "word " * rng.randint(5, 60)) for _ in range(300)] + [("Small ", "word " * rng.randint(5, 60)) for _ in range(20)] + [("other", "word")] * 5
    selection, report = mix(*frames(spark, docs, [("big", 0.6, 1), ("small", 0.3, 3), ("absent", 0.1, 5)]))
    rows = {r["source"]: r for r in report.collect()}
    assert set(rows) == {"big", "small", "absent"} and rows["absent"]["share"] == 0
    assert abs(rows["big"]["share"] - 0.65) < 0.01 and abs(rows["small"]["share"] - 0.35) < 0.01
    used = selection.collect()
    assert max(r["uses"] for r in used if r["source"] == "small") <= 3 and {r["uses"] for r in used if r["source"] == "big"} == {1}
    assert len({r["doc_id"] for r in used}) == len(used)
    assert sum(r["tokens"] * r["uses"] for r in used if r["source"] == "big") == rows["big"]["used_tokens"]


def test_same_seed_same_documents_and_large_groups(spark, monkeypatch):
    import kinweave.llm.mixing as mixing

    docs = [("a", "one two three")] * 400 + [("b", "one two three four")] * 400
    targets = [("a", 0.3, 1), ("b", 0.7, 1)]
    pick = lambda part, n: [tuple(r) for r in part(mix(frames(spark, docs, targets)[0].repartition(n), frames(spark, docs, targets)[1], total=800)[0]).collect()]
    whole = sorted(pick(lambda x: x, 2))
    monkeypatch.setattr(mixing, "RANKED", 50)
    parted = pick(lambda x: x, 5)
    assert len(parted) == len(whole) and sum(r[2] * r[3] for r in parted) == sum(r[2] * r[3] for r in whole)
    assert sorted(parted) == sorted(pick(lambda x: x, 3))


def test_empty(spark):
    selection, report = mix(*frames(spark, [], [("a", 1.0, 1)]))
    assert selection.count() == 0 and [(r["source"], r["used_tokens"], r["share"]) for r in report.collect()] == [("a", 0, 0.0)]
    selection, report = mix(*frames(spark, [("a", "x y")], []))
    assert selection.count() == 0 and report.count() == 0


@pytest.mark.parametrize("total_tokens", [1, 7, 1000])
def test_given_total(spark, total_tokens):
    _, report = mix(*frames(spark, [("a", "one two")] * 10 + [("b", "one two")] * 10, [("a", 0.5, 2), ("b", 0.5, 2)]), total=total_tokens)
    assert all(r["used_tokens"] <= r["available_tokens"] * r["max_repeat"] for r in report.collect())
