import datetime as dt
import random

import pytest

from kinweave.llm.names import found, link, spellings, unlinked

RECORD = "id string, name string, name_short string, date_of_birth date, nationality string, height_cm int, city_of_birth string, ref string, word string"
PLAYER = "id string, full_legal_name string, known_as string, date_of_birth date, birth_city string, height_cm int, nationality_primary string, nicknames string, rec string, words string"


def frames(spark, records, players):
    return spark.createDataFrame([(*r, "x", "y") for r in records], RECORD), spark.createDataFrame([(*p, "x", "y") for p in players], PLAYER)


def d(text):
    return dt.date.fromisoformat(text) if text else None


def rec(id, name, short, born="1999-03-10", nation="Quirelia", height=180, city="Giloleona"):
    return (id, name, short, d(born), nation, height, city)


def ply(id, full, known, born="1999-03-10", city="Giloleona", height=180, nation="Quirelia", nick="[]"):
    return (id, full, known, d(born), city, height, nation, nick)


def run(spark, records, players):
    return {(r["player_id"], r["record_id"]) for r in found(*frames(spark, records, players)).collect()}


def osa(a, b):
    """Edits and exchanges of neighbours between two words."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y)))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[-1] = min(row[-1], rows[-2][j - 2] + 1)
        rows.append(row)
    return rows[-1][-1]


@pytest.mark.parametrize("slips", [1, 2])
def test_spelled_words_against_brute_force(spark, slips):
    """Every word within the slips is met, short ones too, but those that share no q-gram at all."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["ba", "ke", "lo", "mi", "du", "ra", "ve", "so"]) for _ in range(rng.randint(1, 7)))
    good = sorted({word() for _ in range(200)} | {"ana", "silva", "costa", "nani"})

    def slip(w):
        i, kind = rng.randrange(len(w)), rng.randrange(4)
        return [w[:i] + w[i + 1 :], w[:i] + "z" + w[i:], w[:i] + "z" + w[i + 1 :], w[:i] + w[i + 1 : i + 2] + w[i] + w[i + 2 :]][kind]

    typed = {w for w in good[:20]}
    for w in good:
        for _ in range(slips):
            w = slip(w)
        typed.add(w)
    typed = sorted(w for w in typed if len(w) > 1)
    frame = lambda words: spark.createDataFrame([(w,) for w in words], "word string")
    got = {(r["word"], r["other"]) for r in spellings(frame(typed), frame(good), slips).collect()}
    three = lambda w: {f"^{w}$"[i : i + 3] for i in range(len(w))}
    lost = lambda a, b: max(len(three(a)), len(three(b))) - len(three(a) & three(b))
    expected = {(a, b) for a in typed for b in good if osa(a, b) <= slips and three(a) & three(b)}
    assert all(lost(a, b) <= 4 * slips for a, b in expected)
    assert expected <= got
    assert all(osa(a, b) <= 2 * slips for a, b in got)
    assert len(got - expected) <= 0.05 * len(got)


def test_ways_to_type_a_name(spark):
    shorts = ["T. Gevotavín", "GEVOTAVIN", "Gevotavín, Tomás", "tomas gevtoavin", "Gevotavín T.", "Tomás", "Pulga"]
    records = [rec(str(i), "Tomás Gevotavín", s) for i, s in enumerate(shorts)]
    players = [ply("p", "Tomás Luis Gevotavín Bolavvingar", "Tomás Gevotavín", nick='[{"nickname": "Pulga"}]'), ply("q", "Hugo Binaduélar", "Hugo Binaduélar")]
    assert run(spark, records, players) == {("p", str(i)) for i in range(len(shorts))}


def test_second_family_name(spark):
    players = [ply("p", "Thiago Nenitólmar Sumondendrio", "Thiago Nenitólmar")]
    assert run(spark, [rec("1", "Thiago N. Sumondendrio", "Thiago N. Sumondendrio")], players) == {("p", "1")}


def test_twins_need_the_initial(spark):
    players = [ply("p", "Óscar Vudedegrín", "Óscar Vudedegrín"), ply("q", "Gonzalo Vudedegrín", "Gonzalo Vudedegrín")]
    records = [rec("1", "O. Vudedegrín", "O. Vudedegrín"), rec("2", "Gonzalo Vudedegrin", "Vudedegrin")]
    assert run(spark, records, players) == {("p", "1"), ("q", "2")}


def test_contradictions_and_missing_dates(spark):
    players = [ply("p", "Hugo Binaduélar", "Hugo Binaduélar", born=None)]
    assert run(spark, [rec("1", "Hugo Binaduélar", "H. Binaduélar", born="1990-05-05")], players) == {("p", "1")}
    dated = [ply("p", "Hugo Binaduélar", "Hugo Binaduélar")]
    assert run(spark, [rec("1", "Hugo Binaduélar", "H. Binaduélar", born="1990-05-05")], dated) == set()


def test_nulls_blanks_repeats_and_empty(spark):
    p = ply("p", "Hugo Binaduélar", "Hugo Binaduélar")
    records = [rec("1", "Hugo Binaduélar", None), rec(None, "Hugo Binaduélar", "Hugo Binaduélar"), ("2", None, " ", None, None, None, None), rec("3", "Hugo Binaduélar", "Binaduélar"), rec("3", "Hugo Binaduélar", "Binaduélar"), rec("4", "a" * 5_000, "b" * 5_000)]
    players = [p, p, (None,) * 8, ("q", None, None, None, None, None, None, "not json")]
    assert run(spark, records, players) == {("p", "3")}
    assert link(*frames(spark, records, players)).count() == 1
    assert run(spark, [], players) == set() and run(spark, records, []) == set()


def test_initial_with_a_slipped_or_missing_date(spark):
    """Each row meets its player by an initial and a swapped date, a wrong day, a missing date; or by a short given name."""
    players = [ply("p", "Hugo Binaduélar", "Hugo Binaduélar"), ply("q", "Tomás Gevotavín", "Tomás Gevotavín"), ply("r", "Oliver Stelimbeth", "Oliver Stelimbeth"), ply("s", "Noé Dindamund", "Noé Dindamund")]
    records = [
        rec("1", "H. Binaduélar", "H. Binaduélar", born="1999-10-03", nation="Else", city="Else"), rec("2", "T. Gevotavín", "T. Gevotavín", born="1999-03-11", city="Else"),
        rec("3", "O. Stelimbeth", "O. Stelimbeth", born=None), rec("4", "Noé Dindamund", "Noé Dindamund", born="1998-03-10", height=181, nation="Else", city="Else"),
    ]
    assert run(spark, records, players) == {("p", "1"), ("q", "2"), ("r", "3"), ("s", "4")}


def test_references_that_share_a_key_are_told_apart(spark):
    """Two references of one family name, date and place: the given name decides; without it the row is reported as tied."""
    players = [ply("p", "Hugo Binaduélar", "Hugo Binaduélar"), ply("q", "Tomás Binaduélar", "Tomás Binaduélar")]
    records = [rec("1", "Tomás Binaduélar", "T. Binaduélar"), rec("2", "Binaduélar", "Binaduélar"), rec("3", "Hugo Zzz", "Zzz")]
    assert run(spark, records, players) == {("q", "1")}
    assert {(r["record_id"], r["reason"]) for r in unlinked(*frames(spark, records, players)).collect()} == {("2", "several"), ("3", "none")}


def test_short_and_doubly_misspelt_words(spark):
    players = [ply("p", "Ana Silva", "Ana Silva"), ply("q", "Rui Costa", "Rui Costa")]
    assert run(spark, [rec("1", "Ana Sliva", "A. Sliva"), rec("2", "Rui Cotsa", "Costaa")], players) == {("p", "1"), ("q", "2")}


def test_somebody_elses_nickname(spark):
    """A nickname that fits leads nowhere if the row's long name is another person's."""
    players = [ply("p", "Tomás Gevotavín", "Tomás Gevotavín", nick='[{"nickname": "Zito"}]')]
    assert run(spark, [rec("1", "Hugo Binaduélar", "Zito"), rec("2", "T. Gevotavín", "Zito")], players) == {("p", "2")}
