"""String similarity on the Indel distance: ratio, token-sort, token-set and partial ratio, whole percentages."""

from __future__ import annotations

import re
from functools import lru_cache


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, rows of a matrix as bits of one number."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    state = full = (1 << len(a)) - 1
    for c in b:
        hit = state & where.get(c, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def ratio(a: str, b: str) -> int:
    """Twice the common subsequence over both lengths."""
    return round(100 * _raw(a, b))


def _raw(a: str, b: str) -> float:
    return 2 * _lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def processed(text: str) -> str:
    return re.sub(r"[\W_]+", " ", text.lower()).strip()


def token_sort(a: str, b: str) -> int:
    return ratio(" ".join(sorted(processed(a).split())), " ".join(sorted(processed(b).split())))


def token_set(a: str, b: str) -> int:
    """100 if one name's words are all among the other's; else the best ratio among the common words and each side's rest."""
    x, y = set(processed(a).split()), set(processed(b).split())
    if not x or not y:
        return 0
    common, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if common and (not left or not right):
        return 100
    one, two = f"{common} {left}".strip(), f"{common} {right}".strip()
    scores = [_raw(one, two)] + ([_raw(common, one), _raw(common, two)] if common else [])
    return round(100 * max(scores))


def partial(a: str, b: str) -> int:
    """The best ratio of the shorter text with any window of the longer, windows cut off at the ends included."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 100 if not long else 0
    n = len(short)
    best = 0.0
    for start in range(-n + 1, len(long)):
        window = long[max(0, start) : start + n]
        if 2 * min(n, len(window)) / (n + len(window)) > best:
            best = max(best, _raw(short, window))
    return round(100 * best)


@lru_cache(maxsize=100_000)
def name_similarity(a: str, b: str) -> int:
    """0 without a name, 100 for equal ones, else the best of the three token measures."""
    if not a or not b:
        return 0
    return 100 if a == b else max(token_sort(a, b), token_set(a, b), partial(a, b))


# Points of a pair's score and the similarities they depend on.
LEAST_NAME, SAME_BORN, OTHER_BORN, CLUB_FROM, SAME_CLUB, CLUB_BELOW, OTHER_CLUB, SAME_NATION, OTHER_NATION, OTHER_NATION_GENERIC, GENERIC_CAP = 60, 15, -20, 80, 8, 40, -5, 5, -10, -35, 75


def generic(name: str) -> bool:
    """A name of one word or of at most six letters: many people bear it."""
    return len(name.split()) <= 1 or len(name) <= 6


def pair_score(a: tuple, b: tuple) -> tuple[int, str]:
    """(score, reason) of two records (name, born, club, nationality), texts already in the matcher's form. Each step clamps to
    0..100; the reason names the steps that counted, in order."""
    a, b = (tuple(x or "" for x in r) for r in (a, b))
    name = name_similarity(a[0], b[0])
    if name < LEAST_NAME:
        return 0, "name_too_different"
    score, reasons, common = name, [f"name={name}"], generic(a[0]) or generic(b[0])

    def step(points: int, reason: str | None = None) -> None:
        nonlocal score
        score = max(0, min(100, score + points))
        if reason:
            reasons.append(reason)

    if common:
        reasons.append("generic_name")
    born = [x[1][:10] for x in (a, b)]
    if all(born):
        step(*(SAME_BORN, "dob_exact") if born[0] == born[1] else (OTHER_BORN, "dob_mismatch"))
    if a[2] and b[2]:
        club = token_sort(a[2], b[2])
        if club >= CLUB_FROM:
            step(SAME_CLUB, f"club={club}")
        elif club < CLUB_BELOW:
            step(OTHER_CLUB)
    if a[3] and b[3]:
        step(*(SAME_NATION, "nat_match") if a[3] == b[3] else (OTHER_NATION_GENERIC, "nat_mismatch_generic") if common else (OTHER_NATION, "nat_mismatch"))
    if common and not {"dob_exact", "nat_match"} & set(reasons):
        score = min(score, GENERIC_CAP)
        reasons.append("capped_generic")
    return score, "|".join(reasons)
