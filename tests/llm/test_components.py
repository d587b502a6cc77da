import random

import numpy as np
import pytest

from kinweave.llm.components import components, found, union_find


def brute(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = (a, b) if a is not None and b is not None else (a or b, a or b)
        if a is None:
            continue
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def run(spark, edges, **options):
    df = spark.createDataFrame(edges, "a string, b string")
    rows = components(df, **options).collect()
    assert len({r["id"] for r in rows}) == len(rows)
    return {r["id"]: r["group_id"] for r in rows}


def test_union_find_chain():
    n = 2000
    a, b = np.arange(n - 1), np.arange(1, n)
    assert (union_find(a, b, n) == 0).all()


@pytest.mark.parametrize("blocks", [1, 3, 6])
def test_random_graph(spark, blocks):
    rng = random.Random(blocks)
    edges = [(f"v{rng.randrange(400)}", f"v{rng.randrange(400)}") for _ in range(260)]
    assert run(spark, edges, blocks=blocks) == brute(edges)


def test_long_chain_needs_several_rounds(spark):
    names = [f"{i:04d}" for i in range(300)]
    random.Random(1).shuffle(names)
    edges = list(zip(names, names[1:]))
    assert set(run(spark, edges, blocks=5, cell_edges=40).values()) == {"0000"}


def test_hub_spreads_over_cells(spark):
    edges = [("hub", f"leaf{i:04d}") for i in range(900)] + [("x", "y")]
    got = run(spark, edges, blocks=4, cell_edges=100)
    assert got == brute(edges)


def test_nulls_loops_repeats_and_directions(spark):
    edges = [("a", None), (None, "b"), (None, None), ("c", "c"), ("e", "d"), ("d", "e"), ("d", "e"), ("", "f")]
    assert run(spark, edges) == {"a": "a", "b": "b", "c": "c", "d": "d", "e": "d", "": "", "f": ""}


def test_empty(spark):
    assert run(spark, []) == {}


def test_found_cleans_ids(spark):
    df = spark.createDataFrame([(" 10 ", "APIF_2", 1), ("10", " apif_3", 2), ("11", None, 3), ("12", " ", 4)], "tm_id string, apif_id string, cell int")
    got = {r["record_id"]: r["group_id"] for r in found(df).collect()}
    assert got == {"10": "10", "apif_2": "10", "apif_3": "10", "11": "11", "12": "12"}
