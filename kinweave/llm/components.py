"""Pairwise matches consolidated into groups: connected components on a two-dimensional grid.

Vertices are hashed into B blocks, so an edge falls into one cell of the B x B grid (the upper triangle: edges have no
direction). Each cell runs union-find over its own edges and reports every vertex with the smallest vertex it is linked to
there. Rows and columns of the grid then exchange these representatives: one aggregation by vertex keeps the smallest as
its parent and links the others to that parent. The links are the edges of the next, smaller grid; when none are left, the
parents of all rounds are followed down to the component's smallest vertex.

A hub's edges spread over the B cells of its row and column, so neither a vertex nor a component is ever gathered in one
task; a cell's size is bounded by the choice of B, which follows the number of edges.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.storage import Written

#: Edges that one cell of the grid should hold.
CELL_EDGES = 400_000


def union_find(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest vertex linked to each of n vertices by the edges a-b: roots are hooked onto smaller roots and paths
    halved until nothing moves. Vectorised union-find, O(log n) sweeps."""
    parent = np.arange(n, dtype=np.int64)
    while True:
        ra, rb = parent[a], parent[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        open_ = low != high
        if not open_.any():
            return parent
        a, b = a[open_], b[open_]
        np.minimum.at(parent, high[open_], low[open_])
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up


def _cell(table: pa.Table) -> pa.Table:
    """(id, rep) of a cell's vertices: their smallest linked vertex."""
    n = table.num_rows
    both = pa.chunked_array([*table.column("a").chunks, *table.column("b").chunks]).combine_chunks().dictionary_encode()
    if isinstance(both, pa.ChunkedArray):
        both = both.combine_chunks()
    names, codes = both.dictionary, both.indices.to_numpy(zero_copy_only=False)
    order = pc.sort_indices(names).to_numpy()
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    ranks = rank[codes]
    root = union_find(ranks[:n], ranks[n:], len(order))
    ordered = names.take(pa.array(order))
    return pa.table({"id": ordered, "rep": ordered.take(pa.array(root))})


def _blocks(edges: int, cell_edges: int, least: int) -> int:
    return max(least, math.ceil(math.sqrt(2 * edges / cell_edges)))


def components(edges: DataFrame, a: str = "a", b: str = "b", cell_edges: int = CELL_EDGES, blocks: int = 4) -> DataFrame:
    """(id, group_id): one row for each distinct vertex of the pairs; group_id is the smallest id, as a string, of all
    vertices linked with it directly or indirectly.

    A pair whose one side is null makes the other a vertex of its own; two nulls give nothing. Repeated pairs, loops and
    either direction are the same. Blank ids are ids. Other columns are ignored. An empty table gives an empty result.
    `blocks` is the least number of blocks of the first grid; the rounds' tables are written to the shared folder.
    """
    x, y = F.coalesce(F.col(a), F.col(b)).cast("string"), F.coalesce(F.col(b), F.col(a)).cast("string")
    pairs = edges.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).where("a is not null").distinct()
    levels: list[DataFrame] = []
    first, edge_count = Written(pairs, "edges"), None
    current = first
    while True:
        edge_count = current.df.count()
        if not edge_count and levels:
            break
        size = _blocks(edge_count, cell_edges, blocks if not levels else 1)
        block = lambda c: F.pmod(F.xxhash64(c, F.lit(len(levels))), F.lit(size))  # noqa: B023, E731
        placed = current.df.select("a", "b", block("a").alias("i"), block("b").alias("j"))
        placed = placed.select("a", "b", (F.least("i", "j") * size + F.greatest("i", "j")).alias("cell"))
        local = placed.groupBy("cell").applyInArrow(lambda t: _cell(t), "id string, rep string")
        # at most one representative a cell, so the set has at most `size` members
        exchanged = local.groupBy("id").agg(F.min("rep").alias("parent"), F.collect_set("rep").alias("reps"))
        level = Written(exchanged.select("id", "parent", F.expr("filter(reps, r -> r <> parent)").alias("reps")), "parents")
        levels.append(level.df)
        links = level.df.where("size(reps) > 0").select(F.col("parent").alias("a"), F.explode("reps").alias("b")).distinct()
        after = Written(links, "links")
        current.drop()
        current = after
    current.drop()
    label = levels[-1].select("id", F.col("parent").alias("group_id"))
    for level in reversed(levels[:-1]):
        up = label.select(F.col("id").alias("parent"), "group_id")
        label = level.select("id", "parent").join(up, "parent", "left").select("id", F.coalesce("group_id", "parent").alias("group_id"))
    return label


def found(pairs: DataFrame) -> DataFrame:
    """(record_id, group_id) of the quarantined pairs: ids trimmed and in lower case, a blank id is no record."""
    clean = lambda c: F.expr(f"nullif(lower(trim(both ' \t\r\n ' from {c})), '')")
    edges = pairs.select(clean("tm_id").alias("a"), clean("apif_id").alias("b"))
    return components(edges).select(F.col("id").alias("record_id"), "group_id")
