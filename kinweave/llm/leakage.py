"""Evaluation passages in a training corpus.

The n-grams of the evaluation items are looked up in every document in one pass; how many documents hold each is counted
over the whole corpus. For every window of an item as long as the shortest leak, its rarest n-gram becomes a seed: a
document that holds the window holds the seed. Seeds join documents to items; each joined pair is aligned word by word
(Smith-Waterman), which decides on edited copies by the share of the item they keep, and the longest verbatim run is
measured exactly. Texts are folded by built-in functions; Python gets folded words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.llm.lookalike import caseless, caselessly, easy
from kinweave.storage import materialize

#: Words in a seed, and consecutive words that make a leak.
GRAM, RUN = 5, 13
#: The share of the best possible alignment with an item from which an edited copy counts as leaked.
SHARE = 0.5
#: Items held by each task at once; more items than this are taken in blocks, each against all documents.
ITEM_BLOCK = 20_000
_WORD = re.compile(r"[^\W_](?:[^\W_]|[\u0300-\u036f])*")


def words(text: str | None, folded: str | None = None) -> list[str]:
    """Runs of letters and digits, without regard to case, encoding and look-alikes; of a text that is folded already as it is."""
    if folded is not None:
        return _WORD.findall(folded)
    return _WORD.findall(caseless(text)) if text else []


def _texts(docs: DataFrame, doc_key: str, text: str, *more: str) -> DataFrame:
    """(k, more..., t, f): the text itself where only Python folds it right, else the folded one."""
    simple = easy(F.col(text))
    return docs.where(F.col(text).isNotNull()).select(F.col(doc_key).alias("k"), *more, F.when(~simple, F.col(text)).alias("t"), F.when(simple, caselessly(F.col(text))).alias("f"))


class Items:
    """The words of a bounded block of items as numbers, and their n-grams as rolling hashes."""

    def __init__(self, rows: list[tuple[int, str]], gram: int):
        self.gram = gram
        self.ids: dict[str, int] = {}
        self.items = [(i, np.array([self.ids.setdefault(w, len(self.ids)) for w in words(t)], dtype=np.int64)) for i, t in rows]
        grams = [self.hashes(w) for _, w in self.items]
        self.grams = np.unique(np.concatenate([np.empty(0, np.int64), *grams]))
        self.by_item = [np.searchsorted(self.grams, g) for g in grams]

    def hashes(self, ids: np.ndarray) -> np.ndarray:
        """A hash of each n-gram; unknown words (-1) make hashes that are dropped by the caller."""
        n = len(ids) - self.gram + 1
        if n <= 0:
            return np.empty(0, np.int64)
        h = np.zeros(n, dtype=np.uint64)
        for k in range(self.gram):
            h = h * np.uint64(0x9E3779B97F4A7C15) + (ids[k : k + n].astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
            h ^= h >> np.uint64(29)
        return h.view(np.int64)

    def numbers(self, text: str | None, folded: str | None = None) -> np.ndarray:
        get = self.ids.get
        return np.array([get(w, -1) for w in words(text, folded)], dtype=np.int64)

    def hits(self, ids: np.ndarray) -> np.ndarray:
        """Indexes of the distinct item n-grams among these words."""
        h = self.hashes(ids)
        if not len(h) or not len(self.grams):
            return np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.grams, h), len(self.grams) - 1)
        return np.unique(at[self.grams[at] == h])


def align(doc: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """(score, run): the best local alignment of two word sequences (match 2, mismatch -1, gap -1) and the longest run of
    equal consecutive words. One vectorised row for each word of the item, over the whole document."""
    n = len(doc)
    row, run = np.zeros(n + 1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
    steps = np.arange(n + 1)
    best = longest = 0
    for w in item:
        same = doc == w
        free = np.maximum(row[:-1] + np.where(same, 2, -1), row[1:] - 1)
        free = np.concatenate(([0], np.maximum(free, 0)))
        row = np.maximum.accumulate(free + steps) - steps  # gaps along the document
        run = np.concatenate(([0], np.where(same, run[:-1] + 1, 0)))
        best, longest = max(best, int(row.max())), max(longest, int(run.max()))
    return best, longest


def leaks(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", gram: int = GRAM, run: int = RUN, item_block: int = ITEM_BLOCK) -> DataFrame:
    """(doc_key, item_key, run, score, share): documents that hold all n-grams seeds lead to, with the longest verbatim run
    in words, the alignment's score and its share of the best possible for the item.

    Every pair with a verbatim run of at least `run` words is there; pairs with shorter runs are there when they share a
    seed. Null and blank texts, and items shorter than a seed, give nothing; an item of fewer than `run` words has no
    window but its rarest n-gram is a seed. Texts of any length are aligned whole. The items are a stated query set: they
    are read by the driver in blocks of `item_block`, each block going against all documents.
    """
    spark = docs.sparkSession
    listed = items.select(F.col(item_key).cast("long").alias("i"), F.col(text).alias("t")).where("i is not null and t is not null").distinct()
    total = listed.count()
    blocks = -(-total // item_block) or 1
    out = None
    for b in range(blocks):
        rows = [(r["i"], r["t"]) for r in listed.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b).sort("i", "t").collect()]
        part = _block(spark, docs, Items(rows, gram), doc_key, item_key, text, run)
        out = part if out is None else out.unionByName(part)
    return out.groupBy(doc_key, item_key).agg(*[F.max(c).alias(c) for c in ("run", "score", "share")]) if blocks > 1 else out


def _block(spark, docs: DataFrame, items: Items, doc_key: str, item_key: str, text: str, run: int) -> DataFrame:
    key = docs.select(doc_key).schema[0]
    kind = pa.int64() if isinstance(key.dataType, T.LongType) else pa.int32() if isinstance(key.dataType, T.IntegerType) else pa.string()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, grams = [], []
            for k, t, f in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = items.hits(items.numbers(t, f))
                keys.extend([k] * len(found))
                grams.extend(found.tolist())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(grams, pa.int64())], names=["k", "g"])

    hits = materialize(_texts(docs, doc_key, text).mapInArrow(look, T.StructType([T.StructField("k", key.dataType), T.StructField("g", T.LongType())])), "hits")
    # one count for each n-gram of a bounded block of items
    counts = np.zeros(len(items.grams), dtype=np.int64)
    for r in hits.groupBy("g").count().toLocalIterator():
        counts[r["g"]] = r["count"]
    seeds: set[tuple[int, int]] = set()
    for n, grams in enumerate(items.by_item):
        span = max(1, run - items.gram + 1)
        for start in range(max(1, len(grams) - span + 1) if len(grams) else 0):
            window = grams[start : start + span]
            window = window[counts[window] > 0]  # an edited copy holds only some of them
            if len(window):
                seeds.add((int(window[np.lexsort((window, counts[window]))[0]]), n))
    joined = hits.join(spark.createDataFrame(sorted(seeds) or [], "g long, n int"), "g").groupBy("k").agg(F.collect_set("n").alias("ns"))
    # one row a document and item, so that a document that meets many items isn't one task's burden
    pairs = joined.select("k", F.explode("ns").alias("n"))
    met = docs.select(F.col(doc_key).alias("k"), F.col(text).alias("_text")).join(pairs, "k").repartition("k", "n")
    chosen = _texts(met, "k", "_text", "n")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for k, t, f, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                item, seq = items.items[n]
                best, longest = align(items.numbers(t, f), seq)
                out.append((k, item, longest, best, best / (2 * len(seq))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(zip(*out), (kind, pa.int64(), pa.int32(), pa.int32(), pa.float64()), strict=True)], names=[doc_key, item_key, "run", "score", "share"])

    schema = T.StructType([T.StructField(doc_key, key.dataType), T.StructField(item_key, T.LongType()), T.StructField("run", T.IntegerType()), T.StructField("score", T.IntegerType()), T.StructField("share", T.DoubleType())])
    return chosen.select("k", "t", "f", "n").mapInArrow(score, schema).distinct()


def found(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id): documents that hold at least 13 consecutive words of an item."""
    return leaks(docs, items).where(F.col("run") >= RUN).select("doc_id", F.col("item_id").cast("int").alias("item_id")).distinct()


def leaked(docs: DataFrame, items: DataFrame, share: float = SHARE, **how) -> DataFrame:
    """leaks() that count: a verbatim run of RUN words or more, or an edited copy that keeps at least `share` of the item's
    alignment score. A copy in which no five consecutive words of the item are left has no seed and isn't found."""
    return leaks(docs, items, **how).where((F.col("run") >= RUN) | (F.col("share") >= share))
