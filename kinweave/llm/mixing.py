"""Sources combined to target shares of all tokens, each document used at most a capped number of times.

Documents are counted by source and exact token length. On these counts, not on documents, a source's budget is filled:
whole passes over the source first, then every length's part by largest remainders, then the rest exactly by a bounded
knapsack (subset sums held as bits of one number). Documents are drawn by seeded hash, as many of each length as the fit says.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.storage import materialize

#: Where the public tokenizers' vocabulary files are.
TOKENIZERS = os.environ.get("KINWEAVE_TOKENIZERS", "/opt/tokenizers")
# Fixed value: the pattern that parts text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Documents of one length and source that one task ranks.
RANKED = 10_000
#: Bits of the knapsack: the tokens that are left to it once every length has given its even part.
KNAPSACK = 1 << 18


@lru_cache(maxsize=2)
def _encoding(name: str):
    """The tokenizer of a rank file that was sent to every executor."""
    import tiktoken

    with open(SparkFiles.get(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", folder: str = TOKENIZERS, name: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(key, source, tokens): whole texts counted with a public tokenizer; null and empty texts have 0. Sources are trimmed and in lower case."""
    docs.sparkSession.sparkContext.addFile(f"{folder}/{name}")
    field = docs.select(key).schema[0]
    kind = pa.int64() if isinstance(field.dataType, T.LongType) else pa.string()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(name).encode_ordinary
        for batch in batches:
            counts = [len(encode(t)) if t else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(kind), batch.column(1), pa.array(counts, pa.int64())], names=[key, "source", "tokens"])

    schema = T.StructType([T.StructField(key, field.dataType), T.StructField("source", T.StringType()), T.StructField("tokens", T.LongType())])
    return docs.select(key, F.lower(F.trim(source)).alias("source"), text).mapInArrow(count, schema)


def knapsack(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many of each size to take, at most counts[size], so that their sum comes as near to the budget as any can.

    Sums are bits of one number; a size with m copies enters as 1, 2, 4, ... copies. Stops once the budget itself is reached.
    """
    if budget <= 0:
        return {}
    top = budget + max((s for s, m in counts.items() if m), default=0)
    mask, reach, steps = (1 << (top + 1)) - 1, 1, []
    for size in sorted((s for s, m in counts.items() if m), reverse=True):
        left, part = min(counts[size], top // size), 1
        while left:
            part = min(part, left)
            steps.append((size, part, reach))
            reach |= reach << (size * part) & mask
            left -= part
            part *= 2
        if reach >> budget & 1:
            break
    total = next(x for d in range(top + 1) for x in (budget - d, budget + d) if 0 <= x <= top and reach >> x & 1)
    taken: dict[int, int] = {}
    for size, part, before in reversed(steps):
        if not before >> total & 1:
            taken[size] = taken.get(size, 0) + part
            total -= size * part
    return taken


def fit(counts: dict[int, int], budget: int, limit: int = KNAPSACK) -> dict[int, int]:
    """How many documents of each length come nearest to the budget: each length's part of it, rounded down, then one more for the
    lengths of the largest remainders while more than `limit` tokens are left, the rest by knapsack(). Equal remainders are
    taken in an order that has nothing to do with length, so that no lengths are preferred."""
    available = sum(s * m for s, m in counts.items())
    if budget >= available:
        return dict(counts)
    taken = {s: m * budget // available for s, m in counts.items()}
    rest = budget - sum(s * m for s, m in taken.items())
    mixed = lambda s: (s * 0x9E3779B97F4A7C15 + 0x7F4A7C15) % (1 << 64) >> 20
    for s in sorted(counts, key=lambda s: (-(counts[s] * budget % available), mixed(s))):  # many lengths of few documents leave much
        if rest <= limit:
            break
        if s <= rest and taken[s] < counts[s]:
            taken[s] += 1
            rest -= s
    for s, m in knapsack({s: counts[s] - taken[s] for s in counts}, rest).items():
        taken[s] += m
    return taken


@dataclass
class Target:
    share: float
    repeat: int


def budgets(available: dict[str, int], targets: dict[str, Target], total: int | None = None) -> dict[str, int]:
    """Tokens each source should give. Sources without documents can't come near their share: what they lack goes to the
    others in equal parts, which keeps the largest deviation smallest. Without a total it is the largest that every source
    can still serve at its share."""
    whole = sum(t.share for t in targets.values()) or 1.0
    present = {s: t for s, t in targets.items() if available.get(s) and t.repeat > 0 and t.share > 0}
    if not present:
        return {}
    lacking = 1 - sum(t.share / whole for t in present.values())
    shares = {s: t.share / whole + lacking / len(present) for s, t in present.items()}
    most = min(int(available[s] * t.repeat / shares[s]) for s, t in present.items())
    total = most if total is None else total
    return {s: min(round(total * shares[s]), available[s] * present[s].repeat) for s in present}


def mix(docs: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 7, **count) -> tuple[DataFrame, DataFrame]:
    """(selection, report). selection: (doc_id, source, tokens, uses), the documents used at least once; report: (source,
    target_share, max_repeat, available_tokens, used_tokens, used_documents, share) for each target.

    Sources without a target aren't used; documents without tokens neither. A null or repeated target source: the first by
    share counts. The driver sees counts by source and length only. The same seed gives the same documents, however the
    rows are spread. An empty corpus gives an empty selection and shares of 0.
    """
    spark = docs.sparkSession
    wanted: dict[str, Target] = {}
    for r in targets.select(F.lower(F.trim("source")).alias("s"), "target_share", "max_repeat").where("s is not null and target_share is not null").sort("s", "target_share", "max_repeat").collect():
        wanted.setdefault(r["s"], Target(r["target_share"], r["max_repeat"] if r["max_repeat"] is not None else 1))
    counted = materialize(token_counts(docs, **count), "tokens")
    usable = counted.where("tokens > 0").where(F.col("source").isin(list(wanted)))
    lengths: dict[str, dict[int, int]] = {s: {} for s in wanted}
    for r in usable.groupBy("source", "tokens").count().toLocalIterator():
        lengths[r["source"]][r["tokens"]] = r["count"]
    available = {s: sum(n * m for n, m in c.items()) for s, c in lengths.items()}
    plan = []
    for s, budget in budgets(available, wanted, total).items():
        base, rest = divmod(budget, available[s])
        extra = fit(lengths[s], rest) if base < wanted[s].repeat else {}
        plan.extend((s, n, base, extra.get(n, 0), m) for n, m in lengths[s].items() if base or extra.get(n))
    taken = spark.createDataFrame(plan, "source string, tokens long, base int, extra long, n long")
    h = F.xxhash64("doc_id", F.lit(seed))
    drawn = usable.join(taken, ["source", "tokens"]).withColumn("h", h).withColumn("part", F.pmod(F.shiftright("h", 20), F.ceil(F.col("n") / RANKED)))
    whole = drawn.where("extra = 0 or extra = n").select("doc_id", "source", "tokens", (F.col("base") + (F.col("extra") > 0).cast("int")).alias("uses"))
    some = drawn.where("extra > 0 and extra < n")
    # a length that many documents have is ranked in parts of bounded size, one after another by their counts
    sizes = some.groupBy("source", "tokens", "part").agg(F.count("*").alias("m"))
    before = sizes.withColumn("before", F.sum("m").over(Window.partitionBy("source", "tokens").orderBy("part")) - F.col("m")).drop("m")
    order = F.row_number().over(Window.partitionBy("source", "tokens", "part").orderBy("h", "doc_id"))
    ranked = some.withColumn("rank", order).join(before, ["source", "tokens", "part"])
    part = ranked.select("doc_id", "source", "tokens", (F.col("base") + (F.col("rank") + F.col("before") <= F.col("extra")).cast("int")).alias("uses"))
    selection = whole.unionByName(part).where("uses > 0")
    used = selection.groupBy("source").agg(F.sum(F.col("tokens") * F.col("uses")).alias("used_tokens"), F.count("*").alias("used_documents"))
    listed = spark.createDataFrame([(s, float(t.share), int(t.repeat), int(available.get(s, 0))) for s, t in sorted(wanted.items())], "source string, target_share double, max_repeat int, available_tokens long")
    report = listed.join(used, "source", "left").fillna(0, ["used_tokens", "used_documents"])
    sums = report.agg(F.sum("used_tokens").alias("_all"))
    report = report.crossJoin(F.broadcast(sums)).withColumn("share", F.coalesce(F.col("used_tokens") / F.nullif("_all", F.lit(0)), F.lit(0.0))).drop("_all")  # one row
    return selection, report
