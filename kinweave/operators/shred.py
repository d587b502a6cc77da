"""Nested JSON shredded into an adjacency table, and entity tables pivoted from it.

Every object and every scalar below a JSON column becomes one row: node, parent, label, ordinal, kind and scalar. The table
needs no schema and holds any depth; entity tables come from it by joining object nodes with their scalar children.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NODE = [("field", T.StringType()), ("node", T.StringType()), ("parent", T.StringType()), ("label", T.StringType()), ("ordinal", T.IntegerType()), ("kind", T.StringType()), ("scalar", T.StringType())]


def unwrap(value):
    """The value behind JSON text of JSON text; text that isn't an array or object stays text."""
    while True:  # each step shortens the text
        if not isinstance(value, str) or value.lstrip()[:1] not in ("[", "{", '"'):
            return value
        try:
            inner = json.loads(value)
        except (ValueError, RecursionError):
            return value
        if not isinstance(inner, (dict, list, str)):
            return value
        value = inner


def nodes(text: str) -> Iterator[tuple[str, str | None, str | None, int, str, str | None]]:
    """(node, parent, label, ordinal, kind, scalar) of one JSON text, parents first; nothing if it can't be read.

    A node of an array is named by its parent, the array's name and its position; a single object stands at position 0 of
    the array it replaces, at the top and below. A scalar property is named by its parent and its label, with no position.
    """
    if text is None or text.lstrip()[:1] not in ("[", "{", '"'):
        return
    value = unwrap(text)
    if not isinstance(value, (dict, list)):
        return
    stack: list[tuple] = [(None, None, value, True)]
    while stack:
        parent, label, value, whole = stack.pop()
        value = unwrap(value)
        prefix = ".".join(x for x in (parent, label) if x is not None)
        dot = prefix + "." if prefix else ""
        if whole and isinstance(value, (dict, list)):
            items = value if isinstance(value, list) else [value]
            for i, item in enumerate(items):
                item = unwrap(item)
                node = f"{dot}{i}"
                if isinstance(item, dict):
                    yield node, parent, label, i, "object", None
                    stack.extend((node, k, v, True) for k, v in item.items())
                elif isinstance(item, list):
                    yield node, parent, label, i, "array", None
                    stack.append((node, None, item, True))
                else:
                    yield node, parent, label, i, "null" if item is None else "scalar", scalar(item)
        else:
            yield prefix, parent, label, 0, "null" if value is None else "scalar", scalar(value)


def scalar(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value)


def latest(df: DataFrame, key: str, at: str, columns: Iterable[str]) -> DataFrame:
    """(key, columns...): the columns of each key's row with the latest `at` (null: oldest); among ties the greatest
    contents. One aggregation with partial results on the map side, so a hot key is no burden. Null keys give no row."""
    columns = list(columns)
    best = F.max(F.struct(F.col(at).alias("_at"), *columns)).alias("_b")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(best).select(key, *[F.col("_b")[c].alias(c) for c in columns])


def shred(df: DataFrame, key: str, columns: Iterable[str], kinds: tuple[str, ...] | None = None) -> DataFrame:
    """(key, field, node, parent, label, ordinal, kind, scalar) of the JSON text columns of df.

    Null, blank and unreadable texts give no node; an empty array none; an empty object one. `kinds` keeps only nodes of
    these kinds. A narrow transformation: no shuffle, texts of any length, one row of input in memory at a time.
    """
    columns = list(columns)
    key_field = df.select(F.col(key)).schema[0]
    schema = T.StructType([key_field, *[T.StructField(n, t) for n, t in _NODE]])
    arrow = pa.schema([pa.field(key_field.name, pa.string() if isinstance(key_field.dataType, T.StringType) else pa.int64())] + [pa.field(n, pa.int32() if n == "ordinal" else pa.string()) for n, _ in _NODE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            keys = batch.column(0).to_pylist()
            for c, column in enumerate(columns, 1):
                for k, text in zip(keys, batch.column(c).to_pylist(), strict=True):
                    rows.extend((k, column, *n) for n in nodes(text) if kinds is None or n[4] in kinds)
                    if len(rows) >= 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), arrow, strict=True)], schema=arrow)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), arrow, strict=True)], schema=arrow)

    return df.select(F.col(key), *[F.col(c).cast("string") for c in columns]).mapInArrow(run, schema)


def entities(adjacency: DataFrame, key: str) -> DataFrame:
    """(key, field, node, parent, label, ordinal, scalars): every object at any depth with its scalar properties as a map.

    Object nodes meet their scalar children in one aggregation by node, a child standing under its parent's node: a join
    without a second reading of the table. A label that an object holds twice keeps its greatest value. Objects without
    scalars have an empty map; scalars in arrays are no property of an object and stay in the adjacency table.
    """
    is_object = F.col("kind") == "object"
    of = F.when(is_object, F.col("node")).when((F.col("kind") == "scalar") & (F.col("node") == F.concat_ws(".", "parent", "label")), F.col("parent"))
    own = F.struct("parent", "label", "ordinal")
    met = adjacency.select(key, "field", of.alias("node"), F.when(is_object, own).alias("o"), F.when(~is_object, F.struct("label", "scalar")).alias("s")).where("node is not null")
    got = met.groupBy(key, "field", "node").agg(F.max("o").alias("o"), F.array_sort(F.collect_set("s")).alias("s")).where("o is not null")
    scalars = F.aggregate("s", F.create_map().cast("map<string,string>"), lambda m, x: F.map_concat(F.map_filter(m, lambda k, _: k != x["label"]), F.map_from_arrays(F.array(x["label"]), F.array(x["scalar"]))))
    return got.select(key, "field", "node", "o.parent", "o.label", "o.ordinal", scalars.alias("scalars"))


def entity(objects: DataFrame, key: str, field: str, label: str | None, columns: Iterable[str]) -> DataFrame:
    """(key, node, parent, columns...): the flat table of the objects called `label` (None: the top ones) below `field`, from
    entities(): one text column for each wanted scalar property, null where an object lacks it."""
    named = F.col("label").isNull() & F.col("parent").isNull() if label is None else F.col("label") == label
    return objects.where((F.col("field") == field) & named).select(key, "node", "parent", *[F.col("scalars")[c].alias(c) for c in columns])


def adjacency(career: DataFrame, tournament: DataFrame) -> DataFrame:
    """The adjacency table of each player's latest rows: one parse of all three JSON columns."""
    c = shred(latest(career, "player_id", "updated_at", ["career_trajectory"]), "player_id", ["career_trajectory"])
    t = shred(latest(tournament, "player_id", "updated_at", ["clutch_moments", "previous_wc_appearances"]), "player_id", ["clutch_moments", "previous_wc_appearances"])
    return c.unionByName(t)


def found(career: DataFrame, tournament: DataFrame) -> DataFrame:
    """(player_id, field, node_path): every JSON object of each player's latest rows, from the entity tables."""
    return entities(adjacency(career, tournament), "player_id").select("player_id", "field", F.col("node").alias("node_path"))
