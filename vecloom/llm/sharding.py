"""Shards by a hierarchical weighted hash tree; DataFrame functions only.

A key descends region, rack and shard. At each level every child draws ln(u) / weight, u
from a hash of the key and the child's name, and the largest draw wins, so children win
in proportion to their weights. A draw depends on nothing but key, child and weight: when
a weight changes, keys move only into or out of the subtrees on its path. A shard that is
added in a region of its own therefore takes rows only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm.numbering import gapless, with_row
from vecloom.llm.text import col, helper, or_empty, written


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def tree(shards: int, per_rack: int = 4, racks: int = 2) -> list[Leaf]:
    """Shards 0, 1, ... of weight 1, `per_rack` to a rack and `racks` racks to a region."""
    return [Leaf(s // (per_rack * racks), s // per_rack, s) for s in range(shards)]


def grown(leaves: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, in a region and rack of its own."""
    return [*leaves, Leaf(*(1 + max(getattr(x, k) for x in leaves) for k in ("region", "rack", "shard")), weight)]


def _children(pairs: list[tuple[int, int, float]]) -> Column:
    """Map from a parent to its children, each with the sum of the weights below it."""
    weights: dict[int, dict[int, float]] = {}
    for parent, child, weight in pairs:
        below = weights.setdefault(parent, {})
        below[child] = below.get(child, 0.0) + weight
    entries = []
    for parent, below in sorted(weights.items()):
        nodes = [F.struct(F.lit(c).alias("node"), F.lit(float(w)).alias("weight")) for c, w in sorted(below.items())]
        entries += [F.lit(parent), F.array(*nodes)]
    return F.create_map(*entries)


def _drawn(key: Column, level: str, children: Column) -> Column:
    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(level), child["node"], key), 11)
        return F.struct((F.log((bits + 1) / F.lit(float(1 << 53))) / child["weight"]).alias("d"), child["node"].alias("n"))

    return F.array_max(F.transform(children, draw))["n"]


def place(frame: DataFrame, key: str, leaves: list[Leaf], out: str) -> DataFrame:
    """The frame with each key's shard in column `out`. A null key is a key like any other."""
    alive = [x for x in leaves if x.weight > 0]
    text = F.coalesce(F.concat(F.lit("k"), col(key).cast("string")), F.lit(""))
    region, rack = helper("region"), helper("rack")
    levels = (
        (region, "region", F.lit(0), [(0, x.region, x.weight) for x in alive]),
        (rack, "rack", col(region), [(x.region, x.rack, x.weight) for x in alive]),
        (out, "shard", col(rack), [(x.rack, x.shard, x.weight) for x in alive]),
    )
    for name, level, parent, pairs in levels:
        frame = frame.withColumn(name, _drawn(text, level, F.element_at(_children(pairs), parent)))
    return frame.drop(region, rack)


def assign(
    spark: SparkSession, documents: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Each row's shard and its place there: key, size, text_crc32, law, shard, slot, grown_shard.

    Size is the text's UTF-8 bytes plus 16; a null text has none, and the crc32 of nothing.
    Repeated keys share a shard, each row with a slot of its own. An empty table gives no rows.
    """
    leaves = tree(shards)
    row = helper("row")
    body = or_empty(text)
    narrow = documents.select(
        col(key).alias(key),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    narrow = place(place(with_row(narrow, row), key, leaves, "shard"), key, grown(leaves), "grown_shard")
    narrow = written(spark, narrow, "shards")
    return gapless(narrow, ["shard"], row, "slot").select(
        col(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
