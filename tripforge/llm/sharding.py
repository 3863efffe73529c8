"""Sharding by a hierarchical weighted hash tree, in DataFrame functions alone.

Method: a key descends from the root to a region, then to one of its racks, then to one of the rack's
shards. At every level each child draws a number from the hash of the key and the child's name, an
exponential variate with the child's weight as its rate, and the least draw is taken, so children
get keys in proportion to their weights. A weight is the sum of the weights below. If a weight changes, only
the draws of that child and of those above it change: other subtrees keep their keys among themselves.

A shard that is added to a grown tree is a region of its own. Then no other draw changes, and rows
move only to the new shard.

Slots number the rows of a shard from 0 in the order of key and content. The rows are spread by ranges of
shard and key, written, and numbered within their range; the offsets of a shard's earlier ranges come from
one row per range and shard. No shard is gathered in one task.

Defined results: a null key is a key of its own (its rows share a shard). A null text has size ``ROW_BYTES``
and the checksum of the empty text. Rows with equal keys share a shard and get different slots; fully equal
rows get their slots in any order. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripforge.staging import stage

#: Bytes that a row takes beside its text.
ROW_BYTES = 16
_NULL_KEY = "\x00null"
# monotonically_increasing_id() is documented to hold the partition number above the lower 33 bits.
_ROW_BITS = 33


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def even_tree(shards: int, regions: int, racks: int, built: int) -> list[Leaf]:
    """``built`` shards dealt evenly over regions and racks; each later shard is a region of its own."""
    per_rack = -(-built // (regions * racks))
    leaves = []
    for shard in range(shards):
        if shard < built:
            rack = shard // per_rack
            leaves.append(Leaf(f"region{rack // racks}", f"rack{rack}", shard))
        else:
            leaves.append(Leaf(f"added{shard}", f"added{shard}", shard))
    return leaves


def _children(leaves: list[Leaf], level: str) -> dict[str, dict[str, float]]:
    """Names and weights of the children of every node whose children are at ``level``."""
    found: dict[str, dict[str, float]] = {}
    for leaf in leaves:
        parent, child = {
            "region": ("", leaf.region),
            "rack": (leaf.region, leaf.rack),
            "shard": (leaf.rack, str(leaf.shard)),
        }[level]
        own = found.setdefault(parent, {})
        own[child] = own.get(child, 0.0) + leaf.weight
    return found


def _draw(key: Column, level: str, child: Column, weight: Column) -> Column:
    hashed = F.xxhash64(F.concat_ws("/", key, F.lit(level), child))
    uniform = (F.shiftrightunsigned(hashed, 11) + 1) * F.lit(2.0**-53)
    return -F.log(uniform) / weight


def _descend(key: Column, level: str, parent: Column, leaves: list[Leaf]) -> Column:
    nodes = _children(leaves, level)
    pairs = []
    for name, own in nodes.items():
        pairs += [F.lit(name), F.array(*[F.struct(F.lit(c).alias("c"), F.lit(w).alias("w")) for c, w in own.items()])]
    drawn = F.transform(
        F.element_at(F.create_map(*pairs), parent),
        lambda child: F.struct(_draw(key, level, child["c"], child["w"]).alias("draw"), child["c"].alias("c")),
    )
    return F.array_min(drawn)["c"]


def _fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def place(df: DataFrame, key: str, leaves: list[Leaf], name: str) -> DataFrame:
    """``df`` with the column ``name``: the shard that each key descends to."""
    text = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(_NULL_KEY))
    region, rack = _fresh(df, "region_"), _fresh(df, "rack_")
    regions = df.withColumn(region, _descend(text, "region", F.lit(""), leaves))
    racks = regions.withColumn(rack, _descend(text, "rack", F.col(region), leaves))
    shards = racks.withColumn(name, _descend(text, "shard", F.col(rack), leaves).cast("int"))
    return shards.drop(region, rack)


def with_slots(df: DataFrame, shard: str, order: list[str], slot: str = "slot") -> DataFrame:
    """``df`` with the gapless number, from 0, of each row among those of its shard."""
    at, in_range, first, rows, before = (_fresh(df, c) for c in ("place_", "range_", "first_", "rows_", "before_"))
    # The salt splits rows that are equal in all of the order, which no range of it could.
    salt = _fresh(df, "salt_")
    dealt = df.withColumn(salt, F.floor(F.rand(seed=1) * (1 << 20)))
    placed = stage(
        dealt.repartitionByRange(shard, *order, salt)
        .sortWithinPartitions(shard, *order, salt)
        .drop(salt)
        .withColumn(at, F.monotonically_increasing_id()),
        "slots",
    ).withColumn(in_range, F.shiftright(at, _ROW_BITS))
    earlier = Window.partitionBy(shard).orderBy(in_range).rowsBetween(Window.unboundedPreceding, -1)
    # A row for each range and each shard that begins in one: ranges + shards rows at most.
    offsets = stage(
        placed.groupBy(in_range, shard)
        .agg(F.min(at).alias(first), F.count(F.lit(1)).alias(rows))
        .select(in_range, shard, first, F.coalesce(F.sum(rows).over(earlier), F.lit(0)).alias(before)),
        "slot-offsets",
    )
    return placed.join(F.broadcast(offsets), [in_range, shard]).select(
        *df.columns, (F.col(at) - F.col(first) + F.col(before)).alias(slot)
    )


def shard_documents(df: DataFrame, now: list[Leaf], grown: list[Leaf], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, text_crc32, law, shard, slot and grown_shard of every row."""
    own = F.col(f"`{text}`").cast("string")
    rows = df.select(
        F.col(f"`{key}`"),
        (F.coalesce(F.octet_length(own), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(own, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows = place(place(rows, key, now, "shard"), key, grown, "grown_shard")
    return with_slots(rows.withColumn("law", F.lit("key")), "shard", [key, "text_crc32", "size"])
