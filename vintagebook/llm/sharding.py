"""Sharding by a hierarchical weighted hash tree.

The layout is a tree: regions hold racks, racks hold weighted shards, and an
inner node weighs what its shards weigh.  A row descends from the root; at
each level every child draws ``-ln(u) / weight`` with ``u`` a hash of (row
key, child name) and the smallest draw wins, so a child is chosen in
proportion to its weight.  A child's draw depends on its own weight only:
when one shard's weight changes, rows move only into (or out of) the
subtrees on its path.  A shard added as a region of its own (:func:`grow`)
takes rows only into itself.

Defined cases: rows with equal keys land in one shard; a null key is a key
like any other; a shard of weight 0 gets no row; an empty table gives an
empty result; extra columns are kept.  Everything runs as Spark expressions;
only the slot numbering shuffles, over rows without texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dense_positions, materialize, reserve


@dataclass(frozen=True)
class Node:
    """An inner node (``children``) or a shard (``shard`` with ``own`` weight)."""

    name: str
    children: tuple["Node", ...] = ()
    shard: int | None = None
    own: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own

    def leaves(self) -> list["Node"]:
        return [x for c in self.children for x in c.leaves()] if self.children else [self]


def even_tree(shards: int, per_rack: int = 4, racks_per_region: int = 2) -> Node:
    """Shards 0..n-1 of weight 1 in racks of ``per_rack``, racks in regions."""
    racks = [Node(f"rack{i // per_rack}", tuple(
        Node(f"shard{s}", shard=s) for s in range(i, min(i + per_rack, shards))))
        for i in range(0, shards, per_rack)]
    return Node("root", tuple(
        Node(f"region{i // racks_per_region}", tuple(racks[i:i + racks_per_region]))
        for i in range(0, len(racks), racks_per_region)))


def grow(tree: Node, weight: float = 1.0) -> Node:
    """One more shard, in a region and rack of its own."""
    s = max(x.shard for x in tree.leaves()) + 1
    leaf = Node(f"shard{s}", shard=s, own=weight)
    region = Node(f"region-of-{s}", (Node(f"rack-of-{s}", (leaf,)),))
    return Node(tree.name, (*tree.children, region))


def _draw(key: Column, path: str, weight: float, seed: int) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(path), key), 11)
    u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(u) / F.lit(float(weight))


def shard_of(key: Column, tree: Node, seed: int = 0, path: str = "") -> Column:
    """The shard that ``key`` descends to."""
    here = f"{path}/{tree.name}"
    if not tree.children:
        return F.lit(tree.shard)
    live = [c for c in tree.children if c.weight > 0]
    if not live:
        raise ValueError(f"no shard of positive weight under {here}")
    if len(live) == 1:
        return shard_of(key, live[0], seed, here)
    draws = F.array(*[F.struct(_draw(key, f"{here}/{c.name}", c.weight, seed).alias("draw"),
                               F.lit(i).alias("child")) for i, c in enumerate(live)])
    won, out = F.array_min(draws)["child"], None
    for i, c in enumerate(live):
        below = shard_of(key, c, seed, here)
        out = F.when(won == i, below) if out is None else out.when(won == i, below)
    return out


def assign_shards(rows: DataFrame, key: Column, tree: Node, grown: Node | None = None,
                  seed: int = 0) -> DataFrame:
    """Add ``shard`` (and ``grown_shard`` under the layout ``grown``), which
    ``rows`` may not have yet, nor ``slot`` (ValueError)."""
    reserve(rows, "shard", "grown_shard", "slot", "_row", "_salt", "_sum", "_by", "_cell", "_shift")
    out = rows.withColumn("shard", shard_of(key, tree, seed).cast("int"))
    return out.withColumn("grown_shard", shard_of(key, grown, seed).cast("int")
                          if grown else F.lit(None).cast("int"))


def with_slots(assigned: DataFrame) -> DataFrame:
    """Add ``slot``: the row's place in its shard, gapless from 0."""
    rows = materialize(assigned.withColumn("_row", F.monotonically_increasing_id()), "shards")
    return dense_positions(rows, "shard", "_row", rows.count(), out="slot").drop("_row")
