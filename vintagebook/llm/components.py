"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


EDGES_PER_TASK = 250_000


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), a written table: ``root``
    is the smallest node of its component, and has no row of its own.

    Each round points every node's larger neighbours at the smallest one it
    sees (large star), then its smaller ones (small star), until nothing
    changes; the rounds grow with the logarithm of the longest path.  A node
    with very many neighbours is an aggregation with map-side partials and a
    join that skew handling can split.  Edges are read as one partition per
    ``EDGES_PER_TASK``, so rounds over few edges cost few tasks.
    """
    cur = edges.filter("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    seen = _state(cur)
    while True:
        dealt = cur.coalesce(seen[0] // EDGES_PER_TASK + 1)
        both = dealt.select(F.explode(F.array(
            F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")),
            F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")))).alias("e")).select("e.*")
        least = both.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
        large = (both.join(least, F.col("u") == F.col("_u")).filter("v > u")
                 .select(F.col("v").alias("hi"), F.least("u", "_m").alias("lo")).distinct())
        least = large.groupBy(F.col("hi").alias("_u")).agg(F.min("lo").alias("_m"))
        small = (large.join(least, F.col("hi") == F.col("_u"))
                 .select(F.explode(F.array(F.struct(F.col("hi"), F.col("_m").alias("lo")),
                                           F.struct(F.col("lo").alias("hi"), F.col("_m").alias("lo"))))
                         .alias("e")).select("e.*").filter("hi != lo").distinct())
        cur = materialize(small, "edges")
        now = _state(cur)
        if now == seen:
            return cur.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        seen = now


def _state(edges: DataFrame) -> tuple:
    """Number and checksum of the edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
