"""Merkle dataset manifest with nested-interval labels.

A leaf is the digest of a row; the leaves of a group, in order, have the ranks
0, 1, ...  Every node of a group's tree is labelled by the interval [lo, hi) of
leaf ranks it covers, a node of level k lying in the bucket ``lo div fanout^k``.
Levels are built from below: the nodes of a bucket become one parent, which
keeps its children's intervals and digests (at most ``fanout``).  Proofs are
attached from above: a node finds its parent by an equi-join on (group, bucket)
in which the parent's interval contains the node's, the parent's interval less
the node's own gives the siblings to its left and right, and the parent's path
follows.  The groups' roots are the leaves of a last tree in the same way.

Ranks come from one range partitioning by (group, order, leaf): a row's place
in its task, shifted by the rows of its group in the tasks before it, so a group
that holds a third of all rows is spread over many tasks.  A path is never
stored per leaf: nodes of level 1 carry it, one row for ``fanout`` leaves.

Defined cases: a null field is the text ``-`` and differs from an empty text;
a null group comes first, a null order value first in its group; rows with
equal order values stand by their digest, repeated rows are leaves of their own;
a group of one row has its leaf as root; an empty table gives no rows; extra
columns are ignored, whatever their names; texts of any length are hashed whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.bounded import with_row
from .common import LOWER, UPPER, materialize

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: string, right: string>>"


def field(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def fold(start: Column, path: str) -> Column:
    """The root that ``start`` and the siblings of ``path`` lead to."""
    return F.aggregate(path, start, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def proof_digest(path: str) -> Column:
    """Digest of all siblings of ``path``, level by level, left to right."""
    both = F.transform(path, lambda s: F.concat(s["left"], s["right"]))
    return F.sha2(F.array_join(both, ""), 256)


def ranked(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` (with the column ``grp``) and ``n``, the rows of the group, and
    the interval [``lo``, ``hi``) of the row's rank in it."""
    keys = [F.col(c).asc_nulls_first() for c in ("grp", *order)]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    dealt = materialize(dealt.select(
        "*", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place")), name)
    stretch = dealt.groupBy("grp", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("k"))
    group = Window.partitionBy("grp")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    stretch = stretch.select(
        F.col("grp").alias("_grp"), F.col("part").alias("_part"), F.sum("k").over(group).alias("n"),
        (F.coalesce(F.sum("k").over(before), F.lit(0)) - F.col("first")).alias("_shift"))
    lo = F.col("place") + F.col("_shift")
    return dealt.join(stretch, F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("part") == F.col("_part"))
                      ).select(*rows.columns, "n", lo.alias("lo"), (lo + 1).alias("hi"))


def levels(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """The tables (grp, n, lo, hi, digest, kids) of the levels 1, 2, ... over
    ``leaves`` (grp, n, lo, hi, digest); ``kids`` are the children's
    (lo, hi, digest).  Groups that a level below holds in one node are done."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    out, below, width = [], leaves, 1
    while width < most:
        bucket = F.floor(F.col("lo") / (width * fanout))
        made = below.filter(F.col("n") > width).groupBy("grp", "n", bucket.alias("bucket")).agg(
            F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("kids"))
        made = made.select("grp", "n", F.col("kids")[0]["lo"].alias("lo"),
                           F.element_at("kids", -1)["hi"].alias("hi"),
                           F.sha2(F.array_join(F.col("kids.digest"), ""), 256).alias("digest"), "kids")
        below = materialize(made, f"merkle-level{len(out) + 1}")
        out.append(below)
        width *= fanout
    return out


def roots(leaves: DataFrame, tree: list[DataFrame]) -> DataFrame:
    """(grp, digest) of the node that covers its whole group."""
    whole = [t.filter("lo = 0 and hi = n").select("grp", "digest") for t in [leaves, *tree]]
    out = whole[0]
    for t in whole[1:]:
        out = out.unionByName(t)
    return out


def with_paths(leaves: DataFrame, tree: list[DataFrame], above: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``leaves`` with ``path``: the (left, right) siblings' digests of every
    level from the leaf to its group's root, then that of ``above`` (grp, path)."""
    above = above.select(F.col("grp").alias("_grp"), F.col("path").alias("_path"))
    on_top = lambda t: t.filter("lo = 0 and hi = n").join(
        above, F.col("grp").eqNullSafe(F.col("_grp"))).select(*t.columns, F.col("_path").alias("path"))
    parents = None
    for k in range(len(tree), -1, -1):
        nodes = tree[k - 1] if k else leaves
        found = on_top(nodes)
        if parents is not None:
            width = fanout ** (k + 1)
            up = parents.select(F.col("grp").alias("_grp"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"),
                                F.col("kids").alias("_kids"), F.col("path").alias("_path"))
            inside = (F.col("grp").eqNullSafe(F.col("_grp"))
                      & (F.floor(F.col("lo") / width) == F.floor(F.col("_lo") / width))
                      & (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi")))
            left = F.filter("_kids", lambda x: x["hi"] <= F.col("lo"))
            right = F.filter("_kids", lambda x: x["lo"] >= F.col("hi"))
            step = F.struct(F.array_join(left["digest"], "").alias("left"),
                            F.array_join(right["digest"], "").alias("right"))
            found = nodes.join(up, inside).select(
                *nodes.columns, F.concat(F.array(step), "_path").alias("path")).unionByName(found)
        parents = found
    return parents


def manifest(rows: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", order: str = "doc_id",
             altered: dict[str, Column] | None = None, tampered: Column | None = None,
             fanout: int = FANOUT) -> DataFrame:
    """One row per row of ``rows``: ``order``'s column, ``leaf``, ``given`` (the
    leaf of the row as it is now: with the columns ``altered`` where
    ``tampered``), ``lo`` and ``n`` (rank and size in the group), ``subroot``,
    ``root`` and ``path`` (siblings' digests from the leaf to the root)."""
    columns = [F.col(c) for c in fields]
    changed = leaf_digest([(altered or {}).get(c, F.col(c)) for c in fields])
    leaf = leaf_digest(columns)
    given = leaf if tampered is None else F.when(tampered, changed).otherwise(leaf)
    leaves = materialize(rows.select(F.col(group).alias("grp"), F.col(order).alias("id"),
                                     leaf.alias("digest"), given.alias("given")), "merkle-leaves")
    leaves = materialize(ranked(leaves, ["id", "digest"], "merkle-order"), "merkle-ranked")
    tree = levels(leaves, fanout)
    subroots = roots(leaves, tree).select(F.lit(0).alias("grp"), F.col("grp").alias("source"), "digest")
    tops = materialize(ranked(subroots, ["source"], "merkle-sources"), "merkle-subroots")
    crown = levels(tops, fanout)
    empty = tops.filter("lo = 0").select("grp", F.array().cast(PATH).alias("path"))
    up = with_paths(tops, crown, empty, fanout).select(
        F.col("source").alias("grp"), "path", F.col("digest").alias("subroot"))
    up = materialize(up, "merkle-tops")
    root = roots(tops, crown).agg(F.max("digest").alias("root"))
    out = with_paths(leaves, tree, up.select("grp", "path"), fanout)
    named = up.select(F.col("grp").alias("_grp"), "subroot")
    out = out.join(named, F.col("grp").eqNullSafe(F.col("_grp"))).select(
        F.col("id").alias(order), F.col("digest").alias("leaf"), "given", "lo", "n", "subroot", "path")
    return with_row(out, root)


def verified(proofs: DataFrame) -> DataFrame:
    """``proofs`` with ``proof_sha256``, ``folded_root`` and ``verified``."""
    out = proofs.withColumn("proof_sha256", proof_digest("path")).withColumn(
        "folded_root", fold(F.col("given"), "path"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle_sql(levels_below: int = 6, levels_above: int = 4, fanout: int = FANOUT) -> str:
    """DuckDB SQL of the op11 query, for up to fanout^levels rows of a group."""
    f = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    h = lambda text: "sha256(" + " || ".join(f(c) if c != "text" else f(text) for c in FIELDS) + ")"
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    out = [
        "tab(i, k, v) AS (SELECT i, 0, i FROM range(256) r(i) UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1"
        " THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM tab WHERE k < 8)",
        "crc(doc_id, pos, v) AS (SELECT DISTINCT doc_id, 0, 4294967295::BIGINT FROM documents"
        " WHERE doc_id IS NOT NULL UNION ALL SELECT doc_id, pos + 1, xor(tab.v, crc.v >> 8) FROM crc JOIN tab"
        " ON tab.k = 8 AND tab.i = xor(crc.v, ascii(substr(doc_id::VARCHAR, pos + 1, 1))::BIGINT) & 255"
        " WHERE pos < length(doc_id::VARCHAR))",
        "hit AS (SELECT doc_id FROM crc WHERE pos = length(doc_id::VARCHAR) AND xor(v, 4294967295) % 5 = 0)",
        f"leaves AS (SELECT doc_id, source, {h('text')} AS leaf, CASE WHEN doc_id IN (SELECT doc_id FROM hit)"
        f" THEN {h(lower)} ELSE {h('text')} END AS given FROM documents)",
        "a0 AS (SELECT source AS g, row_number() OVER w - 1 AS rank, count(*) OVER (PARTITION BY source) AS n,"
        " leaf AS digest, doc_id, given FROM leaves WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf))",
    ]

    def climb(p: str, count: int) -> None:
        for k in range(count):
            run = f"PARTITION BY g, rank // {fanout} ORDER BY rank ROWS BETWEEN"
            out.append(f"{p}s{k} AS (SELECT g, rank, n, coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING"
                       f" AND 1 PRECEDING), '') AS l, coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND"
                       f" UNBOUNDED FOLLOWING), '') AS r FROM {p}{k})")
            out.append(f"{p}{k + 1} AS (SELECT g, rank // {fanout} AS rank, (n + {fanout - 1}) // {fanout} AS n, CASE WHEN n > 1"
                       f" THEN sha256(string_agg(digest, '' ORDER BY rank)) ELSE min(digest) END AS digest"
                       f" FROM {p}{k} GROUP BY g, rank // {fanout}, n)")

    climb("a", levels_below)
    out.append(f"b0 AS (SELECT 0 AS g, g AS source, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS rank,"
               f" count(*) OVER () AS n, digest FROM a{levels_below})")
    climb("b", levels_above)
    out.append("f0 AS (SELECT g, rank, doc_id, digest AS leaf, given AS x, '' AS proof FROM a0)")
    for k in range(levels_below):
        out.append(f"f{k + 1} AS (SELECT f.g, f.rank // {fanout} AS rank, doc_id, leaf, CASE WHEN s.n > 1 THEN"
                   f" sha256(s.l || x || s.r) ELSE x END AS x, proof || s.l || s.r AS proof FROM f{k} f JOIN as{k} s"
                   f" ON f.g IS NOT DISTINCT FROM s.g AND f.rank = s.rank)")
    out.append(f"t0 AS (SELECT b.rank, doc_id, leaf, b.digest AS subroot, x, proof FROM f{levels_below} f JOIN b0 b"
               f" ON f.g IS NOT DISTINCT FROM b.source)")
    for k in range(levels_above):
        out.append(f"t{k + 1} AS (SELECT t.rank // {fanout} AS rank, doc_id, leaf, subroot, CASE WHEN s.n > 1 THEN"
                   f" sha256(s.l || x || s.r) ELSE x END AS x, proof || s.l || s.r AS proof FROM t{k} t JOIN bs{k} s"
                   f" ON t.rank = s.rank)")
    root = f"(SELECT digest FROM b{levels_above})"
    return "WITH RECURSIVE " + ",\n".join(out) + (
        f"\nSELECT doc_id, leaf, subroot, {root} AS root, sha256(proof) AS proof_sha256, x AS folded_root,"
        f" x = {root} AS verified FROM t{levels_above}")
