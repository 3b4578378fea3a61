"""Exact top-k search by columnar branch-and-bound.

The vectors are dealt into blocks; a block is one row that holds its vectors
dimension by dimension, in groups of ``GROUP`` dimensions, the dimensions with
the largest mass in the block first, and for every vector the mass (norm) that
is left after each group.  Query vectors are dealt into blocks of their own.
Every (block, query block) pair is one task group: a query's inner products are
accumulated group by group; with r and s the masses left, a candidate's final
score lies within r * s of the partial one, so candidates whose upper bound is
under the k-th largest lower bound are compacted away.  The survivors of the
last group have exact scores; the best ``k`` of each pair are merged per query.

A query set is compared against all rows, in blocks: each vector block goes to
every query block (as rows of about half a megabyte), nothing is held whole.

Defined cases: a vector that is null or holds a null or non-finite component,
and a row without an id, take no part; rows that share an id count as one, with
the greatest of their vectors; vectors are compared with those of their own
length only; equal scores stand by id; fewer than ``k`` rows are all returned;
an empty table gives no rows; extra columns are ignored.  Inner products must
fit 64 bits; a vector that may exceed them raises.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

GROUP = 16
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
LAID = "len int, block long, kind string, ids binary, axes binary, groups array<binary>, rest array<binary>"


def whole_numbers(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component; null where one is null or not finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(good, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def lay_out(rows: pa.Table) -> pa.Table:
    """One block's rows (len, block, id, v) as one row, dimension by dimension."""
    size, m = rows["len"][0].as_py(), rows.num_rows
    v = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(m, size)
    order = np.argsort(rows["id"].to_numpy())
    v = v[order].astype(np.int64)
    square = v.astype(np.float64) ** 2
    axes = np.argsort(-square.sum(axis=0), kind="stable").astype(np.int64)
    left = np.cumsum(square[:, axes][:, ::-1], axis=1)[:, ::-1]
    groups, rest = [], []
    kind = np.min_scalar_type(-int(np.abs(v).max(initial=0)) - 1)
    for a in range(0, max(size, 1), GROUP):
        groups.append(np.ascontiguousarray(v[:, axes[a:a + GROUP]].T, kind).tobytes())
        rest.append(np.sqrt(left[:, a + GROUP] if a + GROUP < size else np.zeros(m)).tobytes())
    return pa.table({"len": pa.array([size], pa.int32()), "block": pa.array([rows["block"][0].as_py()], pa.int64()),
                     "kind": pa.array([kind.str]),
                     "ids": pa.array([rows["id"].to_numpy()[order].astype(np.int64).tobytes()], pa.binary()),
                     "axes": pa.array([axes.tobytes()], pa.binary()),
                     "groups": pa.array([groups], pa.list_(pa.binary())),
                     "rest": pa.array([rest], pa.list_(pa.binary()))})


def laid_block(row: dict) -> tuple:
    """(ids, axes, groups, rest) of a row of :func:`lay_out` as arrays."""
    ids, axes = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["axes"], np.int64)
    m = len(ids)
    groups = [np.frombuffer(g, row["kind"]).reshape(-1, m).astype(np.int64) for g in row["groups"]]
    return ids, axes, groups, [np.frombuffer(r) for r in row["rest"]]


def best_of(query: np.ndarray, own: int, ids: np.ndarray, groups: list, rest: list, query_rest: np.ndarray,
            k: int, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` best of one block; ``first`` are the partial
    scores after the first group of dimensions."""
    alive = np.flatnonzero(ids != own)
    partial = first[alive]
    at = len(groups[0])
    for b in range(len(groups)):
        if b:
            g = groups[b]
            partial = partial + query[at:at + len(g)] @ g[:, alive]
            at += len(g)
        if len(alive) <= k:
            continue
        slack = rest[b][alive] * query_rest[b] * (1 + 1e-9)
        cut = np.partition(partial - slack, len(alive) - k)[len(alive) - k]
        keep = partial + slack >= cut - 0.5  # the scores are whole numbers
        alive, partial = alive[keep], partial[keep]
    top = np.lexsort((ids[alive], -partial))[:k]
    return ids[alive[top]], partial[top].astype(np.int64)


def search_block(blocks: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The best ``k`` of one block of vectors for every query of one query block."""
    found: tuple[list, list, list] = ([], [], [])
    if blocks.num_rows and queries.num_rows:
        ids, axes, groups, rest = laid_block(blocks.to_pylist()[0])
        asked, q_axes, q_groups, _ = laid_block(queries.to_pylist()[0])
        natural = np.empty((len(q_axes), len(asked)), np.int64)
        natural[q_axes] = np.concatenate(q_groups) if len(q_axes) else natural
        q = natural[axes].T  # in this block's order of dimensions
        most = max((np.abs(g).max(initial=0) for g in groups), default=0)
        bound = int(np.abs(q).max(initial=0)) * int(most) * max(1, len(axes))
        if bound >= 1 << 63:
            raise OverflowError("inner products of these vectors may not fit 64 bits")
        if bound < 1 << 53:  # whole numbers that doubles hold exactly
            q, groups = q.astype(np.float64), [g.astype(np.float64) for g in groups]
        left = np.cumsum((q.astype(np.float64) ** 2)[:, ::-1], axis=1)[:, ::-1]
        ends = np.cumsum([len(g) for g in groups])
        q_rest = np.stack([np.sqrt(left[:, e]) if e < q.shape[1] else np.zeros(len(q)) for e in ends], axis=1)
        for a in range(0, len(asked), 256):
            firsts = q[a:a + 256, :len(groups[0])] @ groups[0]
            for j, first in enumerate(firsts, a):
                who, score = best_of(q[j], asked[j], ids, groups, rest, q_rest[j], k, first)
                found[0].append(np.full(len(who), asked[j]))
                found[1].append(who)
                found[2].append(score)
    return pa.table([pa.array(np.concatenate(x) if x else np.array([]), pa.int64()) for x in found],
                    names=["query_id", "vec_id", "score"])


def blocks_of(rows: DataFrame, per_block: int, parallel: int) -> tuple[DataFrame, int]:
    """The blocks of ``rows`` (id, v) and their number (of each vector length)."""
    n = rows.count()
    count = max(1, -(-n // per_block), min(parallel, n // (per_block // 8)))
    dealt = rows.select(F.size("v").alias("len"), F.pmod(F.xxhash64("id"), F.lit(count)).alias("block"), "id", "v")
    laid = dealt.groupBy("len", "block").applyInArrow(lay_out, LAID)
    return materialize(laid, "topk-blocks"), count


def top_k(vectors: DataFrame, query: Column, k: int = 20, block_rows: int = BLOCK_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` (id long, v
    array<long>) with the largest inner product for each one where ``query``
    holds, other than itself."""
    parallel = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(vectors.filter("id is not null and v is not null").groupBy("id").agg(
        F.max("v").alias("v")), "topk-vectors")
    blocks, n_blocks = blocks_of(rows, block_rows, parallel)
    asked, n_asked = blocks_of(rows.filter(query), query_rows, 1)
    left = blocks.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_asked - 1).cast("long"))).alias("q"))
    right = asked.withColumnRenamed("block", "q").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("block"))
    best = left.groupBy("len", "block", "q").cogroup(right.groupBy("len", "block", "q")).applyInArrow(
        lambda a, b: search_block(a, b, k), "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle_sql(k: int = 20, scale: int = 64, every: int = 20) -> str:
    """DuckDB SQL of the op12 query."""
    return f"""
WITH good AS (
  SELECT vec_id, max(list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
parts AS (SELECT vec_id, len(v) AS n, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM good),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score FROM parts q JOIN parts c
  ON q.pos = c.pos AND q.n = c.n AND q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0 GROUP BY 1, 2)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {k}"""
