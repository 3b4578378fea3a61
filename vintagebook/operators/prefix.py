"""Distributed running sums and exact quantiles.

A window without ``partitionBy`` sends every row to one task.  Instead:

1. cut the ordering column into ``buckets`` ranges per group with
   ``percentile_approx`` (bounded sketch; the cut table has
   groups x buckets rows);
2. total each (group, range) and turn the totals into exclusive offsets
   with a window over that small table;
3. run the window inside each (group, range) and add its offset.

Every step is a shuffle on (group, range), so a single large group is
still spread over ``buckets`` tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from ..session import checkpointed
from .bounded import with_row

DEFAULT_BUCKETS = 64


# Small per-group tables (cut ranges, bucket offsets, totals) hold at most
# groups x buckets rows; above this bound they are joined by shuffle instead.
SMALL_TABLE_ROWS = 2_000_000


def _small(df: DataFrame, rows_bound: int | None = None) -> DataFrame:
    """Broadcast a per-group table.  ``rows_bound`` is a proven upper bound on
    its rows (groups x buckets); without one the rows are counted first."""
    from .bounded import bounded_broadcast
    if rows_bound is not None:
        return F.broadcast(df) if rows_bound <= SMALL_TABLE_ROWS else df
    return bounded_broadcast(df, SMALL_TABLE_ROWS)


def _group_count(df: DataFrame, group_cols: Sequence[str]) -> int:
    """Number of groups, counted on the (materialised) aggregated input; at
    most SMALL_TABLE_ROWS + 1 groups are read."""
    if not group_cols:
        return 1
    return df.select(*group_cols).distinct().limit(SMALL_TABLE_ROWS + 1).count()


def _bucket_of(df: DataFrame, order_col: str, group_cols: Sequence[str], buckets: int,
               rows_bound: int | None = None) -> DataFrame:
    """Add ``_bucket``: the range of ``order_col`` (per group) the row falls in.

    Cut points come from ``percentile_approx`` (one short sorted array per
    group), attached by an equi-join on the group against the broadcast cut
    table (a scalar subquery without groups); the bucket is the number of
    cut points below the value: ranges (-inf, c0], (c0, c1], ..., (c_last, inf).
    The large side is not shuffled by group and no nested-loop join is
    planned.  NULL values are a range of their own below all others."""
    g = list(group_cols)
    probs = [i / buckets for i in range(1, buckets)]
    cuts = df.groupBy(*g).agg(
        F.array_sort(F.array_distinct(
            F.percentile_approx(F.col(order_col).cast("double"), probs, 10000))).alias("_cuts"))
    j = df.join(_small(cuts, rows_bound), g) if g else with_row(df, cuts)
    v = F.col(order_col).cast("double")
    ranks = F.size(F.filter(F.coalesce("_cuts", F.array().cast("array<double>")), lambda c: c < v))
    return j.withColumn("_bucket", F.when(v.isNull(), -1).otherwise(ranks)).drop("_cuts")


def prefix_sums(df: DataFrame, order_col: str, sum_cols: Sequence[str],
                group_cols: Sequence[str] = (), descending: bool = False,
                buckets: int = DEFAULT_BUCKETS, prefix: str = "cum_",
                materialize: bool = True, n_groups: int | None = None) -> DataFrame:
    """Add ``cum_<c>``: inclusive running sum of ``c`` ordered by ``order_col``
    (within ``group_cols``).  Rows with equal ``order_col`` values are summed
    in an arbitrary order: aggregate to one row per value first for tie-safe
    results (all callers here do).

    ``materialize`` checkpoints the input once (shared checkpoint folder), so
    the cut, total and running-sum passes read it instead of recomputing it.
    """
    g = list(group_cols)
    if materialize:
        df = checkpointed(df)
    if n_groups is None:
        n_groups = _group_count(df, g)
    bound = n_groups * buckets  # rows of the range and offset tables
    b = _bucket_of(df, order_col, g, buckets, bound)
    totals = b.groupBy(*g, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    ob = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    wt = (Window.partitionBy(*g).orderBy(ob)
          .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*[F.col(c).alias(f"_g_{c}") for c in g], F.col("_bucket").alias("_ob"),
                            *[F.coalesce(F.sum(f"_t_{c}").over(wt), F.lit(0))
                              .alias(f"_o_{c}") for c in sum_cols])
    cond = F.col("_bucket") == F.col("_ob")
    for c in g:
        cond = cond & (F.col(c) == F.col(f"_g_{c}"))
    j = b.join(_small(offsets, bound), cond).drop("_ob", *[f"_g_{c}" for c in g])
    oc = F.col(order_col).desc() if descending else F.col(order_col).asc()
    w = (Window.partitionBy(*g, "_bucket").orderBy(oc)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return j.select(*df.columns, *[(F.sum(c).over(w) + F.col(f"_o_{c}")).alias(f"{prefix}{c}")
                                   for c in sum_cols])


def count_below(df: DataFrame, cuts: str, value: str, most: int, out: str) -> DataFrame:
    """Add ``out``: how many of the increasing ``cuts`` (an array column of at most
    ``most`` elements) lie below ``value``, by halving: one column per step."""
    at = df.withColumn(out, F.lit(0))
    for k in reversed(range(most.bit_length())):
        up = F.col(out) + (1 << k)
        at = at.withColumn(out, F.when(F.get(F.col(cuts), up - 1) < F.col(value), up).otherwise(F.col(out)))
    return at


# Ranks a sketch of this accuracy may be off by: n / SKETCH_ACCURACY.
SKETCH_ACCURACY = 10_000
# Distinct values of one bracket that a plain window sorts in one task; a
# larger bracket is cut into ranges first.
BRACKET_ROWS = 1_000_000


def _brackets(base: DataFrame, probs: Sequence[float], group_cols: Sequence[str],
              accuracy: int) -> DataFrame:
    """Per group: ``_cuts``, the sorted ends of the brackets around ``probs``, and
    ``_fine``, whether the values of a range are looked at one by one.

    Cut i is range 2 i + 1 by itself, the values between cuts i - 1 and i are
    range 2 i.  Fine are the cuts, the ranges inside a bracket and all ranges of
    a group with no more rows than the sketch tells apart."""
    near = 3.0 / accuracy
    los, his = [max(0.0, q - near) for q in probs], [min(1.0, q + near) for q in probs]
    sketch = F.percentile_approx("_v", los + his, accuracy)
    m = F.size("_cuts")

    def inside(r: Column) -> Column:
        """More brackets begin than end up to the cut below the range."""
        k = F.floor(r / 2).cast("int")
        cut = F.get("_cuts", k - 1)
        open_ = (F.size(F.filter(F.slice("_at", 1, len(los)), lambda c: c <= cut))
                 > F.size(F.filter(F.slice("_at", len(los) + 1, len(his)), lambda c: c <= cut)))
        return (F.when(k == 0, F.lit(0.0 in los)).when(k == m, F.lit(1.0 in his)).otherwise(open_))

    fine = F.transform(F.sequence(F.lit(0), 2 * m),
                       lambda r: (r % 2 == 1) | (F.col("_n") <= accuracy) | inside(r))
    return (base.groupBy(*group_cols).agg(sketch.alias("_at"), F.count(F.lit(1)).alias("_n"))
            .select(*group_cols, "_n", "_at", F.array_sort(F.array_distinct("_at")).alias("_cuts"))
            .select(*group_cols, "_cuts", fine.alias("_fine")))


def _rank_ranges(state: DataFrame, probs: Sequence[float], group_cols: Sequence[str]) -> DataFrame:
    """Per group, probability and wanted rank (from 0): the range that holds it,
    by the exact counts of the ranges; ``_left``: the rank inside that range.
    Ranges and ranks are put in one order, at most 7 a probability and group."""
    g = list(group_cols)
    part = g or [F.lit(0)]
    totals = state.groupBy(*g, "_range").agg(F.sum("cnt").alias("rows"), F.count("_v").alias("_values"))
    before = Window.partitionBy(*part).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*g, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_rank"),
                           F.struct("_range", "_values").alias("_at"))
    starts = starts.withColumn("_start", F.col("_rank"))
    qs = F.array(*[F.struct(F.lit(i).alias("q_index"), F.lit(float(q)).alias("q"))
                   for i, q in enumerate(probs)])
    ranks = (totals.groupBy(*g).agg(F.sum("rows").alias("_n")).filter("_n > 0")
             .select("*", F.inline(qs))
             .withColumn("_h", (F.col("_n") - 1).cast("double") * F.col("q"))
             .withColumn("_lo", F.floor("_h").cast("bigint"))
             .withColumn("_rank", F.explode(F.array_distinct(F.array(
                 F.col("_lo"), F.ceil("_h").cast("bigint"))))).drop("_n"))
    w = (Window.partitionBy(*part).orderBy("_rank", F.col("q_index").asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = starts.unionByName(ranks, allowMissingColumns=True).select(
        *g, "q_index", "q", "_h", "_lo", "_rank", F.last("_at", True).over(w).alias("_at"),
        (F.col("_rank") - F.last("_start", True).over(w)).alias("_left")).filter("q_index is not null")
    return found.select(*g, "q_index", "q", "_h", "_lo", "_rank", "_at.*", "_left")


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Exact quantiles with linear interpolation (h = (n - 1) * q), per group:
    (group..., q_index, q, value).  NULL values and NULL groups take no part.

    A mergeable sketch brackets every wanted rank.  One aggregation then counts
    the rows between the brackets and, inside them, the rows of each value, so
    only about 6 / ``accuracy`` of the rows per probability are kept and ordered.
    Which range holds a rank is read from these exact counts: a rank outside its
    bracket, should a sketch be off, has its range counted value by value too.
    """
    g = list(group_cols)
    v = F.col(value_col).cast("double")
    base = df.select(*g, v.alias("_v")).filter(F.col("_v").isNotNull())
    cuts = checkpointed(_brackets(base, probs, g, accuracy))
    rows = base.join(_small(cuts), g) if g else with_row(base, cuts)
    rows = count_below(rows, "_cuts", "_v", 2 * len(probs), "_k")
    point = F.coalesce(F.get("_cuts", F.col("_k")) == F.col("_v"), F.lit(False))
    rows = rows.select(*g, "_v", "_fine", (2 * F.col("_k") + point.cast("int")).alias("_range"))
    state = checkpointed(
        rows.select(*g, "_range", F.when(F.get("_fine", F.col("_range")), F.col("_v")).alias("_v"))
        .groupBy(*g, "_range", "_v").agg(F.count(F.lit(1)).alias("cnt")))
    wanted = _rank_ranges(state, probs, g)
    largest, missed = wanted.agg(F.max("_values"), F.bool_or(F.col("_values") == 0)).first()
    if missed:
        lost = _small(wanted.filter("_values = 0").select(*g, "_range").distinct())
        found = (rows.drop("_fine").join(lost, [*g, "_range"], "left_semi")
                 .groupBy(*g, "_range", "_v").agg(F.count(F.lit(1)).alias("cnt")))
        state = checkpointed(state.join(lost, [*g, "_range"], "left_anti").unionByName(found))
        wanted = _rank_ranges(state, probs, g)
        largest = wanted.agg(F.max("_values")).first()[0]
    keys = [*g, "_range"]
    values = state.filter(F.col("_v").isNotNull())
    if (largest or 0) > BRACKET_ROWS:
        cum = prefix_sums(values, "_v", ["cnt"], keys, materialize=False)
    else:
        w = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cum = values.select("*", F.sum("cnt").over(w).alias("cum_cnt"))
    hit = (cum.join(_small(wanted), keys)
           .filter((F.col("_left") >= F.col("cum_cnt") - F.col("cnt")) & (F.col("_left") < F.col("cum_cnt"))))
    agg = hit.groupBy(*g, "q_index", "q", "_h", "_lo").agg(
        F.max(F.when(F.col("_rank") == F.col("_lo"), F.col("_v"))).alias("_vlo"),
        F.max(F.when(F.col("_rank") != F.col("_lo"), F.col("_v"))).alias("_vhi"))
    frac = F.col("_h") - F.col("_lo").cast("double")
    vhi = F.coalesce(F.col("_vhi"), F.col("_vlo"))
    return agg.select(*g, "q_index", "q",
                      (F.col("_vlo") + (vhi - F.col("_vlo")) * frac).alias("value"))
