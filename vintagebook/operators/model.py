"""Model training, search and scoring with ``pyspark.ml`` (all fits distributed)."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence

from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from . import boosting
from .bounded import bounded_broadcast, with_row
from .forest import Binned, Forest, bin_columns, cells, fit_binned, grow_forest, tree_cuts
from .metrics import auc_of_counts, average_precision, average_precision_of_counts, roc_auc
from .permuted import permuted_counts
from .selection import first_by_hash

FEATURES_COL = "features"


def assemble(df: DataFrame, features: Sequence[str], out: str = FEATURES_COL) -> DataFrame:
    cast = df.select("*", *[F.col(c).cast("double").alias(f"_d_{c}") for c in features])
    v = VectorAssembler(inputCols=[f"_d_{c}" for c in features], outputCol=out, handleInvalid="keep")
    return v.transform(cast).drop(*[f"_d_{c}" for c in features])


def tree_models(seed: int = 42, max_depth: int = 7) -> dict:
    """The single tree (depth 7) and the boosted trees."""
    return {"decision_tree": DecisionTreeClassifier(maxDepth=max_depth, seed=seed),
            "gbt": GBTClassifier(maxIter=50, maxDepth=5, seed=seed)}


def fit_tree_models(train: DataFrame, features: Sequence[str], label: str,
                    which: Sequence[str] = ("decision_tree", "random_forest", "gbt"),
                    seed: int = 42, max_depth: int = 7, min_leaf: int = 3) -> dict:
    """Decision tree (depth 7, min 3 rows per leaf), random forest (100 trees), boosted
    trees, by name; the rows are counted into cells once, for all of them."""
    cuts = tree_cuts(train, features)
    counted = cells(train, features, label, cuts)

    def fit(name: str) -> Binned | Forest:
        if name == "random_forest":
            return grow_forest(counted, features, cuts, 100, max_depth, min_leaf, seed)
        return fit_binned(tree_models(seed, max_depth)[name], counted, features, cuts, min_leaf)

    return {name: fit(name) for name in which}


def score(model, df: DataFrame, features: Sequence[str], out: str = "score",
          positive_index: int = 1) -> DataFrame:
    """Append P(class = ``positive_index``) as ``out`` (all other columns kept)."""
    if isinstance(model, (Binned, Forest)):
        return model.with_probability(df, out, positive_index)
    s = model.transform(assemble(df, features))
    return s.withColumn(out, vector_to_array("probability")[positive_index]).drop(
        FEATURES_COL, "rawPrediction", "probability", "prediction")


def feature_importances(model, features: Sequence[str], spark) -> DataFrame:
    imp = model.featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)],
                                 "feature string, importance double")


def top_k_features(importances: DataFrame, k: int = 20, col: str = "importance") -> DataFrame:
    """The ``k`` largest importances (ties broken by name)."""
    return importances.orderBy(F.col(col).desc(), F.col("feature").asc()).limit(k)


def threshold_by_max(importances: DataFrame, ratio: float = 0.2, col: str = "importance"
                     ) -> DataFrame:
    """Importances above ``ratio`` x the largest one."""
    mx = importances.agg(F.max(col)).scalar()
    return importances.filter(F.col(col) > ratio * mx)


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """``out``: rows / (classes x rows of the row's class), so classes weigh the same."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows").alias("_all"), F.count(label).alias("_classes"))
    shares = with_row(counts, total).select(
        F.col(label).alias("_class"), (F.col("_all") / (F.col("_classes") * F.col("_rows"))).alias(out))
    # one row per class
    return df.join(bounded_broadcast(shares), F.col(label) == F.col("_class")).drop("_class")


def rf_feature_selection(train: DataFrame, features: Sequence[str], label: str, mode: str = "max_ratio",
                         ratio: float = 0.2, k: int = 20, seed: int = 42) -> DataFrame:
    """Features by a random forest's importance.

    ``max_ratio``: those above ``ratio`` x the largest, from 100 trees of depth 5
    with 2 rows a leaf; ``top_k``: the ``k`` largest, from 50 trees of depth 3 with
    classes of equal weight and 8 rows a leaf, the smallest leaf that halves a node
    of 15 rows, as Spark bounds leaves and not the nodes that are split."""
    if mode not in ("max_ratio", "top_k"):
        raise ValueError(f"mode is max_ratio or top_k, not {mode}")
    rows = train.filter(F.col(label).isNotNull())
    cuts = tree_cuts(rows, features)
    if mode == "max_ratio":
        forest = grow_forest(cells(rows, features, label, cuts), features, cuts, 100, 5, 2, seed)
    else:
        rows = balanced_weights(rows.select(*features, label), label)
        forest = grow_forest(cells(rows, features, label, cuts, "weight"), features, cuts, 50, 3, 8, seed)
    imp = feature_importances(forest, features, train.sparkSession)
    return threshold_by_max(imp, ratio) if mode == "max_ratio" else top_k_features(imp, k)


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Deterministic sample of ``n`` rows: those with the ``n`` smallest hashes of the key."""
    return first_by_hash(df, n, key, seed)


def stratified_folds(df: DataFrame, label: str, key: Sequence[str], k: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Fold id from a hash of (key, label, seed): uniform within each class, so
    every fold gets the class mix of the whole table without any per-class
    window or sort."""
    h = F.xxhash64(*[F.col(c) for c in key], F.col(label), F.lit(seed))
    return df.withColumn(out, F.pmod(h, F.lit(k)).cast("int"))


def cv_search(train: DataFrame, features: Sequence[str], label: str, key: Sequence[str],
              space: Mapping[str, tuple] = boosting.SPACE, n_trials: int = 100, folds: int = 5,
              patience: int = 10, seed: int = 42) -> DataFrame:
    """(trial, params as JSON, mean_auc, fold_auc) of a search with stratified
    k-fold mean ROC AUC: see :func:`boosting.search`."""
    rows = boosting.search(train, features, label, key, space, n_trials, folds, patience, seed=seed)
    return train.sparkSession.createDataFrame(
        [(n, json.dumps(p), m, aucs) for n, p, m, aucs in rows],
        "trial int, params string, mean_auc double, fold_auc array<double>")


def best_params(trials: DataFrame) -> dict:
    """The parameters of the best row of :func:`cv_search` (of equals, the first)."""
    row = trials.filter(~F.isnan("mean_auc")).orderBy(F.desc("mean_auc"), "trial").first()
    return json.loads(row["params"]) if row else {}


def logit_scorecard(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Binomial GLM with intercept: beta, odds ratio, std error, z, p-value and
    Wald statistic (z^2), sorted by Wald."""
    data = assemble(df, features).select(FEATURES_COL, F.col(label).cast("double").alias(label))
    glm = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol=FEATURES_COL,
                                      labelCol=label, fitIntercept=True)
    m = glm.fit(data)
    s = m.summary
    names = list(features) + ["intercept"]
    betas = list(m.coefficients) + [m.intercept]
    rows = [(n, float(b), float(math.exp(b)), float(se), float(z), float(p), float(z * z))
            for n, b, se, z, p in zip(names, betas, s.coefficientStandardErrors, s.tValues, s.pValues)]
    out = df.sparkSession.createDataFrame(
        rows, "feature string, beta double, odds_ratio double, std_error double, z double, "
              "p_value double, wald double")
    return out.orderBy(F.col("wald").desc())


def row_positions(df: DataFrame, out: str = "_pos") -> tuple[DataFrame, int]:
    """``df`` (written once) with gapless row numbers from 0, and their count: the
    row's place in its task, shifted by the sizes of the tasks before it."""
    low = (1 << 33) - 1
    even = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = checkpointed(even.select("*", F.spark_partition_id().alias("_part"),
                                   F.monotonically_increasing_id().bitwiseAND(low).alias("_at")))
    sizes = sorted((r["_part"], r["n"]) for r in dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    shifts, n = [], 0
    for part, size in sizes:  # one number per task
        shifts.append((part, n))
        n += size
    table = df.sparkSession.createDataFrame(shifts, "_part int, _shift long")
    placed = dealt.join(F.broadcast(table), "_part")
    return placed.select(*df.columns, (F.col("_at") + F.col("_shift")).alias(out)), n


def shuffled_position(pos: Column, n: int, *key: Column, rounds: int = 24) -> Column:
    """A bijection of 0 .. n - 1 chosen by ``key``: in every round a number and its
    mirror image at a keyed point change places or not, as a hash of the larger
    of the two says."""
    n = max(n, 1)

    def step(x: Column, i: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(i, *key), F.lit(n)) - x, F.lit(n))
        swap = F.xxhash64(F.greatest(x, mirror), i, *key).bitwiseAND(1) == 1
        return F.when(swap, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), pos, step)


def permuted_frames(df: DataFrame, features: Sequence[str], n_repeats: int, seed: int = 42) -> DataFrame:
    """Every row once per (feature, repeat), with that feature's value taken from
    the row that a bijection of all rows names: one join on the position."""
    rows, n = row_positions(df)
    rows = checkpointed(rows)
    values = rows.select(F.col("_pos").alias("_from"), F.struct(*[F.col(f).cast("double").alias(f) for f in features]).alias("_v"))
    what = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(r).alias("repeat"))
                     for f in features for r in range(n_repeats)])
    many = rows.select("*", F.inline(what))
    many = many.withColumn("_q", shuffled_position(F.col("_pos"), n, F.col("feature"), F.col("repeat"), F.lit(seed)))
    hit = many.join(values, F.col("_q") == F.col("_from"))
    return hit.select("feature", "repeat", *[
        F.when(F.col("feature") == c, F.col("_v")[c]).otherwise(F.col(c).cast("double")).alias(c) if c in features
        else F.col(c) for c in df.columns])


def permutation_importance(model, df: DataFrame, features: Sequence[str], label: str,
                           n_repeats: int = 5, seed: int = 42,
                           metric: str = "average_precision") -> DataFrame:
    """Mean drop of ``metric`` ("average_precision" or "auc") when one feature is
    permuted over all rows, per feature over ``n_repeats`` permutations; all
    features and repeats are scored and measured in one job.  For a model of bins
    the permuted rows are counted by their bins and only these counts are scored."""
    df = df.select(*features, label)
    if isinstance(model, (Binned, Forest)):
        rows, n = row_positions(df)
        counts = permuted_counts(rows, n, model, features, label, n_repeats, seed)
        bins = bin_columns(model.cuts)
        scored = model.score_bins(counts.select("perm", "label", "n", *bins), "score", 1)
        y, of = F.col("label"), F.col("n")
        scored = scored.filter("score is not null").groupBy("perm", "score").agg(
            F.sum("n").alias("n"), F.sum(y * of).alias("pos"), F.sum((1 - y) * of).alias("neg"))
        measured = auc_of_counts(scored, ["perm"]) if metric == "auc" else average_precision_of_counts(scored, ["perm"])
        measured = checkpointed(measured.withColumnRenamed("auc" if metric == "auc" else "average_precision", "_m"))
        base = measured.filter("perm = 0").select(F.col("_m").alias("base_score"))
        names = F.array(*[F.lit(f) for f in features])
        feature = F.get(names, F.floor((F.col("perm") - 1) / n_repeats).cast("int"))
        drops = with_row(measured.filter("perm > 0").select(feature.alias("feature"), "_m"), base)
    else:
        def measure(scored: DataFrame, by: Sequence[str]) -> DataFrame:
            found = (roc_auc if metric == "auc" else average_precision)(scored, "score", label, by)
            return found.select(*by, F.col("auc" if metric == "auc" else "average_precision").alias("_m"))

        base = measure(score(model, df, features), []).withColumnRenamed("_m", "base_score")
        many = score(model, permuted_frames(df, features, n_repeats, seed), features)
        drops = with_row(measure(many.select("feature", "repeat", "score", label), ["feature", "repeat"]), base)
    return drops.groupBy("feature").agg(F.avg(F.col("base_score") - F.col("_m")).alias("importance"),
                                        F.first("base_score").alias("base_score")).orderBy(F.desc("importance"), "feature")


def _gini_gain(cells: Sequence[tuple], a: int, z: int) -> tuple[float, int]:
    """(gain, position) of the best cut of the cells a..z-1 (0: no cut)."""
    n, y = (sum(c[k] for c in cells[a:z]) for k in (2, 3))
    best, left_n, left_y = (0.0, 0), 0, 0.0
    for i in range(a, z - 1):
        left_n, left_y = left_n + cells[i][2], left_y + cells[i][3]
        rest_n, rest_y = n - left_n, y - left_y
        gain = left_y ** 2 / left_n + rest_y ** 2 / rest_n - y ** 2 / n
        if gain > best[0] + 1e-12:
            best = (gain, i + 1)
    return best


def tree_bins_fit(df: DataFrame, col: str, target: str, n_bins: int = 5, cells: int = 1024
                  ) -> DataFrame:
    """Supervised bins: the leaves of a one-feature tree grown best-first.

    The values are cut into at most ``cells`` quantile cells, one aggregation
    counts rows and events per cell, and on that small table the leaf with the
    largest Gini gain is split until there are ``n_bins`` leaves or no split
    gains.  A bound lies half-way between the neighbouring cells' values.  Per
    bin: event rate, volume, lower and upper bound (outer bounds +-inf).  No
    rows with a value give one empty bin."""
    from .prefix import count_below, exact_quantiles
    v = F.col(col).cast("double")
    data = df.filter(v.isNotNull() & F.col(target).isNotNull()).select(
        v.alias("v"), F.col(target).cast("double").alias("y"))
    probs = [i / cells for i in range(1, cells)]
    # brackets that hold a small part of the rows, however many cells
    cuts = sorted({r["value"] for r in exact_quantiles(data, "v", probs, accuracy=max(10_000, 100 * cells)).collect()})
    celled = count_below(data.withColumn("_cuts", F.lit(cuts).cast("array<double>")), "_cuts", "v", len(cuts), "cell")
    counted = celled.groupBy("cell").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"))
    table = [(r["lo"], r["hi"], r["n"], r["y"]) for r in counted.orderBy("cell").collect()]
    leaves = [(0, len(table))] if table else []
    while 0 < len(leaves) < n_bins:
        gain, at, leaf = max((*_gini_gain(table, a, z), (a, z)) for a, z in leaves)
        if gain <= 0:
            break
        leaves = sorted([x for x in leaves if x != leaf] + [(leaf[0], at), (at, leaf[1])])
    uppers = [(table[z - 1][1] + table[z][0]) / 2 for _, z in leaves[:-1]]
    bounds = [float("-inf"), *uppers, float("inf")]
    rows = [(i, bounds[i], bounds[i + 1], sum(c[3] for c in table[a:z]) / sum(c[2] for c in table[a:z]),
             sum(c[2] for c in table[a:z])) for i, (a, z) in enumerate(leaves)]
    return df.sparkSession.createDataFrame(
        rows or [(0, bounds[0], bounds[1], None, 0)],
        "bin int, lower double, upper double, event_rate double, volume long").orderBy("bin")


def noise_jitter_deciles(df: DataFrame, score_col: str, target: str, bins: int = 10,
                         seed: int = 42, keys: Sequence[str] = ()) -> DataFrame:
    """Deciles of the score after a tiny deterministic jitter (ties broken),
    with the mean target per decile."""
    from .binning import noise_jitter
    from .metrics import decile_table
    j = df.withColumn("_jit", noise_jitter(F.col(score_col), seed, keys=keys))
    return decile_table(j, "_jit", target, bins, "qcut", scale=1.0)

