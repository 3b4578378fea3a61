"""Trees on cells: rows whose features fall into the same bins are trained on once.

Tree learners look at a row's bins only (32 a feature, as in ``pyspark.ml``).  One
aggregation counts the rows of every (bins, label), a *cell*; what is grown
afterwards reads cells and their counts, never the rows.  Features of so many
different bins that hardly any row shares its cell make cells of one row.

``pyspark.ml`` fits single and boosted trees to cells weighted by their counts
(:class:`Binned`).  Its forests would draw one bootstrap number for a whole cell,
so they are grown here (:class:`Forest`): a cell of n rows is drawn a Poisson(n)
number of times for each tree, which is the sum of n rows' draws.  One job per
level counts (node, feature, bin, label) for all trees in every task, merges the
counts by tree and finds the best splits there; the driver gets one split per open
node.  Draws depend on the seed, the tree and the cell's block, not on the
partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, task_slots
from .boosting import Tree, quantile_cuts

BINS = 32            # bins of a feature, the default of pyspark.ml
BLOCK_CELLS = 4096   # cells whose draws share a random stream, on the average
SCORES = 1 << 18     # bins whose scores a task remembers


def _value(c: str):
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _known(c: str):
    """The feature's value; as in ``pyspark.ml``, rows that are trained on have one."""
    return F.when(F.abs(_value(c)) < math.inf, F.col(c).cast("double")).otherwise(
        F.raise_error(F.lit(f"{c} MUST NOT be null, NaN or Infinity")))


def tree_cuts(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """At most ``bins`` - 1 increasing cuts per feature: half-way between neighbours
    of at most ``bins`` values, else quantiles of all rows."""
    about = df.agg(*[F.approx_count_distinct(_known(c)).alias(f"c{i}") for i, c in enumerate(features)]).first()
    few = [i for i in range(len(features)) if about[f"c{i}"] <= 2 * bins]
    cuts: dict[int, list[float]] = {}
    if few:
        found = df.agg(*[F.collect_set(_value(features[i]) + 0.0).alias(f"c{i}") for i in few]).first()
        for i in few:
            values = sorted(set(found[f"c{i}"]))
            if len(values) <= bins:
                cuts[i] = [(a + b) / 2 for a, b in zip(values, values[1:])]
    rest = [i for i in range(len(features)) if i not in cuts]
    if rest:
        cuts |= dict(zip(rest, quantile_cuts(df, [features[i] for i in rest], bins + 1)))
    return [cuts[i] for i in range(len(features))]


def bin_columns(cuts: Sequence) -> list[str]:
    return [f"_bin{i}" for i in range(len(cuts))]


def binned(df: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]]) -> DataFrame:
    """``df`` with a column of :func:`bin_columns` per feature: the number of cuts
    below its value.  Null and NaN are in the last bin, where Spark's trees send them."""
    values = [f"_value{i}" for i in range(len(cuts))]
    df = df.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(v)
                          for c, v in zip(features, values)])
    cut = [i for i, c in enumerate(cuts) if len(c)]
    if cut:
        # a bucket begins at its lower bound, a bin just above its cut
        bounds = [[-math.inf, *(float(np.nextafter(c, math.inf)) for c in cuts[i]), math.inf] for i in cut]
        df = Bucketizer(splitsArray=bounds, inputCols=[values[i] for i in cut], outputCols=[f"_bucket{i}" for i in cut],
                        handleInvalid="keep").transform(df)
    bins = [F.least(F.col(f"_bucket{i}"), F.lit(float(len(c)))) if len(c) else F.lit(0.0) for i, c in enumerate(cuts)]
    return df.select("*", *[b.alias(name) for b, name in zip(bins, bin_columns(cuts))]).drop(
        *values, *[f"_bucket{i}" for i in cut])


def cells(df: DataFrame, features: Sequence[str], label: str, cuts: Sequence[Sequence[float]],
          weight: str | None = None) -> DataFrame:
    """(bins..., label, n): the rows of every cell, written once; with the ``weight``
    of a row of the label, if given."""
    more = [weight] if weight else []
    known = [_known(c).alias(f"_f{i}") for i, c in enumerate(features)]
    rows = binned(df.select(*dict.fromkeys([label, *more]), *known), [f"_f{i}" for i in range(len(features))], cuts)
    return checkpointed(rows.groupBy(*bin_columns(cuts), F.col(label).cast("double").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), *[F.max(c).alias("weight") for c in more]))


@dataclass
class Binned:
    """A ``pyspark.ml`` model of bins."""
    features: list[str]
    cuts: list[list[float]]
    model: object

    @staticmethod
    def vectors(df: DataFrame, cuts: Sequence, out: str = "features") -> DataFrame:
        return VectorAssembler(inputCols=bin_columns(cuts), outputCol=out).transform(df)

    @property
    def featureImportances(self):  # noqa: N802 - the name of pyspark.ml
        return self.model.featureImportances

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` (without a column "features") with the model's columns."""
        return self._of_bins(binned(df, self.features, self.cuts))

    def _of_bins(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.vectors(df, self.cuts)).drop(*bin_columns(self.cuts))

    def with_probability(self, df: DataFrame, out: str, positive_index: int) -> DataFrame:
        return self.score_bins(binned(df, self.features, self.cuts), out, positive_index)

    def score_bins(self, df: DataFrame, out: str, positive_index: int) -> DataFrame:
        """:meth:`with_probability` of rows that have :func:`bin_columns` at their end, which are dropped."""
        from pyspark.ml.functions import vector_to_array
        return self._of_bins(df).withColumn(out, vector_to_array("probability")[positive_index]).drop(
            "features", "rawPrediction", "probability", "prediction")


def fit_binned(est, counted: DataFrame, features: Sequence[str], cuts: list[list[float]], min_leaf: int) -> Binned:
    """``est`` (a single or boosted tree) fitted to :func:`cells`, with ``min_leaf``
    rows in every leaf."""
    total = counted.agg(F.sum("n")).first()[0] or 0
    # all bins are met: the estimator looks at its maxBins ** 2 cells for them
    est = est.copy().setMaxBins(1024).setWeightCol("n").setFeaturesCol("features").setLabelCol("label")
    est = est.setMinInstancesPerNode(1)  # counts cells
    if total < 2 * min_leaf:
        est = est.setMaxDepth(0)
    else:
        est = est.setMinWeightFractionPerNode((min_leaf - 0.5) / total)
    return Binned(list(features), cuts, est.fit(Binned.vectors(counted, cuts)))


# ------------------------------------------------------------------ forests
def _read(block: pa.StructScalar, n_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, labels and counts of a block's cells."""
    rows = block.values
    col = lambda k: rows.field(k).to_numpy(zero_copy_only=False)
    return (np.stack([col(k) for k in range(n_features)], axis=1).astype(np.uint8),
            col(n_features).astype(np.int64), col(n_features + 1).astype(np.int64))


def draws(n: np.ndarray, seed: int, tree: int, block: int, bootstrap: bool) -> np.ndarray:
    """How often a tree sees the cells' rows."""
    return np.random.default_rng([seed, tree, block]).poisson(n) if bootstrap else n


def node_features(n: int, most: int, seed: int, tree: int, node: int) -> np.ndarray:
    """The features that a node may be split by."""
    return np.sort(np.random.default_rng([seed, tree, node, n]).permutation(n)[:most])


def _counts(batches: Iterator[pa.RecordBatch], trees: Sequence[Tree], nodes: Sequence[Sequence[int]], shape: dict
            ) -> Iterator[pa.RecordBatch]:
    """(tree, counts): a task's rows by (open node, feature of the node, bin, label)."""
    f, most, bins, k, seed = (shape[x] for x in ("features", "most", "bins", "classes", "seed"))
    chosen = [np.array([node_features(f, most, seed, t, x) for x in nodes[t]]) for t in range(len(trees))]
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for block, held in zip(b.column(0).to_pylist(), b.column(1)):
            codes, label, n = _read(held, f)
            every = np.arange(len(codes))
            for t, tree in enumerate(trees):
                if not nodes[t]:
                    continue
                slot = np.full(len(tree.feature), -1)
                slot[nodes[t]] = np.arange(len(nodes[t]))
                w = draws(n, seed, t, block, shape["bootstrap"])
                where = slot[tree.leaf_of(codes)]
                at = every[(where >= 0) & (w > 0)]
                where, size = where[at], len(nodes[t]) * most * bins * k
                got = np.zeros(size)
                for j in range(most):
                    code = codes[at, chosen[t][where, j]]
                    got += np.bincount(((where * most + j) * bins + code) * k + label[at], w[at], size)
                sums[t] = sums[t] + got if t in sums else got
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
                                     names=["tree", "counts"])


def _gini(s: np.ndarray) -> np.ndarray:
    """Impurity of the class weights in the last axis."""
    total = s.sum(axis=-1, keepdims=True)
    return 1 - ((s / np.where(total > 0, total, 1)) ** 2).sum(axis=-1)


def best_cut(counts: np.ndarray, weights: np.ndarray, min_leaf: int) -> tuple[float, int, int, np.ndarray, np.ndarray]:
    """(gain, place of the feature, cut, left and right class counts) of a node's
    ``counts`` by (feature, bin, label); gain 0 where no split is allowed."""
    total = counts[0].sum(axis=0)
    left = counts.cumsum(axis=1)[:, :-1]
    right = total - left
    a, z, all_ = left * weights, right * weights, total * weights
    if not left.shape[1] or not all_.sum():
        return 0.0, 0, 0, total, total
    gain = _gini(all_) - (a.sum(axis=2) * _gini(a) + z.sum(axis=2) * _gini(z)) / all_.sum()
    gain = np.where((left.sum(axis=2) >= min_leaf) & (right.sum(axis=2) >= min_leaf), gain, 0.0)
    j, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return float(gain[j, cut]), int(j), int(cut), left[j, cut], right[j, cut]


_SPLITS = "tree int, node int, gain double, feature int, cut int, low array<double>, high array<double>"


def _split(batches: Iterator[pa.RecordBatch], nodes: Sequence[Sequence[int]], shape: dict, weights: Sequence[float],
           min_leaf: int) -> Iterator[pa.RecordBatch]:
    """The best splits of the trees in a task, from all tasks' counts."""
    f, most, bins, k, seed = (shape[x] for x in ("features", "most", "bins", "classes", "seed"))
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for t, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            part = np.frombuffer(part, np.float64)
            sums[t] = sums[t] + part if t in sums else part
    rows = []
    for t, counts in sums.items():
        for node, part in zip(nodes[t], counts.reshape(-1, most, bins, k)):
            gain, j, cut, low, high = best_cut(part, np.array(weights), min_leaf)
            rows.append((t, node, gain, int(node_features(f, most, seed, t, node)[j]), cut, low.tolist(), high.tolist()))
    kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64())]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], x) for i, x in enumerate(kinds)],
                                     names=["tree", "node", "gain", "feature", "cut", "low", "high"])


def pruned(tree: Tree, weights: np.ndarray) -> Tree:
    """The tree without splits whose two leaves vote for the same class."""
    for node in reversed(range(len(tree.feature))):  # children come after their parent
        if tree.feature[node] >= 0:
            a, z = tree.child[node], tree.child[node] + 1
            if tree.feature[a] < 0 and tree.feature[z] < 0 and (
                    np.argmax(tree.value[a] * weights) == np.argmax(tree.value[z] * weights)):
                tree.feature[node] = -1
    return tree


@dataclass
class Forest:
    """Classification trees over bins; a node's value are its rows of each class."""
    features: list[str]
    cuts: list[list[float]]
    weights: np.ndarray
    trees: list[Tree] = field(default_factory=list)
    gains: list[dict[int, float]] = field(default_factory=list)

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - the name of pyspark.ml
        """Gain times weight of the splits by each feature, a tree's made to sum to 1,
        then the forest's."""
        total = np.zeros(len(self.features))
        for tree, gains in zip(self.trees, self.gains):
            own = np.zeros(len(self.features))
            reached = [0]
            while reached:
                node = reached.pop()
                if tree.feature[node] >= 0:
                    own[tree.feature[node]] += gains[node] * (tree.value[node] * self.weights).sum()
                    reached += [tree.child[node], tree.child[node] + 1]
            total += own / own.sum() if own.sum() else own
        return DenseVector(total / total.sum() if total.sum() else total)

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """The mean class shares of the leaves that rows reach."""
        votes = np.zeros((len(codes), len(self.weights)))
        for tree in self.trees:
            value = np.array(tree.value) * self.weights
            sums = value.sum(axis=1, keepdims=True)
            votes += (value / np.where(sums > 0, sums, 1))[tree.leaf_of(codes)]
        sums = votes.sum(axis=1, keepdims=True)
        return votes / np.where(sums > 0, sums, 1)

    def with_probability(self, df: DataFrame, out: str, positive_index: int) -> DataFrame:
        return self.score_bins(binned(df, self.features, self.cuts), out, positive_index)

    def score_bins(self, df: DataFrame, out: str, positive_index: int) -> DataFrame:
        """:meth:`with_probability` of rows that have :func:`bin_columns` at their end, which are dropped."""
        n = len(self.cuts)
        k = len(df.columns) - n

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: dict[bytes, float] = {}  # the scores of the bins that the task has met
            for b in batches:
                codes = np.stack([b.column(k + i).to_numpy() for i in range(n)], axis=1).astype(np.uint8)
                keys = list(map(bytes, codes))
                if new := [x for x in set(keys) if x not in known]:
                    if len(known) > SCORES:
                        known, new = {}, list(set(keys))
                    met = np.frombuffer(b"".join(new), np.uint8).reshape(len(new), n)
                    known |= zip(new, self.probabilities(met)[:, positive_index].tolist())
                p = np.fromiter((known[x] for x in keys), np.float64, len(keys))
                yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array(p)], names=[*b.schema.names[:k], "_p"])

        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:k]), "_p double"])
        return df.mapInArrow(step, schema).withColumn(out, F.col("_p")).drop("_p")


def grow_forest(counted: DataFrame, features: Sequence[str], cuts: list[list[float]], n_trees: int, max_depth: int,
                min_leaf: int, seed: int, bootstrap: bool = True) -> Forest:
    """A forest of :func:`cells`: the square root of the features a node, ``min_leaf``
    drawn rows a leaf; a class has the weight of its cells, if they have one."""
    weight = F.max("weight") if "weight" in counted.columns else F.lit(1.0)
    by_class = {r["label"]: r["w"] for r in counted.groupBy("label").agg(weight.alias("w")).collect()}
    if not by_class or any(y is None or y < 0 or y != int(y) for y in by_class):
        raise ValueError("labels must be 0, 1, ... and not null")
    classes = max(2, int(max(by_class)) + 1)
    weights = np.array([by_class.get(float(y), 1.0) for y in range(classes)])
    names = [*bin_columns(cuts), "label", "n"]
    blocks = counted.count() // BLOCK_CELLS + 1
    # every level reads all blocks: as many even tasks as run at once
    tasks = min(blocks, 2 * task_slots(counted.sparkSession))
    held = checkpointed(
        counted.withColumn("block", F.pmod(F.xxhash64(*names[:-1]), F.lit(blocks))).repartition(tasks, "block")
        .groupBy("block").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("cells")))
    n = len(features)
    shape = {"features": n, "most": n if n_trees == 1 else math.ceil(math.sqrt(n)), "bins": max(map(len, cuts), default=0) + 1,
             "classes": classes, "seed": seed, "bootstrap": bootstrap}
    forest = Forest(list(features), cuts, weights, [Tree(value=[np.zeros(classes)]) for _ in range(n_trees)],
                    [{} for _ in range(n_trees)])
    trees, open_nodes = forest.trees, [[0]] * n_trees
    for level in range(max_depth):
        now, at = list(trees), list(open_nodes)
        splits = held.mapInArrow(lambda it: _counts(it, now, at, shape), "tree int, counts binary").repartition(
            "tree").mapInArrow(lambda it: _split(it, at, shape, weights.tolist(), min_leaf), _SPLITS).collect()
        open_nodes = [[] for _ in trees]
        for s in sorted(splits, key=lambda s: (s["tree"], s["node"])):
            tree, low, high = trees[s["tree"]], np.array(s["low"]), np.array(s["high"])
            if s["gain"] > 0:
                if not level:
                    tree.value[0] = low + high
                forest.gains[s["tree"]][s["node"]] = s["gain"]
                open_nodes[s["tree"]] += tree.split(s["node"], s["feature"], s["cut"], (low, high))
            elif not level:
                tree.value[0] = low
        if not any(open_nodes):
            break
    for tree in trees:
        pruned(tree, weights)
    return forest
