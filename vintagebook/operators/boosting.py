"""Histogram boosting that grows many models together, and a search over it.

Features are cut into at most ``BINS`` quantile bins once.  Rows with the same bin
codes get the same score from every tree, so they are packed into a cell: the
codes and one raw score per model once, and of each row its label, fold and a
hash of its key (the last decides which rows a tree sees).  Gradients are summed
over cells, weighted by the cells' counts of seen rows.  Codes that do not repeat
make cells of one row.  All
models (a trial of the search on the rows outside one fold) grow at the same
time: one job sums gradients and Hessians by (model, open node, feature, bin) in
every task, merges the tasks' sums per (model, node) and finds the node's best
split there; the driver gets one split per open node.  A trial so costs depth x
iterations jobs, whatever the number of folds, and the trials of a batch share
them: every job takes each unfinished trial one level further.  Where the cells are
few, models grow whole in a task each instead (:mod:`packed`).

Trees grow level by level; when a level would exceed ``num_leaves``, its splits
of the largest gain are taken.  A null or NaN lies below all values.  Rows are
sampled per (trial, iteration) by a hash of their key, so that a result does not
depend on the partitioning.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpointed, task_slots

BINS = 64
MIN_ROWS = 20        # rows of a leaf
MIN_HESSIAN = 1e-3   # summed second derivatives of a leaf
KEEP_EVERY = 2       # finished trees of a model that a job applies again before scores are written

# The search space: (kind, from, to) per parameter.
SPACE: dict[str, tuple] = {
    "n_estimators": ("int", 5, 50),
    "learning_rate": ("log", 0.01, 0.5),
    "max_depth": ("int", 3, 10),
    "num_leaves": ("int", 10, 100),
    "reg_alpha": ("float", 0.0, 1.0),
    "reg_lambda": ("float", 0.0, 1.0),
    "subsample": ("float", 0.5, 1.0),
    "colsample_bytree": ("float", 0.5, 1.0),
    "scale_pos_weight": ("float", 1.0, 30.0),
}
DEFAULTS = {"n_estimators": 50, "learning_rate": 0.1, "max_depth": 6, "num_leaves": 31, "reg_alpha": 0.0,
            "reg_lambda": 0.0, "subsample": 1.0, "colsample_bytree": 1.0, "scale_pos_weight": 1.0}
CELL_ROWS = 256      # rows of a cell; more rows of the same codes take several cells
_CELLS = "codes binary, n int, y binary, fold binary, h binary"


@dataclass
class Tree:
    """Nodes as lists: an inner node sends codes up to ``cut`` to ``child`` and
    the others to ``child + 1``; a leaf has feature -1."""
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    child: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def leaf_of(self, codes: np.ndarray) -> np.ndarray:
        feature, cut, child = (np.array(x) for x in (self.feature, self.cut, self.child))
        node, depth, reached = np.zeros(len(codes), np.int64), 0, np.array([0])
        while (reached := reached[feature[reached] >= 0]).size:
            reached, depth = np.concatenate([child[reached], child[reached] + 1]), depth + 1
        # a row stays in its leaf: no code lies above 255
        leaf = feature < 0
        feature, cut, child = np.where(leaf, 0, feature), np.where(leaf, 255, cut), np.where(leaf, np.arange(len(leaf)), child)
        flat, start = np.ascontiguousarray(codes).reshape(-1), np.arange(len(codes)) * codes.shape[1]
        for _ in range(depth):
            node = child.take(node) + (flat.take(start + feature.take(node)) > cut.take(node))
        return node

    def split(self, node: int, feature: int, cut: int, values: tuple[float, float]) -> tuple[int, int]:
        at = len(self.feature)
        self.feature[node], self.cut[node], self.child[node] = feature, cut, at
        for v in values:
            self.feature.append(-1)
            self.cut.append(0)
            self.child.append(0)
            self.value.append(v)
        return at, at + 1


@dataclass(eq=False)
class Trial:
    """One parameter set on its way: its models' finished trees that the written
    scores lack, and the trees that grow."""
    number: int
    params: dict
    folds: list[int]
    base: list[float]
    iteration: int = 0
    level: int = 0
    done: list[list[Tree]] = field(default_factory=list)
    pending: list[list[Tree]] = field(default_factory=list)
    growing: list[Tree] = field(default_factory=list)
    open: list[list[int]] = field(default_factory=list)

    def start_tree(self) -> None:
        self.growing, self.open, self.level = [Tree() for _ in self.folds], [[0] for _ in self.folds], 0

    @property
    def finished(self) -> bool:
        return self.iteration >= self.params["n_estimators"]


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def sampled(h: np.ndarray, trial: int, iteration: int, share: float) -> np.ndarray:
    """Which of the rows with key hashes ``h`` a tree sees."""
    if share >= 1:
        return np.ones(len(h), bool)
    salt = _mix(np.array([trial << 20 | iteration], np.uint64))
    return (_mix(h.view(np.uint64) ^ salt) >> np.uint64(11)) / float(1 << 53) < share


def columns_of(n: int, trial: int, iteration: int, share: float) -> list[int]:
    """The features a tree may use."""
    return sorted(random.Random(trial << 20 | iteration).sample(range(n), max(1, math.ceil(n * share))))


def shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def best_splits(stats: np.ndarray, features: Sequence[int], params: Mapping) -> list[tuple]:
    """(gain, feature, cut, left value, right value) of every node of ``stats``, nodes x
    (g, h, n) x features x bins; gain 0 where no split is allowed."""
    alpha, lam = params["reg_alpha"], params["reg_lambda"] + 1e-12
    total = stats[:, :, 0].sum(axis=2)[:, :, None, None]
    left = np.cumsum(stats, axis=3)[:, :, :, :-1]
    right = total - left
    score = lambda s: shrunk(s[:, 0], alpha) ** 2 / (s[:, 1] + lam)
    ok = ((left[:, 2] >= MIN_ROWS) & (right[:, 2] >= MIN_ROWS) & (left[:, 1] >= MIN_HESSIAN) & (right[:, 1] >= MIN_HESSIAN))
    gain = np.where(ok, score(left) + score(right) - score(total), 0.0)
    best = gain.reshape(len(gain), -1).argmax(axis=1)
    f, cut = np.unravel_index(best, gain.shape[1:])
    node = np.arange(len(gain))
    value = lambda s: -params["learning_rate"] * shrunk(s[node, 0, f, cut], alpha) / (s[node, 1, f, cut] + lam)
    return list(zip(gain[node, f, cut].tolist(), np.array(features)[f].tolist(), cut.tolist(),
                    value(left).tolist(), value(right).tolist()))


def best_split(stats: np.ndarray, features: Sequence[int], params: Mapping) -> tuple:
    """:func:`best_splits` of one node."""
    return best_splits(stats[None], features, params)[0]


def _fixed(column: pa.Array, dtype, width: int) -> np.ndarray:
    """A binary column of values of one width as a matrix."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    if not width or not len(column):
        return np.zeros((len(column), width), dtype)
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view(dtype).reshape(len(column), width)


def _advanced(scores: np.ndarray, codes: np.ndarray, trials: Sequence[Trial]) -> np.ndarray:
    """The models' scores with their pending trees."""
    scores, m = scores.copy(), 0
    for t in trials:
        for trees in t.pending:
            for tree in trees:
                scores[:, m] += np.array(tree.value)[tree.leaf_of(codes)]
            m += 1
    return scores


def _joined(column: pa.Array, dtype) -> np.ndarray:
    """A binary column's values one after the other."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view(dtype) if ends[-1] > ends[0] else np.zeros(0, dtype)


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column with the values between the ``ends``."""
    at = (ends * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1,
                                 [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))])


def _pack(batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator[pa.RecordBatch]:
    """The cells of rows (codes, y, fold, h) that come sorted by their codes."""
    for b in batches:
        if not b.num_rows:
            continue
        codes, every = _fixed(b.column(0), np.uint8, n_features), np.arange(b.num_rows)
        new = np.concatenate([[True], (codes[1:] != codes[:-1]).any(axis=1)])
        in_run = every - np.maximum.accumulate(np.where(new, every, 0))
        starts = np.flatnonzero(in_run % CELL_ROWS == 0)
        ends = np.append(starts, b.num_rows)
        yield pa.RecordBatch.from_arrays(
            [_binary(codes[starts].ravel(), np.arange(len(starts) + 1) * n_features),
             pa.array(np.diff(ends), pa.int32()),
             *[_binary(b.column(k).to_numpy(), ends) for k in (1, 2, 3)]], names=["codes", "n", "y", "fold", "h"])


def _unpack(batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator[pa.RecordBatch]:
    """The rows (codes, y, fold, h) of cells."""
    for b in batches:
        codes, at, y, fold, h = _read(b, n_features)
        yield pa.RecordBatch.from_arrays(
            [_binary(codes[at].ravel(), np.arange(len(at) + 1) * n_features),
             *[pa.array(x) for x in (y, fold, h)]], names=["codes", "y", "fold", "h"])


def _sizes(batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator[pa.RecordBatch]:
    """(fold, y, n): rows by fold and label, and without them the cells of other codes than the one before."""
    for b in batches:
        if b.num_rows:
            codes, _, y, fold, _ = _read(b, n_features)
            both = pa.table({"fold": fold, "y": y, "n": np.ones(len(y), np.int64)}).group_by(["fold", "y"]).aggregate([("n", "sum")])
            cells = 1 + int((codes[1:] != codes[:-1]).any(axis=1).sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array([*both["fold"].to_pylist(), None], pa.int32()), pa.array([*both["y"].to_pylist(), None], pa.float32()),
                 pa.array([*both["n_sum"].to_pylist(), cells], pa.int64())], names=["fold", "y", "n"])


def _read(b: pa.RecordBatch, n_features: int) -> tuple:
    """The cells' codes, and of every row its cell, label, fold and hash."""
    at = np.repeat(np.arange(b.num_rows), b.column(1).to_numpy())
    return (_fixed(b.column(0), np.uint8, n_features), at,
            *[_joined(b.column(k), t) for k, t in ((2, np.float32), (3, np.int32), (4, np.int64))])


def _scores(b: pa.RecordBatch, n_models: int) -> np.ndarray:
    return _fixed(b.column(5), np.float64, n_models)


def _place(fold: np.ndarray, folds: Sequence[int]) -> np.ndarray:
    """Where in ``folds`` a row's fold stands; their number when it does not."""
    out = np.full(len(fold), len(folds))
    for j, f in enumerate(folds):
        out[fold == f] = j
    return out


def _histograms(batches: Iterator[pa.RecordBatch], trials: Sequence[Trial], n_features: int, bins: int
                ) -> Iterator[pa.RecordBatch]:
    """(model, node, stats): a task's sums for every open node, once."""
    n_models = sum(len(t.folds) for t in trials)
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        codes, at, y, fold, h = _read(b, n_features)
        scores, m = _advanced(_scores(b, n_models), codes, trials), 0
        folds = trials[0].folds
        key = (_place(fold, folds) * 2 + (y > 0)) * len(codes) + at
        shape = (len(folds) + 1, 2, len(codes))
        zero_one = bool(((y == 0) | (y == 1)).all())
        columns = codes.T.astype(np.int64)
        for t in trials:
            if t.finished:
                m += len(t.folds)
                continue
            p = t.params
            # per fold and cell: the seen rows, their weights and weighted labels
            seen = sampled(h, t.number, t.iteration, p["subsample"])
            n = np.bincount(key[seen], minlength=math.prod(shape)).reshape(shape)
            label = (n * [[0.0], [1.0]] if zero_one
                     else np.bincount(key[seen], y[seen], math.prod(shape)).reshape(shape))
            count, weight, label = (x[:, 0] + by * x[:, 1] for x, by in (
                (n, 1), (n, p["scale_pos_weight"]), (label, p["scale_pos_weight"])))
            all_count, all_weight, all_label = count.sum(axis=0), weight.sum(axis=0), label.sum(axis=0)
            features = columns_of(n_features, t.number, t.iteration, p["colsample_bytree"])
            for j, (tree, nodes) in enumerate(zip(t.growing, t.open)):
                if nodes:
                    slot = np.full(len(tree.feature), -1)
                    slot[nodes] = np.arange(len(nodes))
                    where, rows = slot[tree.leaf_of(codes)], all_count - count[j]
                    prob = 1 / (1 + np.exp(-scores[:, m]))
                    w = all_weight - weight[j]
                    g, hess = prob * w - (all_label - label[j]), prob * (1 - prob) * w
                    cells = np.flatnonzero((where >= 0) & (rows > 0))
                    where, rows, g, hess = where[cells], rows[cells], g[cells], hess[cells]
                    size = len(nodes) * bins
                    part = np.zeros((3, len(features), size))
                    for k, c in enumerate(features):
                        to = where * bins + columns[c].take(cells)
                        part[0, k] = np.bincount(to, g, size)
                        part[1, k] = np.bincount(to, hess, size)
                        part[2, k] = np.bincount(to, rows, size)
                    part = part.reshape(3, len(features), len(nodes), bins)
                    sums[m] = sums[m] + part if m in sums else part
                m += 1
    models, nodes, stats, m = [], [], [], 0
    for t in trials:
        for open_nodes in t.open or [[]] * len(t.folds):
            if m in sums:
                for k, node in enumerate(open_nodes):
                    models.append(m)
                    nodes.append(node)
                    stats.append(np.ascontiguousarray(sums[m][:, :, k]).tobytes())
            m += 1
    yield pa.RecordBatch.from_arrays([pa.array(models, pa.int32()), pa.array(nodes, pa.int32()),
                                      pa.array(stats, pa.binary())], names=["model", "node", "stats"])


_SPLITS = pa.schema([("model", pa.int32()), ("node", pa.int32()), ("gain", pa.float64()), ("feature", pa.int32()),
                     ("cut", pa.int32()), ("low", pa.float64()), ("high", pa.float64())])


def _choose(batches: Iterator[pa.RecordBatch], how: dict, bins: int) -> Iterator[pa.RecordBatch]:
    """The best splits of the (model, node)s in a task from all tasks' sums."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for b in batches:
        for model, node, stats in zip(*(b.column(k).to_pylist() for k in range(3))):
            part, at = np.frombuffer(stats, np.float64), (model, node)
            sums[at] = sums[at] + part if at in sums else part
    rows = []
    for (model, node), stats in sums.items():
        features, params = how[model]
        rows.append((model, node, *best_split(stats.reshape(3, len(features), bins), features, params)))
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_SPLITS)], schema=_SPLITS)


class Booster:
    """The coded rows of a frame and the jobs that grow trees on them."""

    def __init__(self, df: DataFrame, features: Sequence[str], label: str, key: Sequence[str], fold: str | None = None,
                 cuts: list[list[float]] | None = None):
        self.features, self.label = list(features), label
        self.cuts = cuts if cuts is not None else quantile_cuts(df, features)
        self.bins = max(map(len, self.cuts), default=0) + 2
        table = coded(df, self.features, self.cuts).select(
            "codes", F.col(label).cast("float").alias("y"),
            (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"),
            F.xxhash64(*[F.col(k) for k in key]).alias("h")).filter("y is not null")
        # even tasks, as every job reads all rows; the hash parts codes that many rows have
        n, spark = len(self.features), df.sparkSession
        # a level is a job of its own: no more tasks than keep the cluster busy, as each reads its cells as a stream
        tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * task_slots(spark))
        self.cells = checkpointed(table.repartitionByRange(tasks, "codes", "h").sortWithinPartitions("codes")
                                  .mapInArrow(lambda it: _pack(it, n), _CELLS))
        self.rows = self.cells.mapInArrow(lambda it: _unpack(it, n), "codes binary, y float, fold int, h long")
        sizes = {(r["fold"], r["y"]): r["n"] for r in self.cells.mapInArrow(
            lambda it: _sizes(it, n), "fold int, y float, n long").groupBy("fold", "y").agg(F.sum("n").alias("n")).collect()}
        self.n_cells = sizes.pop((None, None), 0)
        self.counts = sizes

    def base(self, left_out: int, params: Mapping) -> float:
        """The log odds of the weighted rows outside a fold."""
        pos = sum(n for (f, y), n in self.counts.items() if f != left_out and y > 0) * params["scale_pos_weight"]
        neg = sum(n for (f, y), n in self.counts.items() if f != left_out and y <= 0)
        return math.log(pos / neg) if pos and neg else 0.0

    @property
    def few_cells(self) -> bool:
        """Whether models may grow whole in a task: few cells, and labels that counts tell."""
        from . import packed
        return self.n_cells * len(self.features) <= packed.MOST_CODES and {y for _, y in self.counts} <= {0.0, 1.0}

    def grown(self, settings: Sequence[tuple[int, dict]], folds: Sequence[int], trees: bool) -> DataFrame:
        """:func:`packed.grown` of this frame: one model per (number, params) and left-out fold."""
        from . import packed
        settings = [(k, {**DEFAULTS, **p}) for k, p in settings]
        return packed.grown(self.cells, settings, folds, [self.base(f, p) for _, p in settings for f in folds],
                            len(self.features), self.bins, trees)

    def _with_scores(self, trials: Sequence[Trial]) -> DataFrame:
        first = np.array([b for t in trials for b in t.base], np.float64).tobytes()
        return self.cells.withColumn("scores", F.lit(bytearray(first)))

    def grow(self, settings: Sequence[tuple[int, dict]], folds: Sequence[int]) -> tuple[list[Trial], list[Scored]]:
        """The finished trials of (number, params), one model per left-out fold, and
        the cells with the final scores, in parts as the trials ended."""
        trials = [Trial(k, {**DEFAULTS, **p}, list(folds), [self.base(f, {**DEFAULTS, **p}) for f in folds])
                  for k, p in settings]
        for t in trials:
            t.done, t.pending = [[] for _ in folds], [[] for _ in folds]
            t.start_tree()
        n, bins = len(self.features), self.bins
        cells, live, parts = self._with_scores(trials), trials, []
        while not all(t.finished for t in live):
            if max(len(t.pending[0]) for t in live) >= KEEP_EVERY:
                cells, live = self._advance(cells, live, parts)
            how, m = {}, 0
            for t in live:
                cols = columns_of(n, t.number, t.iteration, t.params["colsample_bytree"])
                how |= {m + j: (cols, t.params) for j in range(len(t.folds))}
                m += len(t.folds)
            now = [replace(t, done=[], pending=[[] for _ in t.folds] if t.finished else t.pending) for t in live]
            splits = cells.mapInArrow(lambda it: _histograms(it, now, n, bins), "model int, node int, stats binary"
                                      ).repartition("model", "node").mapInArrow(
                lambda it: _choose(it, how, bins),
                "model int, node int, gain double, feature int, cut int, low double, high double").collect()
            found: dict[int, list] = {}
            for s in splits:
                found.setdefault(s["model"], []).append(s)
            self._take(live, found)
        self._advance(cells, live, parts)
        return trials, parts

    def _take(self, trials: Sequence[Trial], found: Mapping[int, list]) -> None:
        """One level's splits into the growing trees; full trees are finished."""
        m = 0
        for t in trials:
            if t.finished:
                m += len(t.folds)
                continue
            for j, tree in enumerate(t.growing):
                leaves = sum(f < 0 for f in tree.feature)
                splits = sorted((s for s in found.get(m + j, []) if s["gain"] > 0), key=lambda s: (-s["gain"], s["node"]))
                t.open[j] = [node for s in splits[:max(0, t.params["num_leaves"] - leaves)]
                             for node in tree.split(s["node"], s["feature"], s["cut"], (s["low"], s["high"]))]
            m += len(t.folds)
            t.level += 1
            if t.level >= t.params["max_depth"] or not any(t.open):
                for j, tree in enumerate(t.growing):
                    t.done[j].append(tree)
                    t.pending[j].append(tree)
                t.iteration += 1
                t.start_tree()

    def _advance(self, cells: DataFrame, live: list[Trial], parts: list[Scored]) -> tuple[DataFrame, list[Trial]]:
        """``cells`` with the pending trees in their scores, written, and whose scores
        these are: trials that are in ``parts`` are left out, those that have ended
        since are added to them."""
        n, n_models = len(self.features), sum(len(t.folds) for t in live)
        kept = [t for t in live if not any(t in p.ended for p in parts)]
        models = [m for m, t in enumerate(t for t in live for _ in t.folds) if t in kept]
        now = [replace(t, done=[], pending=[list(p) for p in t.pending]) for t in live]

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                new = _advanced(_scores(b, n_models), _fixed(b.column(0), np.uint8, n), now)[:, models]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:5], pa.array([r.tobytes() for r in new], pa.binary())], names=b.schema.names)

        out = checkpointed(cells.mapInArrow(step, _CELLS + ", scores binary"))
        for t in live:
            t.pending = [[] for _ in t.folds]
        if ended := [t for t in kept if t.finished]:
            parts.append(Scored(out, kept, ended))
        return out, kept

    def held_out(self, parts: Sequence[Scored], trials: Sequence[Trial]) -> DataFrame:
        """(trial, fold, score, y): every row's score from the model without it."""
        n = len(self.features)

        def step(batches: Iterator[pa.RecordBatch], models: list, folds: list, n_models: int) -> Iterator[pa.RecordBatch]:
            for b in batches:
                _, at, y, fold, _ = _read(b, n)
                scores, own = _scores(b, n_models), _place(fold, folds)
                for number, first in models:
                    s = scores[at, first + own]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(y), number, np.int32)), pa.array(fold), pa.array(s), pa.array(y)],
                        names=["trial", "fold", "score", "y"])

        return _of_parts(parts, trials, step, "trial int, fold int, score double, y float")

    def held_out_counts(self, parts: Sequence[Scored], trials: Sequence[Trial]) -> DataFrame:
        """(trial, fold, score, n, pos, neg): the rows of :meth:`held_out`, counted per score."""
        n = len(self.features)

        def step(batches: Iterator[pa.RecordBatch], models: list, folds: list, n_models: int) -> Iterator[pa.RecordBatch]:
            for b in batches:
                codes, at, y, fold, _ = _read(b, n)
                scores, key = _scores(b, n_models), at * len(folds) + _place(fold, folds)
                size = len(codes) * len(folds)
                count, pos = np.bincount(key, minlength=size), np.bincount(key, y, size)
                some = np.flatnonzero(count)
                cell, own = some // len(folds), some % len(folds)
                for number, first in models:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), number, np.int32)), pa.array(np.array(folds, np.int32)[own]),
                         pa.array(scores[cell, first + own]), pa.array(count[some]), pa.array(pos[some]),
                         pa.array(count[some] - pos[some])], names=["trial", "fold", "score", "n", "pos", "neg"])

        counts = _of_parts(parts, trials, step, "trial int, fold int, score double, n long, pos double, neg double")
        return counts.groupBy("trial", "fold", "score").agg(*[F.sum(c).alias(c) for c in ("n", "pos", "neg")])


@dataclass
class Scored:
    """Cells with the scores of ``trials``; those of ``ended`` are final."""
    cells: DataFrame
    trials: list[Trial]
    ended: list[Trial]


def _of_parts(parts: Sequence[Scored], trials: Sequence[Trial], step, schema: str) -> DataFrame:
    """``step`` over the cells of every part, with the (number, first model) of its ended ``trials``."""
    numbers, out = {t.number for t in trials}, None
    for p in parts:
        folds = list(p.trials[0].folds)
        models = [(t.number, i * len(folds)) for i, t in enumerate(p.trials) if t in p.ended and t.number in numbers]
        found = p.cells.mapInArrow(
            lambda it, a=models, f=folds, k=len(folds) * len(p.trials): step(it, a, f, k), schema)
        out = found if out is None else out.unionAll(found)
    return out


@dataclass
class BoostedTrees:
    """A fitted model: bounded by its parameters, whatever the rows."""
    features: list[str]
    cuts: list[list[float]]
    base: float
    trees: list[Tree]

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """``df`` with the probability of the positive class."""
        base, trees, n = self.base, self.trees, len(self.features)
        made = coded(df, self.features, self.cuts)
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), f"`{out}` double"])

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                codes = _fixed(b.column(b.num_columns - 1), np.uint8, n)
                raw = np.full(b.num_rows, base)
                for t in trees:
                    raw += np.array(t.value)[t.leaf_of(codes)]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(1 / (1 + np.exp(-raw)))],
                                                 names=[*b.schema.names[:-1], out])

        return made.mapInArrow(step, schema)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model as a table: one row per tree, and one for the rest."""
        head = json.dumps({"features": self.features, "cuts": self.cuts, "base": self.base})
        rows = [(-1, head)] + [(i, json.dumps(asdict(t))) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, "tree int, body string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        rows = spark.read.parquet(path).orderBy("tree").collect()
        return cls(**json.loads(rows[0]["body"]), trees=[Tree(**json.loads(r["body"])) for r in rows[1:]])


def quantile_cuts(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """At most ``bins`` - 2 increasing cuts per feature (a sketch, one scan)."""
    probs = [i / (bins - 1) for i in range(1, bins - 1)]
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    row = df.agg(*[F.percentile_approx(value(c), probs, 10000).alias(f"c{i}") for i, c in enumerate(features)]).first()
    return [sorted(set(row[f"c{i}"] or [])) for i in range(len(features))]


def coded(df: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]]) -> DataFrame:
    """``df`` with ``codes``: a byte per feature, 0 for null and NaN, else 1 + the
    number of cuts below the value."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), "codes binary"])
    values = [F.col(c).cast("double").alias(f"_code{i}") for i, c in enumerate(features)]
    k = len(df.columns)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = np.zeros((b.num_rows, len(cuts)), np.uint8)
            for j, c in enumerate(cuts):
                v = b.column(k + j).to_numpy(zero_copy_only=False).astype(np.float64)
                codes[:, j] = np.where(np.isnan(v), 0, 1 + np.searchsorted(c, v, "left"))
            yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array([r.tobytes() for r in codes], pa.binary())],
                                             names=[*b.schema.names[:k], "codes"])

    return df.select("*", *values).mapInArrow(step, schema)


def fit(df: DataFrame, features: Sequence[str], label: str, key: Sequence[str], params: Mapping | None = None,
        number: int = 0) -> BoostedTrees:
    """One model on all rows."""
    b, settings = Booster(df, features, label, key), [(number, dict(params or {}))]
    if b.few_cells:
        trees = [Tree(**json.loads(r["tree"])) for r in b.grown(settings, [-2], True).collect()]
        return BoostedTrees(list(features), b.cuts, b.base(-2, {**DEFAULTS, **settings[0][1]}), trees)
    (t,), _ = b.grow(settings, [-2])
    return BoostedTrees(list(features), b.cuts, t.base[0], t.done[0])


# ------------------------------------------------------------------ search
def _unit(spec: tuple, x: float) -> float:
    lo, hi = (math.log(v) if spec[0] == "log" else v for v in spec[1:3])
    return ((math.log(x) if spec[0] == "log" else x) - lo) / (hi - lo)


def _value(spec: tuple, u: float):
    lo, hi = (math.log(v) if spec[0] == "log" else v for v in spec[1:3])
    x = lo + u * (hi - lo)
    return math.exp(x) if spec[0] == "log" else round(x) if spec[0] == "int" else x


def _density(u: float, centres: Sequence[float], width: float) -> float:
    """A Parzen window estimate on [0, 1]: a uniform share and a bell per centre."""
    bells = sum(math.exp(-((u - c) / width) ** 2 / 2) for c in centres) / (width * math.sqrt(2 * math.pi))
    return (1 + bells) / (len(centres) + 1)


def suggest(space: Mapping[str, tuple], past: Sequence[tuple[dict, float]], rng: random.Random,
            startup: int = 10, candidates: int = 24) -> dict:
    """Parameters of the next trial: uniform for the first ``startup`` ones, then
    for each parameter the best of ``candidates`` draws from the density of the
    good quarter, by its ratio to the density of the others."""
    if len(past) < startup:
        return {k: _value(s, rng.random()) for k, s in space.items()}
    ranked = sorted(past, key=lambda t: -t[1])
    cut = max(1, len(past) // 4)
    out = {}
    for k, spec in space.items():
        good, bad = ([_unit(spec, p[k]) for p, _ in part] for part in (ranked[:cut], ranked[cut:]))
        width = max(0.05, 1 / (1 + len(good)))
        draws = [min(1.0, max(0.0, rng.gauss(rng.choice(good), width))) for _ in range(candidates)] + [rng.random()]
        out[k] = _value(spec, max(draws, key=lambda u: _density(u, good, width) / _density(u, bad, width)))
    return out


def search(train: DataFrame, features: Sequence[str], label: str, key: Sequence[str],
           space: Mapping[str, tuple] = SPACE, n_trials: int = 100, folds: int = 5, patience: int = 10,
           batch: int = 25, seed: int = 42) -> list[tuple[int, dict, float, list[float]]]:
    """(trial, params, mean AUC, AUC per fold) in the order of the trials, up to
    ``n_trials`` or ``patience`` trials in a row without a better mean.  Trials of
    a batch are drawn and grown together; those after the stop are not counted."""
    from .metrics import auc_of_counts
    from .model import stratified_folds
    rng, past = random.Random(seed), []
    boost = Booster(stratified_folds(train, label, key, folds, seed, "_fold"), features, label, key, "_fold")
    out, best, stale = [], -1.0, 0
    while len(out) < n_trials:
        drawn = [(len(out) + i, suggest(space, past, rng)) for i in range(min(batch, n_trials - len(out)))]
        aucs: dict[int, dict[int, float]] = {}
        if boost.few_cells:
            counts = boost.grown(drawn, list(range(folds)), False)
        else:
            trials, cells = boost.grow(drawn, list(range(folds)))
            counts = boost.held_out_counts(cells, trials)
        for r in auc_of_counts(counts, ["trial", "fold"]).collect():
            aucs.setdefault(r["trial"], {})[r["fold"]] = r["auc"]
        for number, params in drawn:
            per_fold = [aucs.get(number, {}).get(f) for f in range(folds)]
            known = [a for a in per_fold if a is not None]
            mean = sum(known) / len(known) if known else float("nan")
            past.append((params, mean))
            out.append((number, params, mean, per_fold))
            best, stale = (mean, 0) if mean > best else (best, stale + 1)
            if stale >= patience:
                return out
    return out
