"""Boosted models that grow whole, each in one task, on the counts of few cells.

All that a tree of :mod:`boosting` reads of the rows is how many of a cell's rows
it sees, by label.  Where the cells are few (the bins bound them, whatever the
rows), one job counts these for all trees of all models where the rows lie, and
sends each model's counts, in the order of its trees, to a task that grows them
one after the other: no job per level, and rows are read once a batch of models.
A task holds the cells and the counts of one tree.

A node's sums are those of its parent less its sibling's, the larger child's being
never summed.  Gradients are rounded to a unit so small, and so large, that their
sums are exact in any order: the trees are those of all sums.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .boosting import Tree, _place, _read, best_splits, columns_of, sampled

MOST_CODES = 1 << 22  # cells times features that a task holds

_COUNTS = "model int, tree int, part long, codes binary, counts binary"
_OUT = "trial int, fold int, tree string, score double, n long, pos double, neg double"


def merged(b: pa.RecordBatch, n_features: int) -> tuple:
    """:func:`boosting._read` with neighbours of equal codes as one cell."""
    codes, at, y, fold, h = _read(b, n_features)
    new = np.concatenate([[True], (codes[1:] != codes[:-1]).any(axis=1)])[:len(codes)]
    return codes[new], (np.cumsum(new) - 1)[at], y, fold, h


def _counted(batches: Iterator[pa.RecordBatch], settings: Sequence[tuple[int, Mapping]], folds: Sequence[int],
             n_features: int) -> Iterator[pa.RecordBatch]:
    """Per batch of cells and model: the codes with the left-out rows by label (tree
    -1), then for each tree the rows it sees."""
    part, k = TaskContext.get().partitionId() << 32, len(folds)
    for b in batches:
        if not b.num_rows:
            continue
        codes, at, y, fold, h = merged(b, n_features)
        key, shape = (_place(fold, folds) * 2 + (y > 0)) * len(codes) + at, (k + 1, 2, len(codes))
        size = math.prod(shape)
        all_rows, heads = np.bincount(key, minlength=size).reshape(shape), codes.tobytes()
        for i, (number, p) in enumerate(settings):
            models, trees, first, counts = [], [], [], []

            def add(tree: int, j: int, head: bytes | None, n: np.ndarray) -> None:
                models.append(i * k + j)
                trees.append(tree)
                first.append(head)
                counts.append(n.astype(np.min_scalar_type(int(n.max()))).tobytes())

            for j in range(k):
                add(-1, j, heads, all_rows[j])
            for tree in range(p["n_estimators"]):
                n = all_rows
                if p["subsample"] < 1:
                    n = np.bincount(key[sampled(h, number, tree, p["subsample"])], minlength=size).reshape(shape)
                total = n.sum(axis=0)
                for j in range(k):
                    add(tree, j, None, total - n[j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(models, pa.int32()), pa.array(trees, pa.int32()), pa.array([part] * len(models), pa.int64()),
                 pa.array(first, pa.binary()), pa.array(counts, pa.binary())], names=["model", "tree", "part", "codes", "counts"])
        part += 1


class _Model:
    """A model on its way: the cells' codes by feature and their scores."""

    def __init__(self, codes: np.ndarray, bins: int, base: float, number: int, params: Mapping):
        self.columns = [np.ascontiguousarray(c) for c in codes.T]
        self.bins, self.number, self.params = bins, number, params
        self.scores, self.trees = np.full(len(codes), base), []

    def add_tree(self, n: np.ndarray) -> None:
        """The next tree, on the ``n`` seen rows by (label, cell)."""
        p, tree = self.params, Tree()
        features = columns_of(len(self.columns), self.number, len(self.trees), p["colsample_bytree"])
        label = p["scale_pos_weight"] * n[1]
        weight, prob = n[0] + label, 1 / (1 + np.exp(-self.scores))
        unit = 2.0 ** (math.frexp(float(weight.sum()))[1] - 52)
        values = [*(np.rint(x / unit) * unit for x in (prob * weight - label, prob * (1 - prob) * weight)),
                  (n[0] + n[1]).astype(np.float64)]

        def sums(cells: np.ndarray) -> np.ndarray:
            out, own = np.empty((3, len(features), self.bins)), [v.take(cells) for v in values]
            for j, c in enumerate(features):
                code = self.columns[c].take(cells).astype(np.intp)
                for kind in range(3):
                    out[kind, j] = np.bincount(code, own[kind], self.bins)
            return out

        every = np.arange(len(self.scores))
        level, stats = [(0, every)], [sums(every)]
        for depth in range(p["max_depth"]):
            leaves = sum(f < 0 for f in tree.feature)
            found = [(*s, *at, own) for s, at, own in zip(best_splits(np.array(stats), features, p), level, stats)]
            found.sort(key=lambda s: (-s[0], s[5]))
            most = min(max(0, p["num_leaves"] - leaves), sum(s[0] > 0 for s in found))
            self._leave(tree, [s[5:7] for s in found[most:]])
            level, stats = [], []
            for _, feature, cut, low, high, node, cells, own in found[:most]:
                a, z = tree.split(node, feature, cut, (low, high))
                above = self.columns[feature].take(cells) > cut
                below, above = cells[~above], cells[above]
                level += [(a, below), (z, above)]
                if depth + 1 < p["max_depth"]:
                    less = sums(below if len(below) < len(above) else above)
                    stats += [less, own - less] if len(below) < len(above) else [own - less, less]
            if not level:
                break
        self._leave(tree, level)
        self.trees.append(tree)

    def _leave(self, tree: Tree, leaves: Sequence[tuple[int, np.ndarray]]) -> None:
        for node, cells in leaves:
            self.scores[cells] += tree.value[node]


def _grown(batches: Iterator[pa.RecordBatch], settings: Sequence[tuple[int, Mapping]], folds: Sequence[int],
           bases: Sequence[float], n_features: int, bins: int, trees: bool) -> Iterator[pa.RecordBatch]:
    """The models in a task from their counts, sorted by (model, tree, part): their
    trees, or the left-out rows counted per score."""
    def rows() -> Iterator[tuple]:
        for b in batches:
            yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3), b.column(4))

    for model, of_model in groupby(rows(), itemgetter(0)):
        grown = left_out = None
        number, params = settings[model // len(folds)]
        fold = folds[model % len(folds)]
        for tree, pieces in groupby(of_model, itemgetter(1)):
            pieces = list(pieces)
            if tree < 0:
                heads = [np.frombuffer(p[2].as_buffer(), np.uint8).reshape(-1, n_features) for p in pieces]
                sizes = [len(x) for x in heads]
                grown = _Model(np.concatenate(heads), bins, bases[model], number, params)
            n = np.concatenate([np.frombuffer(p[3].as_buffer(), f"u{len(p[3].as_buffer()) // (2 * size)}").reshape(2, size)
                                for p, size in zip(pieces, sizes)], axis=1, dtype=np.int64)
            if tree < 0:
                left_out = n
            else:
                grown.add_tree(n)
        if trees:
            bodies = [json.dumps(asdict(t)) for t in grown.trees]
            yield _batch(number, fold, len(bodies), tree=bodies)
        else:
            some = np.flatnonzero(left_out.sum(axis=0))
            score, at = np.unique(grown.scores[some], return_inverse=True)
            neg, pos = (np.bincount(at, x[some], len(score)) for x in left_out)
            yield _batch(number, fold, len(score), score=score, n=(neg + pos).astype(np.int64), pos=pos, neg=neg)


def _batch(number: int, fold: int, rows: int, **columns) -> pa.RecordBatch:
    kinds = {"tree": pa.string(), "score": pa.float64(), "n": pa.int64(), "pos": pa.float64(), "neg": pa.float64()}
    made = {"trial": pa.array(np.full(rows, number, np.int32)), "fold": pa.array(np.full(rows, fold, np.int32))}
    made |= {k: pa.array(columns[k], t) if k in columns else pa.nulls(rows, t) for k, t in kinds.items()}
    return pa.RecordBatch.from_arrays(list(made.values()), names=list(made))


def grown(cells: DataFrame, settings: Sequence[tuple[int, Mapping]], folds: Sequence[int], bases: Sequence[float],
          n_features: int, bins: int, trees: bool) -> DataFrame:
    """The models of every (number, params) and left-out fold, ``bases`` their first
    scores, on :class:`boosting.Booster`'s cells with labels 0 and 1.  ``trees``:
    (trial, fold, tree) in the trees' order; else (trial, fold, score, n, pos, neg) of
    the left-out rows, one row per score."""
    counts = cells.mapInArrow(lambda it: _counted(it, settings, folds, n_features), _COUNTS)
    models = counts.repartition(len(settings) * len(folds), "model").sortWithinPartitions("model", "tree", "part")
    out = models.mapInArrow(lambda it: _grown(it, settings, folds, bases, n_features, bins, trees), _OUT)
    return out.select("trial", "fold", *(["tree"] if trees else ["score", "n", "pos", "neg"]))
