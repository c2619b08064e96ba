"""Boosted one-vs-rest models of all folds in common passes over the rows.

``pyspark.ml`` fits the (fold, class) members one by one and passes over a fold's rows at every level of every tree.
Here one pass serves a level of the trees of all members: a task adds up, per member, node, feature and bin, the rows
and their targets, and the driver picks the splits from these parameter-sized sums.  The method is that of
``GBTClassifier`` (its own split candidates, log loss, variance gain, first of equal splits), and so are the models.

Rows are kept as blocks of one fold: bin numbers between the split candidates of all folds, the label, and the margins of
every member so far.  A block's margins are made once per round.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, StorageLevel, cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.serializers import CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismtab.plans.early_stopping import FLOOR, StoppedModel, best_round

# tasks get these functions with their code: the models need no package on the executors, as before
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: rows of a block
BLOCK = 32768
#: code of a null label
NO_LABEL = -2
#: sums of one pass that a task may send on, in bytes; larger ones (very deep trees) are left to ``pyspark.ml``
MAX_SUMS = 64 << 20


def _module(package, name: str):
    return getattr(getattr(package, name + "$"), "MODULE$")


def split_candidates(gbt: GBTClassifier, rows: DataFrame) -> tuple[list[np.ndarray], int]:
    """The thresholds per feature that ``gbt`` itself would choose among on ``rows`` (label 0 or 1), and the number of rows."""
    jvm = SparkContext._gateway.jvm
    ml, old = jvm.org.apache.spark.ml, jvm.org.apache.spark.mllib.tree
    gbt._transfer_params_to_java()
    own = gbt._java_obj
    field = rows._jdf.schema().apply(gbt.getFeaturesCol())
    kinds = _module(ml.util, "MetadataUtils").getCategoricalFeatures(field)
    strategy = own.getOldBoostingStrategy(kinds, old.configuration.Algo.Classification()).treeStrategy().copy()
    strategy.setAlgo("Regression")
    strategy.setImpurity(_module(old.impurity, "Variance"))
    instances = _module(ml.util, "DatasetUtils").extractInstances(own, rows._jdf, jvm.scala.Option.apply(2))
    metadata = _module(ml.tree.impl, "DecisionTreeMetadata").buildMetadata(instances, strategy, 1, gbt.getFeatureSubsetStrategy())
    found = _module(ml.tree.impl, "RandomForest").findSplits(instances, metadata, gbt.getSeed())
    return [np.array([s.threshold() for s in of], dtype=np.float64) for of in found], int(metadata.numExamples())


def can_boost(gbt: GBTClassifier, base: DataFrame, width: int, n_members: int) -> bool:
    """Whether the passes here serve these rows: numbers only, no weights, and sums of a bounded size."""
    field = base._jdf.schema().apply(gbt.getFeaturesCol())
    kinds = _module(SparkContext._gateway.jvm.org.apache.spark.ml.util, "MetadataUtils").getCategoricalFeatures(field)
    depth = gbt.getMaxDepth()
    return (kinds.isEmpty() and not gbt.isSet(gbt.weightCol) and depth >= 1
            and n_members * 2 ** (depth - 1) * width * gbt.getMaxBins() * 16 <= MAX_SUMS)


@dataclass
class Tree:
    """A tree by heap numbers (root 1): split feature (-1: none), its bin and threshold, gain, and sum and count of targets."""

    feature: np.ndarray
    last: np.ndarray       # last bin of all folds' bins that goes left
    threshold: np.ndarray
    gain: np.ndarray
    total: np.ndarray
    count: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = 2 << depth
        return cls(np.full(size, -1), np.zeros(size, np.int64), *(np.zeros(size) for _ in range(4)))

    def values(self) -> np.ndarray:
        """Predictions at the lowest level; a leaf above it passes its own down."""
        size = len(self.feature)
        out = np.divide(self.total, self.count, out=np.zeros(size), where=self.count > 0)
        for i in range(1, size // 2):
            if self.feature[i] < 0:
                out[2 * i] = out[2 * i + 1] = out[i]
        return out[size // 2 :]


def place(splits: list[tuple[int, int, int]], bins: np.ndarray, level: int) -> np.ndarray:
    """Positions of rows at ``level`` of a tree with these (heap number, feature, last bin to the left), in heap order; rows of a leaf go left."""
    n = bins.shape[1]
    at = np.zeros(n, np.uint8 if level <= 8 else np.int32)
    for up in range(level):
        right = np.zeros(n, bool)
        for node, feature, last in splits:
            if 1 << up <= node < 2 << up:
                right |= (at == node - (1 << up)) & (bins[feature] > last)
        at = at * 2 + right.astype(at.dtype)
    return at


def targets(y: np.ndarray, c: int, margins) -> np.ndarray:
    """What the next tree of class ``c`` is fitted on: its label as -1 or 1, then the negative gradient of the log loss."""
    sign = np.where(y == c, 1.0, -1.0)
    return sign if margins is None else 4.0 * sign / (1.0 + np.exp(2.0 * sign * margins[c]))


def fold_loss(y: np.ndarray, margins: np.ndarray, n: int) -> tuple[float, int]:
    """Sum of the log losses of a block's rows with a label, and their number.  As in ``staged_losses`` the code -1 of a class
    that is none of the classes reads the last one's probability."""
    ps = np.full((n, len(y)), 0.5)
    ps[: len(margins)] = 1 / (1 + np.exp(-2 * margins))
    known = y != NO_LABEL
    own = ps[np.where(known, y, 0), np.arange(len(y))] / ps.sum(axis=0)
    return float(-np.log(np.clip(own[known], FLOOR, 1.0)).sum()), int(known.sum())


def bin_type(merged: list[np.ndarray]):
    return np.uint8 if max(map(len, merged)) < 256 else np.int32


def pack(base: DataFrame, features: str, label: str, merged: list[np.ndarray]) -> DataFrame:
    """The rows as blocks (fold, rows, labels, bins) of one fold each; a null label is ``NO_LABEL``."""
    kind = bin_type(merged)

    def blocks(frames):
        waiting: dict[int, list] = {}

        def block(fold):
            ys, bins = zip(*waiting.pop(fold))
            y = np.concatenate(ys)
            return pa.RecordBatch.from_arrays([pa.array([fold], pa.int32()), pa.array([len(y)], pa.int32()), pa.array([y.tobytes()], pa.binary()),
                                               pa.array([np.concatenate(bins, axis=1).tobytes()], pa.binary())], ["fold", "n", "y", "bins"])

        for batch in frames:
            fold, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            x = batch.column(2).flatten().to_numpy().reshape(len(fold), len(merged))
            bins = np.stack([np.searchsorted(t, x[:, j]).astype(kind) for j, t in enumerate(merged)])
            for f in np.unique(fold).tolist():
                own = fold == f
                for start in range(0, int(own.sum()), BLOCK):
                    waiting.setdefault(f, []).append((y[own][start : start + BLOCK], bins[:, own][:, start : start + BLOCK]))
                    if sum(len(p) for p, _ in waiting[f]) >= BLOCK:
                        yield block(f)
        for f in list(waiting):
            yield block(f)

    rows = base.where("fold is not null").select(
        F.col("fold").cast("int").alias("fold"), F.coalesce(F.col(label).cast("int"), F.lit(NO_LABEL)).alias("y"), vector_to_array(features).alias("x"))
    return rows.mapInArrow(blocks, "fold int, n int, y binary, bins binary")


def unpack(row, kind) -> tuple:
    return row.fold, np.frombuffer(bytes(row.y), np.int32), np.frombuffer(bytes(row.bins), kind).reshape(-1, row.n), None


def sums_of(blocks, members: list[list], level: int, starts: list[list[np.ndarray]], merged: int, shape: tuple[int, int, int],
            counted: bool, n: int, losses: bool):
    """A task's sums: [member, node, feature, bin] of targets and of rows, and (loss, rows) per fold.

    ``members[f][c]`` is (splits so far, open positions of this level); at level 0 rows count for a fold's first member only."""
    nodes, features, bins_of_fold = shape
    flat = [(f, c) for f, own in enumerate(members) for c in range(len(own))]
    held = {}
    loss = np.zeros((len(members), 2))
    for fold, y, bins, margins in blocks:
        if losses and margins is not None and 0 <= fold < len(members):
            loss[fold] += fold_loss(y, margins[fold], n)
        index = np.empty(len(y), np.int64)
        for f, c in flat:
            splits, opened = members[f][c]
            if f == fold or not len(opened):
                continue
            if (f, c) not in held:
                held[f, c] = np.zeros((2, features, (len(opened) + 1) * merged))
            target, (ws, ns) = targets(y, c, None if margins is None else margins[f]), held[f, c]
            slot = np.full(1 << level, len(opened) * merged)
            slot[opened] = np.arange(len(opened)) * merged
            first = slot[place(splits, bins, level)]
            count_here = counted and (level or c == 0)
            for j in range(features):
                np.add(first, bins[j], out=index)
                ws[j] += np.bincount(index, target, ws.shape[1])
                if count_here:
                    ns[j] += np.bincount(index, minlength=ns.shape[1])
    out = np.zeros((2, len(flat), nodes, features, bins_of_fold))
    for m, (f, c) in enumerate(flat):
        if (f, c) in held:
            opened = len(members[f][c][1])
            sums = held[f, c].reshape(2, features, opened + 1, merged)[:, :, :opened]
            for j, s in enumerate(starts[f]):
                out[:, m, :opened, j, : len(s)] = np.add.reduceat(sums[:, j], s, axis=-1)
    yield out, loss


def moved(block: tuple, trees: list[list], depth: int, weight: float, own: bool) -> tuple:
    """The block with the margins after one more tree of every member; those of its own fold's members only with ``own``."""
    fold, y, bins, margins = block
    new = []
    for f, of in enumerate(trees):
        if f == fold and not own:
            new.append(None)
            continue
        step = np.stack([weight * values[place(splits, bins, depth)] for splits, values in of]) if of else np.zeros((0, len(y)))
        new.append(step if margins is None else margins[f] + step)
    return fold, y, bins, new


def choose(tree: Tree, opened: list[int], level: int, ws: np.ndarray, ns: np.ndarray, thresholds: list[np.ndarray], starts: list[np.ndarray],
           min_rows: int, min_gain: float) -> list[int]:
    """Splits the open nodes of a level by their sums; the next level's open positions."""
    n_splits = np.array([len(t) for t in thresholds])
    allowed = np.arange(ws.shape[-1] - 1)[None, :] < n_splits[:, None]
    following = []
    for i, position in enumerate(opened):
        node = (1 << level) + position
        w, n = np.cumsum(ws[i], axis=-1), np.cumsum(ns[i], axis=-1)
        if level == 0:
            tree.total[1], tree.count[1] = w[0, -1], n[0, -1]
        if not allowed.any():
            continue
        wl, nl = w[:, :-1], n[:, :-1]
        wr, nr = w[:, -1:] - wl, n[:, -1:] - nl
        fits = allowed & (nl >= min_rows) & (nr >= min_rows) & (nl > 0) & (nr > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (wl * wl / nl + wr * wr / nr - w[:, -1:] ** 2 / n[:, -1:]) / n[:, -1:]
        gain = np.where(fits & (gain >= min_gain), gain, -np.inf)
        best = int(np.argmax(gain))  # the first of equal ones: by feature, then by threshold
        j, s = divmod(best, gain.shape[1])
        if not gain[j, s] > 0:
            continue
        tree.feature[node], tree.threshold[node], tree.gain[node] = j, thresholds[j][s], gain[j, s]
        tree.last[node] = starts[j][s + 1] - 1
        tree.total[2 * node], tree.count[2 * node] = wl[j, s], nl[j, s]
        tree.total[2 * node + 1], tree.count[2 * node + 1] = wr[j, s], nr[j, s]
        following += [2 * position, 2 * position + 1]
    return following


def splits_of(tree: Tree) -> list[tuple[int, int, int]]:
    return [(int(i), int(tree.feature[i]), int(tree.last[i])) for i in np.flatnonzero(tree.feature >= 0)]


def spark_model(gbt: GBTClassifier, trees: list[Tree], weights: list[float], n_features: int) -> GBTClassificationModel:
    """The trees as a model of ``pyspark.ml``; impurities are not kept (NaN)."""
    gateway = SparkContext._gateway
    ml = gateway.jvm.org.apache.spark.ml
    leaf, inner, split, regression = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, ml.regression.DecisionTreeRegressionModel
    variance = gateway.jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    nan = float("nan")

    def built(tree: Tree):
        stats = ml.python.MLSerDe.loads(CPickleSerializer().dumps([DenseVector([n, s, nan]) for n, s in zip(tree.count, tree.total)]))

        def node(i: int):
            prediction = float(tree.total[i] / tree.count[i]) if tree.count[i] else 0.0
            own = variance(stats.get(i).values(), int(tree.count[i]))
            if tree.feature[i] >= 0:
                (left, leaf_left), (right, leaf_right) = node(2 * i), node(2 * i + 1)
                if leaf_left is None or leaf_left != leaf_right:  # two leaves of one prediction are one leaf
                    return inner(prediction, nan, float(tree.gain[i]), left, right, split(int(tree.feature[i]), float(tree.threshold[i])), own), None
                prediction = leaf_left
            return leaf(prediction, nan, own), prediction

        return regression(gbt.uid, node(1)[0], n_features)

    own, ws = gateway.new_array(regression, len(trees)), gateway.new_array(gateway.jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        own[i], ws[i] = built(tree), float(weight)
    model = GBTClassificationModel(ml.classification.GBTClassificationModel(gbt.uid, own, ws, n_features, 2))
    model._resetUid(gbt.uid)
    return gbt._copyValues(model)


def boost_folds(gbt: GBTClassifier, base: DataFrame, k: int, n: int, patience: int | None = None) -> list[StoppedModel]:
    """One-vs-rest models of ``n`` classes for each of ``k`` folds, fitted on the other folds' rows of ``base`` (``fold``, label, features).

    With ``patience`` a fold's members end at the best round on the fold's rows, as in ``stop_early``; all rounds are fitted."""
    sc = base.sparkSession.sparkContext
    label, features = gbt.getLabelCol(), gbt.getFeaturesCol()
    rounds, depth, watch = gbt.getMaxIter(), gbt.getMaxDepth(), patience is not None

    def candidates(f):
        rest = base.where(F.col("fold") != f).withColumn(label, F.when(F.col(label) == 0, 1.0).otherwise(0.0))
        return split_candidates(gbt.copy(), rest)

    from prismtab.plans.oof import fit_folds

    found = fit_folds(candidates, k)
    thresholds = [t for t, _ in found]
    width = len(thresholds[0])
    merged = [np.unique(np.concatenate([own[j] for own in thresholds])) for j in range(width)]
    starts = [[np.concatenate([[0], np.searchsorted(merged[j], own[j]) + 1]).astype(np.int64) for j in range(width)] for own in thresholds]
    n_bins = max((len(s) for own in starts for s in own), default=1)
    n_merged = max(map(len, merged)) + 1
    kind = bin_type(merged)

    rows = sum(m for _, m in found) / max(k - 1, 1)
    parts = max(1, min(math.ceil(rows / BLOCK), max(2 * sc.defaultParallelism, math.ceil(rows / 4_000_000))))
    state = pack(base, features, label, merged).repartition(parts).rdd.map(lambda r: unpack(r, kind)).persist(StorageLevel.MEMORY_AND_DISK)
    held = [state]
    try:
        tops = state.map(lambda b: (b[0], int(b[1].max()))).collect()
        # as many members as labels up to the largest of a fold's fit rows
        sizes = [1 + max((top for fold, top in tops if fold != f), default=-1) for f in range(k)]
        flat = [(f, c) for f in range(k) for c in range(sizes[f])]
        grown: dict[tuple, list[Tree]] = {m: [] for m in flat}
        losses: list[list[float]] = [[] for _ in range(k)]
        root_counts = None

        def note(loss):
            for f in range(k):
                if watch and loss[f, 1]:
                    losses[f].append(float(loss[f, 0] / loss[f, 1]))

        for t in range(rounds):
            trees = {m: Tree.empty(depth) for m in flat}
            opened = {m: [0] for m in flat}
            for level in range(depth):
                members = [[(splits_of(trees[f, c]), np.array(opened[f, c], np.int64)) for c in range(sizes[f])] for f in range(k)]
                nodes = max(map(len, opened.values()), default=0)
                if not nodes:
                    break
                counted, seen = level > 0 or t == 0, watch and level == 0

                def task(blocks, members=members, level=level, nodes=nodes, counted=counted, seen=seen):
                    return sums_of(blocks, members, level, starts, n_merged, (nodes, width, n_bins), counted, n, seen)

                total, loss = None, np.zeros((k, 2))
                for sums, part in state.mapPartitions(task).collect():
                    total = sums if total is None else total + sums
                    loss += part
                if seen and t:
                    note(loss)
                if level == 0:  # the rows of the root are a fold's, whatever the class and round
                    root_counts = total[1] if root_counts is None else root_counts
                    total[1] = np.stack([root_counts[flat.index((f, 0))] for f, _ in flat])
                for i, (f, c) in enumerate(flat):
                    opened[f, c] = choose(trees[f, c], opened[f, c], level, total[0, i], total[1, i], thresholds[f], starts[f],
                                          gbt.getMinInstancesPerNode(), gbt.getMinInfoGain())
            for m in flat:
                grown[m].append(trees[m])
            if t + 1 < rounds or watch:
                steps = [[(splits_of(trees[f, c]), trees[f, c].values()) for c in range(sizes[f])] for f in range(k)]
                weight = gbt.getStepSize() if t else 1.0

                def after(block, steps=steps, weight=weight):
                    return moved(block, steps, depth, weight, watch)

                state = state.map(after)
                if t + 1 < rounds:
                    state = state.persist(StorageLevel.MEMORY_AND_DISK)
                    held.append(state)
                else:
                    def ended(blocks):
                        out = np.zeros((k, 2))
                        for fold, y, _, margins in blocks:
                            if 0 <= fold < k:
                                out[fold] += fold_loss(y, margins[fold], n)
                        yield out

                    note(sum(state.mapPartitions(ended).collect()))
            while len(held) > 2:  # the state before the last one is still read by the next pass
                held.pop(0).unpersist()
    finally:
        for one in held:
            one.unpersist()

    weights = [1.0] + [gbt.getStepSize()] * (rounds - 1)
    out = []
    for f in range(k):
        kept = best_round(losses[f], patience) if losses[f] else rounds
        members = [spark_model(gbt, grown[f, c][:kept], weights[:kept], width) for c in range(sizes[f])]
        out.append(StoppedModel(members, n, kept, losses[f]))
    return out
