"""K-05: one stopping round for all members of a boosted one-vs-rest classifier.

A boosted member's margin after each round is the running sum of its trees, so one pass over the validation rows gives
the multiclass log loss after every round: the leaf that each tree sends a row to (``leafCol``) becomes a value of a
table of leaf values (rounds x leaves, a parameter-sized table), and tasks send on one sum per round.  The members are
then cut to the best round; nothing is fitted twice.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: probabilities below this count as this in the log loss
FLOOR = 1e-15


def leaf_values(tree) -> list[float]:
    """Predictions of a tree's leaves from left to right, the order that leaves are numbered in."""
    out, todo = [], [tree._java_obj.rootNode()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "LeafNode":
            out.append(float(node.prediction()))
        else:
            todo += [node.rightChild(), node.leftChild()]
    return out


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model after its first ``rounds`` rounds."""
    own, gateway = model._java_obj, SparkContext._gateway
    ml = gateway.jvm.org.apache.spark.ml
    trees, weights = gateway.new_array(ml.regression.DecisionTreeRegressionModel, rounds), gateway.new_array(gateway.jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(model.trees[:rounds], model.treeWeights)):
        trees[i], weights[i] = tree._java_obj, float(weight)
    cut = GBTClassificationModel(ml.classification.GBTClassificationModel(own.uid(), trees, weights, own.numFeatures(), own.numClasses()))
    cut._resetUid(model.uid)
    return model._copyValues(cut)


def probabilities(margins: list, n: int) -> list:
    """Class probabilities from the members' margins; a class without a member has margin 0.

    One member (two classes) gives 1 / (1 + exp(-2 margin)) for the second class; several are renormalised."""
    ps = [F.lit(1.0) / (F.lit(1.0) + F.exp(m * -2.0)) for m in margins]
    if n == 2 and len(ps) == 1:
        return [F.lit(1.0) - ps[0], ps[0]]
    ps += [F.lit(0.5)] * (n - len(ps))
    total = sum(ps[1:], ps[0])
    return [p / total for p in ps]


@dataclass
class StoppedModel:
    """Members cut to one common round, with the validation loss after every round looked at."""

    members: list[GBTClassificationModel]
    n_classes: int
    rounds: int
    losses: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with a ``probability`` vector."""
        out = df
        for j, m in enumerate(self.members):
            out = m.copy().setRawPredictionCol(f"_raw{j}").setPredictionCol("").setProbabilityCol("").transform(out)
        margins = [F.get(vector_to_array(F.col(f"_raw{j}")), 1) for j in range(len(self.members))]
        return out.select(*df.columns, array_to_vector(F.array(*probabilities(margins, self.n_classes))).alias("probability"))


def members_of(model) -> list[GBTClassificationModel]:
    """The boosted models of a fitted pipeline, one-vs-rest model or single classifier, in class order."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    return [last] if isinstance(last, GBTClassificationModel) else list(last.models)


def staged_losses(members: list[GBTClassificationModel], valid: DataFrame, label: str, n: int, weight_col: str | None = None) -> list[float]:
    """Mean (weighted) log loss on ``valid`` after each round; empty without rows.  Rows with a null label or weight take no part."""
    out = valid
    for j, m in enumerate(members):
        out = m.copy().setLeafCol(f"_leaf{j}").setRawPredictionCol("").setPredictionCol("").setProbabilityCol("").transform(out)
    weight = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    rows = out.select(F.col(label).cast("int").alias("y"), weight.alias("w"), *[vector_to_array(f"_leaf{j}").alias(f"l{j}") for j in range(len(members))])
    rows = rows.where("y is not null and w is not null")
    rounds = min(m.getNumTrees for m in members)
    tables = []
    for m in members:
        leaves = [np.array(leaf_values(t)) * w for t, w in zip(m.trees[:rounds], m.treeWeights)]
        table = np.zeros((rounds, max(map(len, leaves))))
        for i, v in enumerate(leaves):
            table[i, : len(v)] = v
        tables.append(table)

    def sums(frames):
        total = np.zeros((rounds, 2))
        for batch in frames:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                y, w = part.column(0).to_numpy(), part.column(1).to_numpy()
                ps = np.full((n, len(y), rounds), 0.5)
                for j, table in enumerate(tables):
                    leaf = part.column(2 + j).flatten().to_numpy().reshape(len(y), -1)[:, :rounds].astype(np.int64)
                    margin = np.cumsum(table[np.arange(rounds), leaf], axis=1)
                    ps[j] = 1 / (1 + np.exp(-2 * margin))
                if n == 2 and len(tables) == 1:
                    ps = np.stack([1 - ps[0], ps[0]])
                own = ps[y, np.arange(len(y))] / ps.sum(axis=0)
                total[:, 0] -= w @ np.log(np.clip(own, FLOOR, 1.0))
                total[:, 1] += w.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(rounds, dtype=np.int32)), pa.array(total[:, 0].copy()), pa.array(total[:, 1].copy())], ["round", "loss", "mass"])

    found = rows.mapInArrow(sums, "round int, loss double, mass double").groupBy("round").agg(F.sum("loss").alias("loss"), F.sum("mass").alias("mass"))
    return [r.loss / r.mass for r in found.orderBy("round").collect() if r.mass]


def best_round(losses: list[float], patience: int) -> int:
    """The round (from 1) with the least loss before ``patience`` rounds in a row have brought nothing better; the first of equal ones."""
    best = 0
    for t, loss in enumerate(losses):
        if loss < losses[best]:
            best = t
        elif t - best >= patience:
            break
    return best + 1


def stop_early(model, valid: DataFrame, n: int, patience: int, label: str = "_y", weight_col: str | None = None) -> StoppedModel:
    """``model`` (boosted, for ``n`` classes) cut to the best round on ``valid``; uncut if that has no rows."""
    members = members_of(model)
    losses = staged_losses(members, valid, label, n, weight_col)
    rounds = best_round(losses, patience) if losses else min(m.getNumTrees for m in members)
    return StoppedModel([first_rounds(m, rounds) for m in members], n, rounds, losses)
