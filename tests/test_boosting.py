"""Boosted models of all folds in common passes: the same trees, losses and probabilities as ``pyspark.ml`` fold by fold."""

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from prismtab.constants import CLASSES
from prismtab.plans import boosting as B
from prismtab.plans import early_stopping as S
from prismtab.plans import oof as O

PARAMS = {"maxIter": 5, "maxDepth": 3, "stepSize": 0.7}
NAMES = ["a", "b", "c", "same"]


def frame(spark, rows=900):
    """Numbers without an order; the class follows from two of them in part, one column repeats another and one is constant."""
    def h(salt):
        return F.pmod(F.xxhash64(F.lit(salt), F.col("id")), F.lit(100003)) / 100003.0

    df = spark.range(rows).withColumns({"a": h("a"), "b": F.round(h("b") * 6), "c": h("c"), "same": h("a") * 2})
    noisy = F.when(h("n") < 0.2, h("m")).otherwise(F.col("a") * 0.7 + F.col("b") / 20)
    return df.withColumns({"class": F.when(noisy < 0.35, "GALAXY").when(noisy < 0.6, "QSO").otherwise("STAR"), "still": F.lit(3.0)})


def one_by_one(prepared, f, features):
    model = Pipeline(stages=O.make_estimator("gbt", PARAMS, None, 42, len(features), 3)).fit(prepared.where(F.col("fold") != f))
    members = S.members_of(model)
    return members, S.staged_losses(members, prepared.where(F.col("fold") == f), "_y", 3)


def together(prepared, patience=None, k=3):
    gbt = O.make_estimator("gbt", PARAMS, None, 42, 4, 3)[0].getClassifier()
    return B.boost_folds(gbt, prepared, k, 3, patience)


def probabilities(members, rows, n=3):
    out = S.StoppedModel(members, n, PARAMS["maxIter"], []).transform(rows)
    return {r.id: r.probability.toArray() for r in out.select("id", "probability").collect()}


def splits(member):
    """All trees' (feature, threshold), leaves None, from left to right."""
    def walk(node):
        if node.getClass().getSimpleName() == "LeafNode":
            return [None]
        return [(node.split().featureIndex(), node.split().threshold()), *walk(node.leftChild()), *walk(node.rightChild())]

    return [walk(t._java_obj.rootNode()) for t in member.trees]


@pytest.mark.parametrize("block", [32768, 50])
def test_members_are_those_of_pyspark_ml(spark, monkeypatch, block):
    monkeypatch.setattr(B, "BLOCK", block)
    features = [*NAMES, "still"]
    prepared = O.prepare(frame(spark), features, k=3)
    for f, stopped in enumerate(together(prepared, patience=PARAMS["maxIter"])):
        members, losses = one_by_one(prepared, f, features)
        assert stopped.losses == pytest.approx(losses, rel=1e-9)
        assert stopped.rounds == S.best_round(losses, PARAMS["maxIter"])
        want = [S.first_rounds(m, stopped.rounds) for m in members]
        assert [splits(m) for m in stopped.members] == [splits(m) for m in want]
        assert [m.treeWeights for m in stopped.members] == [m.treeWeights for m in want]
        got, plain = probabilities(stopped.members, prepared), probabilities(want, prepared)
        assert max(abs(got[i] - plain[i]).max() for i in plain) < 1e-9


def test_all_rounds_without_patience(spark):
    prepared = O.prepare(frame(spark), NAMES, k=3)
    for f, model in enumerate(together(prepared)):
        members, _ = one_by_one(prepared, f, NAMES)
        assert model.rounds == PARAMS["maxIter"] and model.losses == []
        assert [splits(m) for m in model.members] == [splits(m) for m in members]


def test_missing_labels_and_a_class_of_one_fold(spark):
    """Fit rows without the last class have two members; a missing class (code -1) and a null label are no member's own."""
    rows = frame(spark).withColumn("fold", (F.col("id") % 3).cast("int"))
    rows = rows.withColumn("class", F.when(F.col("id") % 31 == 0, None).when((F.col("class") == "STAR") & (F.col("fold") != 1), "QSO").otherwise(F.col("class")))
    prepared = O.prepare(rows, NAMES, fold_col="fold").withColumn("_y", F.when(F.col("id") % 62 != 0, F.col("_y")))
    found = together(prepared, patience=PARAMS["maxIter"])
    assert [len(m.members) for m in found] == [3, 2, 3]
    for f, stopped in enumerate(found):
        members, losses = one_by_one(prepared, f, NAMES)
        assert len(members) == len(stopped.members)
        assert stopped.losses == pytest.approx(losses, rel=1e-9)


def test_folds_of_boosted_models_are_fitted_together(spark, monkeypatch):
    """One pass serves a level of all members' trees; before, every member had passes of its own."""
    monkeypatch.setattr(O.Pipeline, "fit", lambda *a: pytest.fail("a member fitted on its own"))
    train = frame(spark)
    for patience in (None, 2):
        r = O.run_oof(train, train.drop("class"), NAMES, "gbt", PARAMS, "m", k=3, patience=patience)
        assert len(r.stopped) == (3 if patience else 0)
        for out in (r.oof, r.test):
            assert out.count() == 900
            assert out.where(F.abs(sum(F.col(f"m__{c}") for c in CLASSES) - 1) > 1e-6).count() == 0


def test_strings_and_weights_are_left_to_pyspark_ml(spark):
    train = frame(spark).withColumns({"s": F.concat(F.lit("k"), F.col("id") % 3), "w": F.lit(2.0)})
    gbt = O.make_estimator("gbt", PARAMS, None, 42, 2, 3)[0].getClassifier()
    weighted = O.make_estimator("gbt", PARAMS, "w", 42, 2, 3)[0].getClassifier()
    numbers, strings = O.prepare(train, ["a", "b"], k=3, weight_col="w"), O.prepare(train, ["a", "s"], k=3)
    assert B.can_boost(gbt, numbers, 2, 9)
    assert not B.can_boost(gbt, strings, 2, 9) and not B.can_boost(weighted, numbers, 2, 9)
    assert not B.can_boost(gbt.copy().setMaxDepth(20), numbers, 2, 9)
