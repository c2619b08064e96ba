"""K-05: staged losses and common stopping rounds of boosted one-vs-rest models."""

import math

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from conftest import SF_SMALL
from prismtab.constants import CLASSES
from prismtab.operators.metrics import log_loss
from prismtab.plans import early_stopping as S
from prismtab.plans import oof as O
from prismtab.plans.q_models import FEATURES, model_frames

FAST = {"maxIter": 8, "maxDepth": 3, "stepSize": 0.8}


@pytest.fixture(scope="module")
def prepared(spark):
    return O.prepare(model_frames(spark, SF_SMALL)[0], FEATURES, k=3)


@pytest.fixture(scope="module")
def fitted(prepared):
    return Pipeline(stages=O.make_estimator("gbt", FAST, None, 42, len(FEATURES), 3)).fit(prepared.where("fold <> 0"))


def loss_of(model, rows):
    names = [f"p__{c}" for c in CLASSES]
    out = model.transform(rows)
    out = out.select("class", *[p.alias(n) for p, n in zip(O._proba_exprs(out, 3), names)])
    return log_loss(out, "class", names).first()["log_loss"]


def test_staged_losses_are_those_of_the_cut_models(prepared, fitted):
    valid, members = prepared.where("fold = 0"), S.members_of(fitted)
    losses = S.staged_losses(members, valid, "_y", 3)
    assert len(losses) == FAST["maxIter"]
    for rounds in (1, 3, FAST["maxIter"]):
        cut = S.StoppedModel([S.first_rounds(m, rounds) for m in members], 3, rounds, losses)
        assert all(m.getNumTrees == rounds for m in cut.members)
        assert math.isclose(loss_of(cut, valid), losses[rounds - 1], rel_tol=1e-9)
    assert math.isclose(loss_of(fitted, valid), losses[-1], rel_tol=1e-9)  # all rounds: the uncut pipeline's own


def test_weights_count_in_the_staged_losses(prepared, fitted):
    valid, members = prepared.where("fold = 0"), S.members_of(fitted)
    only = valid.withColumn("w", F.when(F.col("class") == "STAR", 2.0).otherwise(0.0))
    want = S.staged_losses(members, valid.where("class = 'STAR'"), "_y", 3)
    assert S.staged_losses(members, only, "_y", 3, "w") == pytest.approx(want)


def test_a_fold_without_rows_leaves_all_rounds(prepared, fitted):
    kept = S.stop_early(fitted, prepared.where("false"), 3, 2)
    assert kept.rounds == FAST["maxIter"] and kept.losses == []


def test_best_round():
    assert S.best_round([3.0, 2.0, 2.0, 2.5, 1.0], 2) == 2      # the first of equal ones; the later one is not reached
    assert S.best_round([3.0, 2.0, 2.0, 2.5, 1.0], 3) == 5
    assert S.best_round([1.0], 1) == 1
    assert S.best_round([3.0, 2.0, 1.0], 1) == 3


def test_rounds_after_the_stop_change_nothing(spark, prepared):
    train, test = model_frames(spark, SF_SMALL)
    short, long = (O.run_oof(train, test, FEATURES, "gbt", {**FAST, "maxIter": n}, "m", k=3, prepared=prepared, patience=1) for n in (8, 12))
    assert [m.rounds for m in short.stopped] == [m.rounds for m in long.stopped]
    assert all(m.rounds < 8 for m in short.stopped)              # each fold did stop
    for a, b in ((short.oof, long.oof), (short.test, long.test)):
        assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}


def test_two_classes_have_one_member(spark, prepared):
    pair = prepared.where("class <> 'QSO'").withColumn("_y", (F.col("class") == "STAR").cast("double"))
    model = Pipeline(stages=O.make_estimator("gbt", FAST, None, 42, len(FEATURES), 2)).fit(pair.where("fold <> 0"))
    valid = pair.where("fold = 0")
    stopped = S.stop_early(model, valid, 2, 2)
    p = stopped.transform(valid).select("_y", *[c.alias(f"p{j}") for j, c in enumerate(O._proba_exprs(stopped.transform(valid), 2))]).collect()
    mean = -sum(math.log(r.p1 if r._y else r.p0) for r in p) / len(p)
    assert math.isclose(mean, stopped.losses[stopped.rounds - 1], rel_tol=1e-9)


def test_patience_is_for_boosted_models(spark, prepared):
    with pytest.raises(ValueError):
        O.run_oof(model_frames(spark, SF_SMALL)[0], None, FEATURES, "rf", k=3, prepared=prepared, patience=3)
