"""Model-job tests (R rows): shapes, probability invariants, no fold leak,
better than the class prior on the planted-signal frame."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from prismtab.constants import CLASSES
from prismtab.plans import oof as O
from prismtab.plans.q_models import FEATURES, model_frames


@pytest.fixture(scope="module")
def frames(spark):
    return model_frames(spark, SF_SMALL)


def test_oof_shapes_probabilities_and_signal(spark, frames):
    train, test = frames
    r = O.run_oof(train, test, FEATURES, "rf", {"numTrees": 10, "maxDepth": 4}, "l1__rf", k=3)
    cols = [f"l1__rf__{c}" for c in CLASSES]
    oof = r.oof.collect()
    assert len(oof) == train.count()
    assert len({row["id"] for row in oof}) == len(oof)          # each row validated exactly once
    assert all(abs(sum(row[c] for c in cols) - 1.0) < 1e-6 for row in oof)
    assert r.test.count() == test.count()
    overall = r.scores.where(F.col("fold") == "overall").first()
    prior = max(train.groupBy("class").count().collect(), key=lambda x: x["count"])["count"] / train.count()
    assert overall["accuracy"] > prior + 0.1


def test_fold_model_never_saw_its_rows(spark, frames):
    train, _ = frames
    prepared = O.prepare(train, FEATURES, k=3)
    folds = {r["id"]: r["fold"] for r in prepared.select("id", "fold").collect()}
    r = O.run_oof(train, None, FEATURES, "lr", {"maxIter": 30}, "m", k=3, prepared=prepared)
    got = {row["id"]: row["fold"] for row in r.oof.select("id", "fold").collect()}
    assert got == folds


def test_local_binary_covers_all_rows(spark, frames):
    train, test = frames
    tr, te, met = O.local_binary_model(train, test, FEATURES, "GALAXY", "STAR", "gbt", {"maxIter": 5}, k=3)
    assert tr.count() == train.count() and te.count() == test.count()
    assert tr.where(F.col("p_binary").isNull()).count() == 0
    assert met.count() == 3


def test_weight_replication_is_deterministic(spark):
    df = spark.range(1000).withColumn("w", F.lit(1.5))
    a = O.replicate_by_weight(df, "w").count()
    b = O.replicate_by_weight(df, "w").count()
    assert a == b and 1400 < a < 1600


def test_greedy_selection_drops_correlated(spark):
    board = spark.createDataFrame([("a", 0.9, 0.9, 0.9), ("b", 0.8, 0.8, 0.8), ("c", 0.7, 0.7, 0.7)],
                                  "model string, accuracy double, balanced_accuracy double, weighted_accuracy double")
    corr = spark.createDataFrame([(x, y, 1.0 if x == y or {x, y} == {"a", "b"} else 0.1)
                                  for x in "abc" for y in "abc"], "model_a string, model_b string, corr double")
    out = {r["model"]: r for r in O.select_diverse_models(board, corr, 0.99).collect()}
    assert out["a"]["selected"] and not out["b"]["selected"] and out["c"]["selected"]
    assert out["b"]["drop_reason"].startswith("corr>=")


@pytest.fixture(scope="module")
def rough(spark):
    """Features with NULL, NaN, a constant NULL column and strings; the class follows from x and s with some noise."""
    h = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    rows = spark.range(400).withColumn("x", F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 13 == 0, float("nan")).otherwise(h))
    rows = rows.withColumn("s", F.when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 3)))
    rows = rows.withColumn("none", F.lit(None).cast("double")).withColumn("n", (F.col("id") % 5).cast("int"))
    noisy = F.when(F.col("id") % 10 == 0, h).otherwise(F.coalesce(F.nanvl("x", F.lit(0.5)), F.lit(0.5)))
    rows = rows.withColumn("class", F.when(noisy < 0.33, "GALAXY").when(noisy < 0.66, "QSO").otherwise("STAR"))
    return rows.withColumn("w", F.when(F.col("class") == "STAR", 4.6).when(F.col("class") == "QSO", 3.2).otherwise(1.0))


@pytest.mark.parametrize("family, params", [("rf", {"numTrees": 4}), ("gbt", {"maxIter": 2}), ("lr", {"maxIter": 20}), ("mlp", {"maxIter": 10, "hidden": [4]})])
def test_rough_features_and_weights(spark, rough, family, params):
    test = rough.drop("class", "w").withColumn("s", F.when(F.col("id") % 2 == 0, "unseen").otherwise(F.col("s")))
    r = O.run_oof(rough, test, ["x", "s", "none", "n"], family, params, "m", k=2, weight_col="w")
    cols = [f"m__{c}" for c in CLASSES]
    for frame in (r.oof, r.test):
        assert frame.count() == 400
        assert frame.where(F.abs(sum(F.col(c) for c in cols) - 1) > 1e-6).count() == 0
    assert r.scores.where("fold = 'overall'").first()["accuracy"] > 0.4


def test_a_weight_of_two_is_a_doubled_row(spark, rough):
    fit = dict(family="lr", params={"maxIter": 100, "regParam": 0.01, "standardization": False})
    vec = O.fit_vectoriser(rough, ["x", "n"])
    base = vec.transform(rough).withColumn("_y", F.when(F.col("class") == "GALAXY", 0.0).when(F.col("class") == "QSO", 1.0).otherwise(2.0))
    twice = base.withColumn("w", F.when(F.col("class") == "STAR", 2.0).otherwise(1.0))
    doubled = base.unionByName(base.where("class = 'STAR'"))
    a = O.make_estimator(**fit, weight_col="w")[0].fit(twice).coefficientMatrix.toArray()
    b = O.make_estimator(**fit)[0].fit(doubled).coefficientMatrix.toArray()
    assert abs(a - b).max() < 1e-4


def test_holdout_ranks_its_rows_once(spark, frames, monkeypatch):
    train, test = frames
    ranked, written = [], []
    cut = O.cut_lineage
    monkeypatch.setattr(O, "cut_lineage", lambda df: written.append(df.columns) or cut(df))
    fit = O.Pipeline.fit
    monkeypatch.setattr(O.Pipeline, "fit", lambda self, df: ranked.append("Window" in df._jdf.queryExecution().optimizedPlan().toString()) or fit(self, df))
    metrics, pred = O.holdout_baseline(train, test, FEATURES, "rf", {"numTrees": 3, "maxDepth": 2})
    assert ranked == [False, False] and len(written) == 1
    assert pred.count() == test.count() and metrics.first()["n"] > 0


def test_scores_are_those_of_plain_metrics(spark):
    from prismtab.operators.metrics import log_loss, prediction_metrics

    rows = [(i % 3, (*CLASSES, None)[i % 4], float(i % 7), float(i % 5), i % 2 + 0.5) for i in range(200)]
    oof = spark.createDataFrame(rows, "fold int, class string, p0 double, p1 double, p2 double")
    got = {r.fold: r for r in O.oof_scores(oof, "class", ["p0", "p1", "p2"]).collect()}
    assert set(got) == {"0", "1", "2", "overall"}
    from prismtab.functions.proba import argmax_class

    for fold, r in got.items():
        part = oof.withColumn("pred", argmax_class(["p0", "p1", "p2"])).where(F.lit(True) if fold == "overall" else F.col("fold") == int(fold))
        plain = prediction_metrics(part, "class", "pred", absent="skip").first()
        assert all(abs(r[c] - plain[c]) < 1e-12 for c in ("n", "accuracy", "balanced_accuracy", "weighted_accuracy"))
        assert abs(r.log_loss - log_loss(part, "class", ["p0", "p1", "p2"]).first().log_loss) < 1e-9


def test_inputs_of_a_job_are_prepared_once(spark, frames, monkeypatch):
    train, test = frames
    seen = []
    fit = O.fit_vectoriser
    monkeypatch.setattr(O, "fit_vectoriser", lambda *a: seen.append(a[1]) or fit(*a))
    wanted = ["u", "redshift"]
    lr = {"family": "lr", "params": {"maxIter": 2}}
    _, _, board = O.run_suite(train, test, [{"name": n, "features": f, **lr} for n, f in (("a", wanted), ("b", wanted), ("c", ["g"]))], k=2)
    assert seen == [wanted, ["g"]] and board.count() == 3
    seen.clear()
    O.lr_stacker(train, test, wanted, c_values=(0.1, 1.0), k=2)
    assert seen == [wanted]
    seen.clear()
    O.hyperparameter_sweep(train, {"x": wanted}, [{**lr, "variant": v} for v in "ab"], k=2)
    assert seen == [wanted]


def test_pairwise_blocks_rank_no_rows(spark, monkeypatch):
    """The metrics of the pair models are no part of the blocks; the AUC among them sorts all scored rows."""
    from prismtab.operators import metrics
    from prismtab.plans import q_models

    monkeypatch.setattr(metrics, "roc_auc", lambda *a, **k: pytest.fail("metrics that nobody reads"))
    out = q_models.q_pairwise(spark, SF_SMALL)
    rows = out.groupBy("split").count().collect()
    assert {r["split"] for r in rows} == {"train", "test"}
    assert out.where(F.abs(sum(F.col(f"blend_050__{c}") for c in CLASSES) - 1) > 1e-5).count() == 0
