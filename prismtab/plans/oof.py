"""Model jobs on ``pyspark.ml`` (K-01..K-12, I-06, G-06, G-07, B-33).

Every fit is a distributed ``pyspark.ml`` fit on the fold's rows; the
driver only loops over folds / parameter points (k and grid sizes are
parameters, not data sizes).  The fold-assigned feature table is cut from
its lineage once (reliable checkpoint in the shared checkpoint folder) and
reused by every fit, so a lost executor recomputes from the checkpoint, not
from the raw scan.

Class codes are positions in ``classes`` and are used directly as the label
index, so probability vector slot j is class j (B-33 alignment).
"""

from __future__ import annotations

import os
import time
from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prismtab.constants import CLASSES
from prismtab.functions.proba import class_code
from prismtab.operators.folds import stratified_folds
from prismtab.operators.metrics import log_loss, metrics_from_cells, prediction_metrics, row_log_loss
from prismtab.plans.boosting import boost_folds, can_boost
from prismtab.plans.early_stopping import stop_early
from prismtab.session import cut_lineage

FEATURES = "_features"
LABEL = "_y"


# ---------------------------------------------------------------- K-03/K-04 families
def make_estimator(family: str, params: dict | None = None, weight_col: str | None = None, seed: int = 42,
                   n_features: int | None = None, n_classes: int = 3):
    """K-03 tree ensembles, K-04 MLP, logistic regression; binary GBT is
    wrapped in one-vs-rest for multiclass use.  Returns a Pipeline stage list."""
    p = dict(params or {})
    common = dict(featuresCol=FEATURES, labelCol=LABEL)
    if family == "rf":
        est = RandomForestClassifier(seed=seed, numTrees=p.get("numTrees", 30), maxDepth=p.get("maxDepth", 6),
                                     subsamplingRate=p.get("subsamplingRate", 1.0), **common)
        if weight_col:
            est.setWeightCol(weight_col)
        return [est]
    if family == "gbt":
        gbt = GBTClassifier(seed=seed, maxIter=p.get("maxIter", 20), maxDepth=p.get("maxDepth", 4),
                            stepSize=p.get("stepSize", 0.1), **common)
        if weight_col:
            gbt.setWeightCol(weight_col)
        if n_classes == 2:
            return [gbt]
        # one binary model per class, fitted concurrently; the wrapper passes its own weight column on
        each = OneVsRest(classifier=gbt, parallelism=n_classes, **common)
        if weight_col:
            each.setWeightCol(weight_col)
        return [each]
    if family == "lr":
        est = LogisticRegression(maxIter=p.get("maxIter", 200), regParam=p.get("regParam", 0.0),
                                 elasticNetParam=0.0, standardization=p.get("standardization", True),
                                 family="multinomial" if n_classes > 2 else "binomial", **common)
        if weight_col:
            est.setWeightCol(weight_col)
        return [est]
    if family == "mlp":
        scaler = StandardScaler(inputCol=FEATURES, outputCol="_scaled", withMean=True, withStd=True)
        hidden = list(p.get("hidden", [16]))
        mlp = MultilayerPerceptronClassifier(featuresCol="_scaled", labelCol=LABEL, seed=seed,
                                             maxIter=p.get("maxIter", 100),
                                             layers=[n_features, *hidden, n_classes])
        return [scaler, mlp]
    raise ValueError(f"unknown model family {family!r}")


def replicate_by_weight(df: DataFrame, weight_col: str, id_col: str = "id") -> DataFrame:
    """K-04: weights for learners without ``weightCol`` (MLP): each row is
    repeated floor(w) times plus one more with probability frac(w), the coin
    taken from a hash of the id (deterministic, no sampling randomness)."""
    w = F.col(weight_col)
    frac = w - F.floor(w)
    coin = (F.abs(F.xxhash64(F.col(id_col), F.lit("replicate"))) % 1000000) / F.lit(1e6)
    copies = F.floor(w).cast("int") + F.when(coin < frac, 1).otherwise(0)
    return df.withColumn("_copies", copies).where(F.col("_copies") > 0).withColumn(
        "_rep", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies", "_rep")


def _proba_cols(pred: DataFrame, n: int) -> list:
    return [x.alias(f"_p{j}") for j, x in enumerate(_proba_exprs(pred, n))]


def _proba_exprs(pred: DataFrame, n: int) -> list:
    if "probability" in pred.columns:
        arr = vector_to_array(F.col("probability"))
        return [F.coalesce(F.get(arr, j), F.lit(0.0)) for j in range(n)]
    # one-vs-rest over GBT: rawPrediction holds each binary model's margin m;
    # GBT's positive-class probability is 1 / (1 + exp(-2m)); renormalise
    raw = vector_to_array(F.col("rawPrediction"))
    ps = [F.lit(1.0) / (F.lit(1.0) + F.exp(F.coalesce(F.get(raw, j), F.lit(0.0)) * -2.0)) for j in range(n)]
    tot = ps[0]
    for x in ps[1:]:
        tot = tot + x
    return [x / tot for x in ps]


MODEL_OUTPUTS = ("probability", "rawPrediction", "prediction", "_scaled")
FIT_THREADS = int(os.environ.get("PRISMTAB_FIT_THREADS", "3"))


def fit_folds(fit_one, k: int, threads: int | None = None) -> list:
    """Fit the k fold models, submitting up to ``threads`` distributed fits at
    once from a small driver thread pool (each fit is its own Spark job set;
    concurrent jobs keep executors busy between the short stages of small
    fits).  Results are returned in fold order."""
    n = max(1, min(k, threads or FIT_THREADS))
    if n == 1:
        return [fit_one(f) for f in range(k)]
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=n) as pool:
        return list(pool.map(fit_one, range(k)))


def average_over_models(frame: DataFrame, models: list, n: int, id_col: str, names: list[str],
                        positive_only: bool = False) -> DataFrame:
    """Mean prediction of several fitted models on the same rows, without a
    shuffle: the models are applied one after another to the same frame
    (each adds its probability columns, the model outputs are dropped before
    the next), then averaged in a projection."""
    cur = frame
    for f, m in enumerate(models):
        out = m.transform(cur)
        if positive_only:
            cols = [F.get(vector_to_array(F.col("probability")), 1).alias(f"_m{f}_p0")]
        else:
            cols = [x.alias(f"_m{f}_p{j}") for j, x in enumerate(_proba_exprs(out, n))]
        cur = out.select(*[c for c in cur.columns], *cols)
    k = len(models)
    width = 1 if positive_only else n
    avg = []
    for j in range(width):
        tot = F.col(f"_m0_p{j}")
        for f in range(1, k):
            tot = tot + F.col(f"_m{f}_p{j}")
        avg.append((tot / F.lit(float(k))).alias(names[j]))
    return cur.select(id_col, *avg)


@dataclass
class OOFResult:
    oof: DataFrame      # id, class, fold, <prefix>__<CLASS>...
    test: DataFrame     # id, <prefix>__<CLASS>... (mean over fold models)
    scores: DataFrame   # fold (1..k or 'overall'), accuracy, balanced_accuracy, log_loss
    seconds: list = field(default_factory=list)
    stopped: list = field(default_factory=list)  # K-05: each fold's StoppedModel


@dataclass
class Vectoriser:
    """Model input of a table: numeric columns with the training medians for NULL and NaN, string columns as codes
    (B-34..B-37; unseen and NULL strings share one more code), assembled in the order of ``features``."""

    features: list[str]
    medians: dict[str, float]
    indexer: StringIndexerModel | None

    def transform(self, df: DataFrame) -> DataFrame:
        def filled(c: str):
            x = F.col(c).cast("double")
            return F.when(x.isNotNull() & ~F.isnan(x), x).otherwise(F.lit(self.medians[c]))

        out = df.withColumns({f"_in_{c}": filled(c) for c in self.medians})
        out = self.indexer.transform(out) if self.indexer else out
        ready = VectorAssembler(inputCols=[f"_in_{c}" for c in self.features], outputCol=FEATURES).transform(out)
        return ready.drop(*[f"_in_{c}" for c in self.features])


def fit_vectoriser(train: DataFrame, features: list[str], relative_error: float = 0.001) -> Vectoriser:
    """Medians (within ``relative_error`` ranks; 0 for a column of NULLs) and string codes of the training table, one job each."""
    strings = [c for c in features if dict(train.dtypes)[c] == "string"]
    numbers = [c for c in features if c not in strings]
    found = train.select(*[F.col(c).cast("double") for c in numbers]).approxQuantile(numbers, [0.5], relative_error) if numbers else []
    indexer = None
    if strings:
        indexer = StringIndexer(inputCols=strings, outputCols=[f"_in_{c}" for c in strings], handleInvalid="keep").fit(train)
    return Vectoriser(list(features), {c: q[0] if q else 0.0 for c, q in zip(numbers, found)}, indexer)


def prepare(train: DataFrame, features: list[str], label: str = "class", k: int = 5, seed: int = 42,
            fold_col: str | None = None, weight_col: str | None = None, id_col: str = "id",
            classes=CLASSES, checkpoint: bool = True, vectoriser: Vectoriser | None = None) -> DataFrame:
    """Fold assignment (F-02) + label code + feature vector, materialised once."""
    vectoriser = vectoriser or fit_vectoriser(train, features)
    df = train if fold_col else stratified_folds(train, label, k, id_col, seed, name="fold")
    fold = fold_col or "fold"
    keep = [id_col, label, fold] + ([weight_col] if weight_col else [])
    out = vectoriser.transform(df.withColumn(LABEL, class_code(F.col(label), classes).cast("double"))).select(
        *keep, LABEL, FEATURES)
    if fold != "fold":
        out = out.withColumnRenamed(fold, "fold")
    return cut_lineage(out) if checkpoint else out


def run_oof(train: DataFrame, test: DataFrame | None, features: list[str], family: str = "rf",
            params: dict | None = None, prefix: str = "l1__model", label: str = "class", k: int = 5,
            seed: int = 42, weight_col: str | None = None, id_col: str = "id", classes=CLASSES,
            prepared: DataFrame | None = None, patience: int | None = None,
            vectoriser: Vectoriser | None = None) -> OOFResult:
    """K-01: k-fold out-of-fold probabilities.  Each validation row gets the
    probability of the model that did not see it; test rows get the mean over
    the k fold models.  Per-fold and overall metrics (E-03/E-05).

    With ``patience`` (K-05, family ``gbt``) every fold's model ends at the round with the least multiclass log loss on
    its validation fold, as soon as so many further rounds bring nothing better.

    The folds' boosted models are fitted in common passes (``boosting``), if the features are numbers and there are no weights."""
    if patience is not None and (family != "gbt" or patience < 1):
        raise ValueError("patience is a positive number of rounds of the family gbt")
    n = len(classes)
    if vectoriser is None and (prepared is None or test is not None):
        vectoriser = fit_vectoriser(train, features)
    base = prepared if prepared is not None else prepare(train, features, label, k, seed, None, weight_col, id_col,
                                                          classes, vectoriser=vectoriser)
    stages = make_estimator(family, params, weight_col, seed, len(features), n)
    tv = None
    if test is not None:
        tv = vectoriser.transform(test).select(
            id_col, FEATURES)
    def fit_one(f):
        t0 = time.time()
        fit_rows = base.where(F.col("fold") != f)
        if family == "mlp" and weight_col:
            fit_rows = replicate_by_weight(fit_rows, weight_col, id_col)
        model = Pipeline(stages=[st.copy() for st in stages]).fit(fit_rows)
        if patience is not None:
            model = stop_early(model, base.where(F.col("fold") == f), n, patience, LABEL, weight_col)
        return model, time.time() - t0

    if family == "gbt" and n > 2 and can_boost(stages[0].getClassifier(), base, len(features), k * n):
        t0 = time.time()
        models = boost_folds(stages[0].getClassifier(), base, k, n, patience)
        secs = [(time.time() - t0) / k] * k
    else:
        fitted = fit_folds(fit_one, k)
        models = [m for m, _ in fitted]
        secs = [t for _, t in fitted]
    oofs = []
    for f, model in enumerate(models):
        va = model.transform(base.where(F.col("fold") == f))
        oofs.append(va.select(id_col, label, "fold", *_proba_cols(va, n)))
    oof = oofs[0]
    for o in oofs[1:]:
        oof = oof.unionByName(o)
    names = [f"{prefix}__{c}" for c in classes]
    oof = oof.select(id_col, label, "fold", *[F.col(f"_p{j}").alias(names[j]) for j in range(n)])
    test_out = average_over_models(tv, models, n, id_col, names) if tv is not None else None
    return OOFResult(oof, test_out, oof_scores(oof, label, names, classes), secs, models if patience is not None else [])


def oof_scores(oof: DataFrame, label: str, prob_cols: list[str], classes=CLASSES) -> DataFrame:
    """Per-fold and overall accuracy / balanced accuracy / log loss."""
    from prismtab.functions.proba import argmax_class

    p = oof.withColumn("_pred", argmax_class(prob_cols, classes))
    # one pass over the rows; folds and overall are sums of the same cells
    cells = p.groupBy(F.col("fold").cast("string").alias("fold"), F.col(label).alias("true_class"), F.col("_pred").alias("pred_class")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_log_loss(label, prob_cols, classes)).alias("_loss"))
    both = cells.withColumn("fold", F.explode(F.array(F.col("fold"), F.lit("overall"))))
    scores = metrics_from_cells(both, by=("fold",), classes=classes, absent="skip",
                                extra_aggs=[(F.sum("_loss") / F.sum("n")).alias("log_loss")], extra_cols=[F.col("log_loss")])
    return scores.select("fold", "n", "accuracy", "balanced_accuracy", "weighted_accuracy", "log_loss")


# ---------------------------------------------------------------- K-02
def run_suite(train: DataFrame, test: DataFrame, experiments: list[dict], label: str = "class", k: int = 5,
              seed: int = 42, id_col: str = "id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """K-02: several experiments (name, family, features, params) → wide OOF
    train table, wide test table, leaderboard ranked by log loss."""
    wide_tr = wide_te = board = None
    inputs: dict[tuple, tuple] = {}  # experiments on the same columns read one prepared table
    for exp in experiments:
        weight = exp.get("weight_col")
        own = (*exp["features"], weight)
        if own not in inputs:
            vectoriser = fit_vectoriser(train, exp["features"])
            inputs[own] = vectoriser, prepare(train, exp["features"], label, k, seed, None, weight, id_col, vectoriser=vectoriser)
        vectoriser, prepared = inputs[own]
        r = run_oof(train, test, exp["features"], exp["family"], exp.get("params"), f"l1__{exp['name']}", label, k,
                    seed, weight, id_col, prepared=prepared, vectoriser=vectoriser)
        tr = r.oof.drop("fold")
        wide_tr = tr if wide_tr is None else wide_tr.join(tr.drop(label), id_col)
        wide_te = r.test if wide_te is None else wide_te.join(r.test, id_col)
        s = r.scores.where(F.col("fold") == "overall").withColumns(
            {"experiment": F.lit(exp["name"]), "model_type": F.lit(exp["family"])})
        board = s if board is None else board.unionByName(s)
    board = board.orderBy(F.asc("log_loss"), F.desc("accuracy"), F.asc("experiment"))
    return wide_tr, wide_te, board


# ---------------------------------------------------------------- K-06 / K-07
def lr_stacker(train: DataFrame, test: DataFrame, features: list[str], c_values=(0.03, 0.1, 0.3, 1.0),
               label: str = "class", k: int = 5, seed: int = 42, weight_col: str | None = None,
               id_col: str = "id", classes=CLASSES):
    """K-06: multinomial logistic regression over stack features for each C;
    sklearn's L2 strength maps to ``regParam = 1 / (C * sum of fit weights)``
    with ``standardization=False``.  Selects by overall log loss (or by
    weighted accuracy when class-weighted).  Returns (best C, OOF result, scores)."""
    vectoriser = fit_vectoriser(train, features)
    prepared = prepare(train, features, label, k, seed, None, weight_col, id_col, classes, vectoriser=vectoriser)
    # weights (1 each, if there are none) of the rows that one fold's model is fitted on, on average
    mass = F.sum(F.col(weight_col).cast("double")) if weight_col else F.count(F.lit(1)).cast("double")
    fit_mass = prepared.agg(mass).first()[0] * (k - 1) / k
    results = []
    best = None
    for c in c_values:
        reg = 1.0 / (float(c) * fit_mass)
        r = run_oof(train, test, features, "lr", {"regParam": reg, "standardization": False, "maxIter": 300},
                    "lr_logits", label, k, seed, weight_col, id_col, classes, prepared=prepared, vectoriser=vectoriser)
        row = r.scores.where(F.col("fold") == "overall").first().asDict()
        results.append((float(c), row))
        key = -row["weighted_accuracy"] if weight_col else row["log_loss"]
        if best is None or key < best[0]:
            best = (key, float(c), r)
    spark = train.sparkSession
    scores = spark.createDataFrame([(c, r["accuracy"], r["balanced_accuracy"], r["weighted_accuracy"], r["log_loss"])
                                    for c, r in results],
                                   "C double, accuracy double, balanced_accuracy double, weighted_accuracy double, "
                                   "log_loss double")
    return best[1], best[2], scores


# ---------------------------------------------------------------- K-09
def two_stage_classifier(train: DataFrame, test: DataFrame, features: list[str], family: str = "gbt",
                         params: dict | None = None, label: str = "class", k: int = 5, seed: int = 42,
                         id_col: str = "id") -> OOFResult:
    """K-09: QSO vs OTHER on all rows and STAR vs GALAXY on non-QSO rows per
    fold, combined by the chain rule (B-25)."""
    from prismtab.functions.proba import combined_two_stage

    vectoriser = fit_vectoriser(train, features)
    base = prepare(train, features, label, k, seed, None, None, id_col, vectoriser=vectoriser)
    tv = vectoriser.transform(test).select(
        id_col, FEATURES)
    def both(frame, keep, pairs):
        """Apply (QSO model, STAR model) pairs in sequence on the same rows and
        average their positive probabilities (no join, no shuffle)."""
        cur = frame
        for j, (mq, ms) in enumerate(pairs):
            o = mq.transform(cur)
            cur = o.select(*cur.columns, F.get(vector_to_array("probability"), 1).alias(f"_q{j}"))
            o = ms.transform(cur)
            cur = o.select(*cur.columns, F.get(vector_to_array("probability"), 1).alias(f"_s{j}"))
        m = float(len(pairs))
        pq = sum((F.col(f"_q{j}") for j in range(1, len(pairs))), F.col("_q0")) / m
        ps = sum((F.col(f"_s{j}") for j in range(1, len(pairs))), F.col("_s0")) / m
        return cur.select(*keep, pq.alias("_pq"), ps.alias("_ps"))

    def fit_pair(f):
        fit = base.where(F.col("fold") != f)
        q_rows = fit.withColumn(LABEL, (F.col(label) == "QSO").cast("double"))
        s_rows = fit.where(F.col(label) != "QSO").withColumn(LABEL, (F.col(label) == "STAR").cast("double"))
        mq = Pipeline(stages=make_estimator(family, params, None, seed + f, len(features), 2)).fit(q_rows)
        ms = Pipeline(stages=make_estimator(family, params, None, seed + 100 + f, len(features), 2)).fit(s_rows)
        return mq, ms

    pairs = fit_folds(fit_pair, k)
    oofs = [both(base.where(F.col("fold") == f), [id_col, label, "fold"], [pair]) for f, pair in enumerate(pairs)]
    names = [f"two_stage__{c}" for c in CLASSES]

    def combine(df, keep):
        p = combined_two_stage(F.col("_pq"), F.col("_ps"))
        return df.select(*keep, *[x.alias(n) for x, n in zip(p, names)])
    oof = oofs[0]
    for o in oofs[1:]:
        oof = oof.unionByName(o)
    oof = combine(oof, [id_col, label, "fold"])
    test_out = combine(both(tv, [id_col], pairs), [id_col])
    return OOFResult(oof, test_out, oof_scores(oof, label, names))


# ---------------------------------------------------------------- K-10 / K-05
def local_binary_model(train: DataFrame, test: DataFrame, features: list[str], positive: str = "GALAXY",
                       negative: str = "STAR", family: str = "gbt", params: dict | None = None, label: str = "class",
                       k: int = 5, seed: int = 42, weight_col: str | None = None, id_col: str = "id",
                       early_stopping: bool = True, out: str = "p_binary",
                       with_metrics: bool = True) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """K-10: binary model on the pair's rows.  Pair rows get their OOF
    probability; rows outside the pair and test rows get the mean of the k
    fold models.  With ``early_stopping`` (K-05) a hash-chosen 12% of each
    fold's fit rows is the GBT validation set.  Returns (train probs, test
    probs, per-fold binary metrics; None unless ``with_metrics``, as the AUC
    ranks all scored rows)."""
    from prismtab.operators.metrics import binary_metrics, roc_auc

    pair = train.where(F.col(label).isin(positive, negative))
    vectoriser = fit_vectoriser(pair, features)
    base = prepare(pair, features, label, k, seed, None, weight_col, id_col, [negative, positive], vectoriser=vectoriser)
    others = vectoriser.transform(
        train.where(~F.col(label).isin(positive, negative))).select(id_col, FEATURES)
    tv = vectoriser.transform(test).select(
        id_col, FEATURES)
    def fit_one(f):
        fit = base.where(F.col("fold") != f)
        stages = make_estimator(family, dict(params or {}), weight_col, seed + f, len(features), 2)
        if early_stopping and family == "gbt":
            val = (F.abs(F.xxhash64(F.col(id_col), F.lit(f))) % 100) < 12
            fit = fit.withColumn("_val", val)
            stages[0].setValidationIndicatorCol("_val")
        return Pipeline(stages=stages).fit(fit)

    models = fit_folds(fit_one, k)
    pos = F.get(vector_to_array("probability"), 1)
    oofs = [m.transform(base.where(F.col("fold") == f)).select(id_col, label, "fold", pos.alias(out))
            for f, m in enumerate(models)]
    oof = oofs[0]
    for o in oofs[1:]:
        oof = oof.unionByName(o)
    # rows outside the pair and test rows: mean of the k fold models (no shuffle)
    rest = average_over_models(others, models, 1, id_col, [out], positive_only=True)
    test_out = average_over_models(tv, models, 1, id_col, [out], positive_only=True)
    train_out = oof.select(id_col, out).unionByName(rest)
    if not with_metrics:
        return train_out, test_out, None
    scored = oof.withColumn("_yb", (F.col(label) == positive).cast("int")).withColumn("fold", F.col("fold").cast("string"))
    metrics = binary_metrics(scored, "_yb", out, by=("fold",)).join(roc_auc(scored, "_yb", out, by=("fold",)), "fold")
    return train_out, test_out, metrics


# ---------------------------------------------------------------- K-11
def pairwise_blocks(base_probs: DataFrame, p_gs: DataFrame, p_gq: DataFrame, prob_cols: list[str],
                    alphas=(0.25, 0.5, 0.75), id_col: str = "id", classes=CLASSES) -> DataFrame:
    """K-11: from a base probability table and the G/S and G/Q pairwise
    probabilities: two reallocations (B-28), pair-margin scores (B-29) and
    one geometric blend per alpha (B-30)."""
    from prismtab.functions import proba as P

    j = base_probs.join(p_gs.withColumnRenamed("p_binary", "_gs"), id_col).join(
        p_gq.withColumnRenamed("p_binary", "_gq"), id_col)
    gi, qi, si = (classes.index(c) for c in ("GALAXY", "QSO", "STAR"))
    b = P.normalize(prob_cols)
    r_gs = P.reallocate_pair(b, F.col("_gs"), gi, si)
    r_gq = P.reallocate_pair(b, F.col("_gq"), gi, qi)
    pair = P.pair_margin_scores(F.col("_gs"), F.col("_gq"))
    cols = [id_col]
    cols += [x.alias(f"realloc_gs__{c}") for x, c in zip(r_gs, classes)]
    cols += [x.alias(f"realloc_gq__{c}") for x, c in zip(r_gq, classes)]
    for a in alphas:
        bl = P.blend(b, pair, a)
        cols += [x.alias(f"blend_{int(round(a * 100)):03d}__{c}") for x, c in zip(bl, classes)]
    return j.select(*cols)


# ---------------------------------------------------------------- K-12
def holdout_baseline(train: DataFrame, test: DataFrame, features: list[str], family: str = "rf",
                     params: dict | None = None, label: str = "class", seed: int = 42, id_col: str = "id"):
    """K-12: stratified 80/20 split (L-03), fit, evaluate on the holdout,
    refit on all train rows, predict test.  Returns (holdout metrics, test
    predictions id/class)."""
    from prismtab.functions.proba import argmax_class
    from prismtab.operators.folds import train_valid_split

    split = train_valid_split(train, label, 0.2, id_col, seed)
    asm = fit_vectoriser(train, features)
    lab = split.withColumn(LABEL, class_code(F.col(label)).cast("double"))
    # written once: both fits pass over it several times, and the split's ranks need a shuffle of all rows
    v = cut_lineage(asm.transform(lab).select(label, "is_valid", LABEL, FEATURES))
    stages = make_estimator(family, params, None, seed, len(features), len(CLASSES))
    m = Pipeline(stages=stages).fit(v.where(~F.col("is_valid")))
    hv = m.transform(v.where(F.col("is_valid")))
    names = [f"p__{c}" for c in CLASSES]
    hv = hv.select(label, *[c.alias(nm) for c, nm in zip(_proba_cols(hv, 3), names)])
    hv = hv.withColumn("_pred", argmax_class(names))
    from prismtab.operators.search import attach_scalars

    metrics = attach_scalars(prediction_metrics(hv, label, "_pred", absent="skip"), log_loss(hv, label, names))
    full = Pipeline(stages=make_estimator(family, params, None, seed, len(features), len(CLASSES))).fit(v)
    te = full.transform(asm.transform(test))
    te = te.select(id_col, *[c.alias(nm) for c, nm in zip(_proba_cols(te, 3), names)])
    return metrics, te.select(id_col, argmax_class(names).alias("class"))


# ---------------------------------------------------------------- I-06 / G-07
def hyperparameter_sweep(train: DataFrame, feature_sets: dict[str, list[str]], grid: list[dict],
                         label: str = "class", k: int = 3, seed: int = 42, id_col: str = "id") -> DataFrame:
    """I-06: family x feature set x variant, k-fold OOF each → ranked results
    (log loss, then accuracy).  ``grid`` items: {family, variant, params}."""
    spark = train.sparkSession
    rows = []
    for fs_name, feats in feature_sets.items():
        prepared = prepare(train, feats, label, k, seed, None, None, id_col)
        for g in grid:
            r = run_oof(train, None, feats, g["family"], g.get("params"), "sweep", label, k, seed, id_col=id_col,
                        prepared=prepared)
            s = r.scores.where(F.col("fold") == "overall").first()
            rows.append((g["family"], fs_name, g.get("variant", "default"), s["accuracy"], s["balanced_accuracy"],
                         s["log_loss"], float(sum(r.seconds))))
    res = spark.createDataFrame(rows, "model_type string, feature_set string, variant string, accuracy double, "
                                      "balanced_accuracy double, log_loss double, fit_seconds double")
    return res


def best_parameter(results: DataFrame, metric: str, ascending: bool, order_cols: list[str]) -> DataFrame:
    """G-07: the best row; strict improvement only, so the first row in grid
    order wins ties."""
    from prismtab.operators.search import order_cols as by

    order = by([(metric, "asc" if ascending else "desc"), *[(c, "asc") for c in order_cols]], results)
    return results.orderBy(*order).limit(1)


# ---------------------------------------------------------------- G-06
def select_diverse_models(scoreboard: DataFrame, corr: DataFrame, corr_threshold: float = 0.9995,
                          min_accuracy: float = 0.0, max_models: int = 0, manual_weights=None) -> DataFrame:
    """G-06: greedy selection in scoreboard order (weighted, balanced, plain
    accuracy, descending): drop non-positive manual weight, below minimum
    accuracy, correlation >= threshold with an already kept model, or beyond
    ``max_models``.  The scoreboard and correlation matrix are model-count
    sized tables (one row per model / model pair), read on the driver."""
    manual_weights = manual_weights or {}
    board = [r.asDict() for r in scoreboard.orderBy(F.desc("weighted_accuracy"), F.desc("balanced_accuracy"),
                                                   F.desc("accuracy"), F.asc("model")).collect()]
    cm = {(r["model_a"], r["model_b"]): r["corr"] for r in corr.collect()}
    kept, out = [], []
    for i, r in enumerate(board):
        name = r["model"]
        w = float(manual_weights.get(name, 1.0))
        reason = ""
        if w <= 0:
            reason = "manual_weight<=0"
        elif r["accuracy"] < min_accuracy:
            reason = "below_min_accuracy"
        else:
            close = next((k for k in kept if cm.get((name, k), 0.0) >= corr_threshold), None)
            if close is not None:
                reason = f"corr>={corr_threshold} with {close}"
            elif max_models > 0 and len(kept) >= max_models:
                reason = "max_models"
        if not reason:
            kept.append(name)
        out.append((i + 1, name, r["accuracy"], r["weighted_accuracy"], not reason, w, reason))
    return scoreboard.sparkSession.createDataFrame(
        out, "rank int, model string, accuracy double, weighted_accuracy double, selected boolean, "
             "feature_weight double, drop_reason string")
