"""Registered model-job queries (K-01..K-13, I-06, G-06, G-07).

Model outputs have no SQL oracle (the driver records a rows-only check);
their properties (probabilities sum to 1, every train row in exactly one
validation fold, better than the class prior on a planted signal) are
tested in ``tests/test_models.py``.  G-06 and G-07 are deterministic given
their inputs; G-07 has an oracle.

The model frame is ``obs`` with the evaluation features and a class planted on
two of them with noise (FIXTURES: the class of obs has nothing to do with its features by design).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from prismtab.constants import CLASSES
from prismtab.functions.features import astronomy_features

from prismtab.operators import metrics as M
from prismtab.plans import feature_search as FS
from prismtab.plans import oof as O
from prismtab.plans.catalog import register, rounded
from prismtab.plans.ensembles import run_ensembles
from prismtab.plans.common import MODELS, model_cols, with_views
from prismtab.sources.fixtures import load_obs, load_pro

BASE_FEATURES = ["u", "g", "r", "i", "z", "redshift", "u_minus_g", "g_minus_r", "r_minus_i", "i_minus_z", "mag_std"]
FEATURES = BASE_FEATURES + ["signal_q", "signal_s"]
K = 3
RF = {"numTrees": 20, "maxDepth": 5}
GBT = {"maxIter": 10, "maxDepth": 3}


def model_frames(spark, sf_dir):
    obs = astronomy_features(load_obs(spark, sf_dir))
    # the class follows from two features, for four rows in five; the others keep an unrelated one
    noise = F.pmod(F.xxhash64(F.lit("class"), F.col("id")), F.lit(5)) == 0
    planted = F.when(F.col("redshift") > 1.3, "QSO").when(F.col("u") - F.col("z") > 3.0, "STAR").otherwise("GALAXY")
    obs = obs.withColumns({
        "class": F.when(noise, F.col("class")).otherwise(planted),
        "signal_q": F.col("redshift") * 2.0,
        "signal_s": F.col("u") - F.col("z"),
    }).select("id", "class", "split", *FEATURES)
    train = obs.where(F.col("split") == "train").drop("split")
    test = obs.where(F.col("split") == "test").drop("split", "class")
    return train, test


def _oof_table(r: O.OOFResult, prefix: str):
    cols = [f"{prefix}__{c}" for c in CLASSES]
    tr = r.oof.select("id", F.lit("train").alias("split"), *cols)
    te = r.test.select("id", F.lit("test").alias("split"), *cols)
    return rounded(tr.unionByName(te))


# ---------------------------------------------------------------- K-01 / K-03 / A-08
@register("k01_oof_random_forest")
def q_oof_rf(spark, sf_dir):
    train, test = model_frames(spark, sf_dir)
    return _oof_table(O.run_oof(train, test, FEATURES, "rf", RF, "l1__rf", k=K), "l1__rf")


def _checked(table, names: list[str]):
    """What must hold of any probability table, by split: its rows, distinct ids, and rows whose probabilities do not add up to one."""
    off = F.abs(sum((F.col(n) for n in names[1:]), F.col(names[0])) - 1) > 1e-5
    return table.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"), F.sum(F.when(off | off.isNull(), 1).otherwise(0)).cast("bigint").alias("off"))


CHECKED_SQL = with_views() + """SELECT split, count(*) AS rows, count(DISTINCT id) AS ids, CAST(0 AS BIGINT) AS off FROM obs GROUP BY split"""


@register("k01_oof_checked", CHECKED_SQL)
def q_oof_checked(spark, sf_dir):
    return _checked(q_oof_rf(spark, sf_dir), [f"l1__rf__{c}" for c in CLASSES])


@register("k09_two_stage_checked", CHECKED_SQL)
def q_two_stage_checked(spark, sf_dir):
    return _checked(q_two_stage_clf(spark, sf_dir), [f"two_stage__{c}" for c in CLASSES])


@register("k11_pairwise_checked", CHECKED_SQL)
def q_pairwise_checked(spark, sf_dir):
    return _checked(q_pairwise(spark, sf_dir), [f"blend_050__{c}" for c in CLASSES])


# ---------------------------------------------------------------- K-02
SUITE_BLOCKS = ["l1__rf_planted", "l1__lr_planted", "l1__rf_base"]


@register("k02_suite_wide")
def q_suite_wide(spark, sf_dir):
    """The suite's wide probability tables of both splits."""
    train, test, _ = _suite(spark, sf_dir)
    cols = [f"{b}__{c}" for b in SUITE_BLOCKS for c in CLASSES]
    return rounded(train.select("id", F.lit("train").alias("split"), *cols).unionByName(test.select("id", F.lit("test").alias("split"), *cols)))


@register("k02_experiment_suite")
def q_suite(spark, sf_dir):
    return rounded(_suite(spark, sf_dir)[2])


def _suite(spark, sf_dir):
    train, test = model_frames(spark, sf_dir)
    exps = [{"name": "rf_planted", "family": "rf", "features": FEATURES, "params": RF},
            {"name": "lr_planted", "family": "lr", "features": FEATURES, "params": {"maxIter": 100}},
            {"name": "rf_base", "family": "rf", "features": BASE_FEATURES, "params": RF}]
    return O.run_suite(train, test, exps, k=K)


# ---------------------------------------------------------------- K-02 ensembles
STRATEGIES = {"equal": {}, "less_m1": {"m1": 0.55, "m2": 1.35, "m3": 1.25}, "m2_alone": {"m1": 0.0, "m3": 0.0}}


def _ensemble_sql() -> str:
    def mean(weights: dict, c: str) -> str:
        w = {m: float(weights.get(m, 1.0)) for m in MODELS}
        return "(" + " + ".join(f"{m}__{c} * {x!r}e0" for m, x in w.items()) + f") / {sum(w.values())!r}e0"

    raw = ", ".join(f"{mean(w, c)} AS r__{n}__{c}" for n, w in STRATEGIES.items() for c in CLASSES)
    normed = ", ".join(f"r__{n}__{c} / (" + " + ".join(f"r__{n}__{k}" for k in CLASSES) + f") AS ens__{n}__{c}" for n in STRATEGIES for c in CLASSES)
    return f"en AS (SELECT id, class, split, {normed} FROM (SELECT id, class, split, {raw} FROM pro))"


def _ensemble_board_sql() -> str:
    import json

    boards = []
    for n, w in STRATEGIES.items():
        p = {c: f"ens__{n}__{c}" for c in CLASSES}
        best = f"CASE WHEN {p['GALAXY']} >= {p['QSO']} AND {p['GALAXY']} >= {p['STAR']} THEN 'GALAXY' WHEN {p['QSO']} >= {p['STAR']} THEN 'QSO' ELSE 'STAR' END"
        own = "CASE class " + " ".join(f"WHEN '{c}' THEN {p[c]}" for c in CLASSES) + " END"
        text = json.dumps({m: float(w.get(m, 1.0)) for m in MODELS}, sort_keys=True)
        boards.append(f"""SELECT '{n}' AS strategy, round(avg(CASE WHEN pred = class THEN 1e0 ELSE 0e0 END), 6) AS accuracy,
  round((SELECT avg(r) FROM (SELECT avg(CASE WHEN {best} = class THEN 1e0 ELSE 0e0 END) AS r FROM en WHERE split = 'train' GROUP BY class)), 6) AS balanced_accuracy,
  round(avg(-ln(least(greatest(own, 1e-15), 1e0 - 1e-15))), 6) AS log_loss, '{text}' AS weights
FROM (SELECT class, {best} AS pred, {own} AS own FROM en WHERE split = 'train')""")
    return with_views(_ensemble_sql()) + "\nUNION ALL\n".join(boards)


def _ensembles(spark, sf_dir):
    pro = load_pro(spark, sf_dir)
    blocks = {m: model_cols(m) for m in MODELS}
    return run_ensembles(pro.where("split = 'train'"), pro.where("split = 'test'"), blocks, STRATEGIES)


@register("k02_ensemble_scores", _ensemble_board_sql())
def q_ensemble_scores(spark, sf_dir):
    return rounded(_ensembles(spark, sf_dir)[2])


@register("k02_ensemble_tables", with_views(_ensemble_sql()) + "SELECT id, split, " + ", ".join(
    f"round(ens__{n}__{c}, 6) AS ens__{n}__{c}" for n in STRATEGIES for c in CLASSES) + " FROM en")
def q_ensemble_tables(spark, sf_dir):
    """Blended probabilities of both splits under all strategies."""
    train, test, _ = _ensembles(spark, sf_dir)
    return rounded(train.drop("class").withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test"))))


# ---------------------------------------------------------------- K-04
@register("k04_mlp_oof")
def q_mlp(spark, sf_dir):
    train, test = model_frames(spark, sf_dir)
    train = train.withColumn("w", F.when(F.col("class") == "STAR", 1.5).otherwise(1.0))
    r = O.run_oof(train, test, FEATURES, "mlp", {"hidden": [8], "maxIter": 60}, "l1__mlp", k=K, weight_col="w")
    return _oof_table(r, "l1__mlp")


# ---------------------------------------------------------------- K-06 / K-07
def _stack_features(spark, sf_dir):
    """B-26 logit features of the three synthetic models, both splits."""
    from prismtab.functions.proba import logit_features

    pro = load_pro(spark, sf_dir)
    feats = logit_features(pro, {m: model_cols(m) for m in MODELS}, eps=1e-5, keep=("id", "class", "split"))
    names = [c for c in feats.columns if c not in ("id", "class", "split")]
    return feats, names


@register("k06_lr_stacker")
def q_lr_stacker(spark, sf_dir):
    feats, names = _stack_features(spark, sf_dir)
    train = feats.where(F.col("split") == "train").drop("split")
    test = feats.where(F.col("split") == "test").drop("split", "class")
    best_c, r, scores = O.lr_stacker(train, test, names, c_values=(0.1, 1.0), k=K)
    return rounded(scores.withColumn("selected", F.col("C") == best_c))


@register("k07_stacker_from_stored_features")
def q_stacker_stored(spark, sf_dir):
    """K-07: re-run the stacker from a stored stack-feature table (keyed by
    id), here written once to the checkpoint folder and read back."""
    from prismtab.session import cut_lineage

    feats, names = _stack_features(spark, sf_dir)
    stored = cut_lineage(feats)
    train = stored.where(F.col("split") == "train").drop("split")
    test = stored.where(F.col("split") == "test").drop("split", "class")
    best_c, r, _ = O.lr_stacker(train, test, names, c_values=(0.3,), k=K)
    return _oof_table(r, "lr_logits")


# ---------------------------------------------------------------- K-08
@register("k08_level2_stacker")
def q_level2(spark, sf_dir):
    feats, names = _stack_features(spark, sf_dir)
    train = feats.where(F.col("split") == "train").drop("split")
    test = feats.where(F.col("split") == "test").drop("split", "class")
    return _oof_table(O.run_oof(train, test, names, "gbt", GBT, "level2", k=K), "level2")


# ---------------------------------------------------------------- K-09
@register("k09_two_stage_classifier")
def q_two_stage_clf(spark, sf_dir):
    train, test = model_frames(spark, sf_dir)
    return _oof_table(O.two_stage_classifier(train, test, FEATURES, "gbt", GBT, k=K), "two_stage")


# ---------------------------------------------------------------- K-10 / K-05
@register("k10_local_binary_model")
def q_local_binary(spark, sf_dir):
    train, test = model_frames(spark, sf_dir)
    tr, te, _ = O.local_binary_model(train, test, FEATURES, "GALAXY", "STAR", "gbt", GBT, k=K, with_metrics=False)
    return rounded(tr.withColumn("split", F.lit("train")).unionByName(te.withColumn("split", F.lit("test"))))


@register("k10_local_binary_metrics")
def q_local_binary_metrics(spark, sf_dir):
    train, test = model_frames(spark, sf_dir)
    _, _, met = O.local_binary_model(train, test, FEATURES, "GALAXY", "STAR", "gbt", GBT, k=K)
    return rounded(met)


# ---------------------------------------------------------------- K-05
STOPPING = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.5}
PATIENCE = 3


def _stopped(spark, sf_dir):
    train, test = model_frames(spark, sf_dir)
    return O.run_oof(train, test, FEATURES, "gbt", STOPPING, "l1__stopped", k=K, patience=PATIENCE)


@register("k05_early_stopping")
def q_early_stopping(spark, sf_dir):
    """Out-of-fold probabilities of boosted models for three classes that end at one common round per fold."""
    return _oof_table(_stopped(spark, sf_dir), "l1__stopped")


@register("k05_early_stopping_checked", CHECKED_SQL)
def q_early_stopping_checked(spark, sf_dir):
    return _checked(q_early_stopping(spark, sf_dir), [f"l1__stopped__{c}" for c in CLASSES])


@register("k05_stopping_curve")
def q_stopping_curve(spark, sf_dir):
    """Validation log loss after each round of each fold, and the round that the fold's models end at."""
    rows = [(f, t, loss, t == m.rounds) for f, m in enumerate(_stopped(spark, sf_dir).stopped) for t, loss in enumerate(m.losses, 1)]
    return rounded(spark.createDataFrame(rows, "fold int, round int, log_loss double, chosen boolean"))


# ---------------------------------------------------------------- K-11
@register("k11_pairwise_blocks")
def q_pairwise(spark, sf_dir):
    train, test = model_frames(spark, sf_dir)
    gs_tr, gs_te, _ = O.local_binary_model(train, test, FEATURES, "GALAXY", "STAR", "rf", RF, k=K, early_stopping=False, with_metrics=False)
    gq_tr, gq_te, _ = O.local_binary_model(train, test, FEATURES, "GALAXY", "QSO", "rf", RF, k=K, early_stopping=False, with_metrics=False)
    base = load_pro(spark, sf_dir).select("id", "split", *model_cols("m1"))
    both = [
        O.pairwise_blocks(base.where(F.col("split") == name).drop("split"), gs, gq, model_cols("m1")).withColumn("split", F.lit(name))
        for name, gs, gq in (("train", gs_tr, gq_tr), ("test", gs_te, gq_te))
    ]
    return rounded(both[0].unionByName(both[1]))


# ---------------------------------------------------------------- K-12
@register("k12_holdout_metrics")
def q_holdout_metrics(spark, sf_dir):
    train, test = model_frames(spark, sf_dir)
    return rounded(O.holdout_baseline(train, test, FEATURES, "rf", RF)[0])


@register("k12_holdout_baseline")
def q_holdout(spark, sf_dir):
    train, test = model_frames(spark, sf_dir)
    _, pred = O.holdout_baseline(train, test, FEATURES, "rf", RF)
    return pred


# ---------------------------------------------------------------- K-13
SEARCHED = ["u", "g", "r", "i", "z", "redshift", "alpha", "delta"]
SEARCH_CATS = ["spectral_type", "galaxy_population"]


def search_frame(spark, sf_dir):
    """Training rows whose class follows from two columns in part."""
    obs = load_obs(spark, sf_dir).where(F.col("split") == "train").drop("split")
    planted = F.when(F.col("redshift") > 1.3, "QSO").when(F.col("u") - F.col("z") > 3.0, "STAR").otherwise(F.col("class"))
    return obs.withColumn("class", planted)


def _screen_sql() -> str:
    from prismtab.plans import q_groupkeys as Q

    keys = FS.candidate_keys(SEARCHED, SEARCH_CATS)
    names = ("GALAXY", "QSO", "STAR")

    def expr(spec: str) -> str:
        kind, _, rest = spec.partition("__")
        column, _, p = rest.rpartition("__")
        if kind == "round":
            return f"CAST(round_even(coalesce({column}, -999999e0), {p}) + 0e0 AS FLOAT)"
        if kind == "digit":
            return f"CASE WHEN {column} IS NULL THEN -1 ELSE floor(round(abs({column}) * 1e{p}, 6)) % 10 END"
        if kind == "qbin":
            e = f"e_{column}_{p}"
            return f"CASE WHEN {column} IS NULL THEN -1 ELSE len(list_filter({e}, lambda v: v > list_min({e}) AND v < {column})) END"
        return f"coalesce({spec}, '__NA__')"

    edges = ", ".join(Q._edges_sql(c, q) for c in SEARCHED for q in FS.BINS)
    specs = sorted({s for k in keys for s in k})
    counts = ", ".join(f"sum(CASE WHEN fold = {f} AND class = '{c}' THEN 1 ELSE 0 END) AS n{f}{c}" for f in range(K) for c in names)

    def others(f: int, c: str) -> str:
        return "(" + " + ".join(f"n{g}{c}" for g in range(K) if g != f) + ")"

    def right(f: int) -> str:
        best = "greatest(" + ", ".join(others(f, c) for c in names) + ")"
        most = f"CASE m{f} WHEN 'GALAXY' THEN n{f}GALAXY WHEN 'QSO' THEN n{f}QSO ELSE n{f}STAR END"
        return f"CASE WHEN {best} = 0 THEN {most} WHEN {others(f, 'GALAXY')} = {best} THEN n{f}GALAXY WHEN {others(f, 'QSO')} = {best} THEN n{f}QSO ELSE n{f}STAR END"

    majority = ", ".join(f"(SELECT class FROM fr WHERE fold <> {f} GROUP BY class ORDER BY count(*) DESC, class LIMIT 1) AS m{f}" for f in range(K))
    rows = "\nUNION ALL\n".join(
        f"""SELECT '{"|".join(k)}' AS candidate, {len(k)} AS degree, count(*) AS n_values, CAST(sum({" + ".join(right(f) for f in range(K))}) AS BIGINT) AS ok
FROM (SELECT {", ".join(f'"{s}"' for s in k)}, {counts} FROM made GROUP BY ALL) CROSS JOIN mj""" for k in keys)
    return with_views(
        """sf AS (SELECT * EXCLUDE (class), CASE WHEN redshift > 1.3 THEN 'QSO' WHEN u - z > 3e0 THEN 'STAR' ELSE class END AS class FROM obs WHERE split = 'train')""",
        f"""fr AS (SELECT *, (row_number() OVER (PARTITION BY class ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) - 1) % {K} AS fold FROM sf)""",
        f"ed AS (SELECT {edges} FROM sf)",
        "made AS (SELECT fold, class, " + ", ".join(f'{expr(s)} AS "{s}"' for s in specs) + " FROM fr CROSS JOIN ed)",
        f"mj AS (SELECT {majority})",
        "base AS (SELECT count(*) AS n, " + " + ".join(f"count(*) FILTER (fold = {f} AND class = m{f})" for f in range(K)) + " AS ok0 FROM fr CROSS JOIN mj)",
        f"found AS ({rows})",
    ) + """SELECT candidate, degree, n_values, round(ok / n, 6) AS accuracy, round((ok - ok0) / n, 6) AS gain, (ok - ok0) / n > 1e-5 AS survives
FROM found CROSS JOIN base"""


@register("k13_feature_screen", _screen_sql())
def q_feature_screen(spark, sf_dir):
    """Gains of all generated columns and crosses."""
    return rounded(FS.screen(search_frame(spark, sf_dir), FS.candidate_keys(SEARCHED, SEARCH_CATS), k=K))


@register("k13_feature_search")
def q_feature_search(spark, sf_dir):
    """Forward search; the screen leaves only some candidates to be fitted."""
    train = search_frame(spark, sf_dir)
    _, trace = FS.feature_search(train, ["g", "r", "i"], FS.candidate_keys(["redshift", "u"], SEARCH_CATS, (0, 1), (0,), (5,)), "lr", {"maxIter": 40}, k=K, refits=4)
    return rounded(trace)


# ---------------------------------------------------------------- I-06
@register("i06_hyperparameter_sweep")
def q_sweep(spark, sf_dir):
    train, _ = model_frames(spark, sf_dir)
    grid = [{"family": "rf", "variant": "shallow", "params": {"numTrees": 10, "maxDepth": 3}},
            {"family": "rf", "variant": "deep", "params": {"numTrees": 20, "maxDepth": 6}},
            {"family": "lr", "variant": "default", "params": {"maxIter": 60}}]
    res = O.hyperparameter_sweep(train, {"planted": FEATURES, "base": BASE_FEATURES}, grid, k=K)
    return rounded(res.drop("fit_seconds"))


# ---------------------------------------------------------------- G-06
def _g06_sql() -> str:
    """The greedy choice as a recursion over the board's ranks: a model goes if a kept one correlates with it."""
    from prismtab.plans.q_metrics import LONG_PRED_SQL, W_SQL

    flat = " UNION ALL ".join("SELECT " + ", ".join(f"{m}__{c} AS {m}" for m in MODELS) + " FROM pro WHERE split = 'train'" for c in CLASSES)
    cor = " UNION ALL ".join(f"SELECT '{a}|{b}' AS pair, corr({a}, {b}) AS c FROM flat" for a in MODELS for b in MODELS if a != b)
    return with_views(
        LONG_PRED_SQL,
        "rec AS (SELECT model, class, avg(CASE WHEN pred = class THEN 1e0 ELSE 0e0 END) AS r FROM lp WHERE split = 'train' GROUP BY ALL)",
        "bal AS (SELECT model, avg(r) AS ba FROM rec GROUP BY model)",
        f"""acc AS (SELECT model, avg(CASE WHEN pred = class THEN 1e0 ELSE 0e0 END) AS a,
          sum(CASE WHEN pred = class THEN {W_SQL} ELSE 0e0 END) / sum({W_SQL}) AS wa FROM lp WHERE split = 'train' GROUP BY model)""",
        "board AS (SELECT CAST(row_number() OVER (ORDER BY wa DESC, ba DESC, a DESC, model) AS INT) AS rank, model, a, wa FROM acc JOIN bal USING (model))",
        f"flat AS ({flat})", f"cor AS ({cor})", "cm AS (SELECT map(list(pair), list(c)) AS m FROM cor)",
        """pick(rank, kept, close) AS (SELECT 0, CAST([] AS VARCHAR[]), CAST(NULL AS VARCHAR)
          UNION ALL SELECT rank, CASE WHEN close IS NULL THEN list_append(kept, model) ELSE kept END, close FROM (
            SELECT b.rank, p.kept, b.model, list_filter(p.kept, lambda k: cm.m[b.model || '|' || k] >= 0.9)[1] AS close
            FROM pick p JOIN board b ON b.rank = p.rank + 1 CROSS JOIN cm))""",
    ).replace("WITH ", "WITH RECURSIVE ", 1) + """SELECT board.rank, model, round(a, 6) AS accuracy, round(wa, 6) AS weighted_accuracy, close IS NULL AS selected,
  1e0 AS feature_weight, coalesce('corr>=0.9 with ' || close, '') AS drop_reason FROM board JOIN pick USING (rank)"""


@register("g06_diverse_model_selection", _g06_sql())
def q_model_selection(spark, sf_dir):
    pro = load_pro(spark, sf_dir).where(F.col("split") == "train")
    blocks = {m: model_cols(m) for m in MODELS}
    board = M.scoreboard(pro, "class", blocks)
    corr = M.probability_correlation(pro, blocks)
    return rounded(O.select_diverse_models(board, corr, corr_threshold=0.9, manual_weights={"m3": 1.0}))


# ---------------------------------------------------------------- G-07
def _g07_sql() -> str:
    from prismtab.plans import q_search as Q

    views = with_views(Q.X_SQL, Q._vals("qg", Q.QT), Q._vals("sg", Q.ST), Q._vals("rg", Q.RT), Q.Y_SQL, Q.RES_SQL)
    return views + """SELECT qt AS qso_threshold, st AS star_threshold, rt AS replace_threshold, round(ba, 6) AS balanced_accuracy
FROM res ORDER BY round(ba, 12) DESC, qt, st, rt LIMIT 1"""


@register("g07_best_parameter", _g07_sql())
def q_best_parameter(spark, sf_dir):
    from prismtab.plans.q_search import threshold_results

    best = O.best_parameter(threshold_results(spark, sf_dir), "balanced_accuracy", False, ["qso_threshold", "star_threshold", "replace_threshold"])
    return rounded(best.select("qso_threshold", "star_threshold", "replace_threshold", "balanced_accuracy"))
