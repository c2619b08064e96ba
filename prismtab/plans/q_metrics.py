"""Registered metric queries (E rows) over the stand-in views."""

from __future__ import annotations

from pyspark.sql import functions as F

from prismtab.constants import CLASSES
from prismtab.operators import metrics as M
from prismtab.plans.catalog import register, rounded
from prismtab.plans.common import (
    EVAL_SQL,
    MASK_JOIN_SQL,
    MODELS,
    PREDS_SQL,
    SLICES_SQL,
    WEIGHT_SQL,
    argmax_sql,
    eval_frame,
    model_cols,
    predictions,
    slice_masks,
    with_views,
)
from prismtab.sources.fixtures import load_pro


def slice_metrics_frame(spark, sf_dir):
    """Flagship: evaluation features → argmax of three models → join on id →
    metrics of every candidate over the 32-slice lattice."""
    feats = eval_frame(spark, sf_dir, "train")
    preds = predictions(spark, sf_dir, "train").drop("class", "split")
    joined = feats.join(preds, "id", "inner")
    cands = {m: f"pred_{m}" for m in MODELS}
    return M.slice_metrics(joined, "class", cands, slice_masks(joined), absent="skip")


LONG_SQL = """long AS (
  SELECT e.*, c.candidate,
    CASE c.candidate WHEN 'm1' THEN p.pred_m1 WHEN 'm2' THEN p.pred_m2 ELSE p.pred_m3 END AS pred
  FROM evf e JOIN preds p USING (id)
  CROSS JOIN (VALUES ('m1'), ('m2'), ('m3')) c(candidate)
  WHERE e.split = 'train'
)"""

SLICE_METRICS_SQL = with_views(PREDS_SQL, EVAL_SQL, SLICES_SQL, LONG_SQL, f"""per_truth AS (
  SELECT e.candidate, s.slice, e.class, count(*) AS sup,
    sum(CASE WHEN e.pred = e.class THEN 1 ELSE 0 END) AS tp, any_value({WEIGHT_SQL.format(c='e.class')}) AS w
  FROM long e JOIN slices s ON {MASK_JOIN_SQL}
  GROUP BY e.candidate, s.slice, e.class
), agg AS (
  SELECT candidate, slice, sum(sup) AS n, sum(tp) AS ok, avg(tp / sup) AS bal,
    sum(w * sup) AS wn, sum(w * tp) AS wok
  FROM per_truth GROUP BY candidate, slice
), grid AS (
  SELECT c.candidate, s.slice FROM slices s CROSS JOIN (VALUES ('m1'), ('m2'), ('m3')) c(candidate)
)""") + """
SELECT g.candidate, g.slice, CAST(coalesce(a.n, 0) AS BIGINT) AS n,
  round(a.ok / a.n, 6) AS accuracy, round(a.bal, 6) AS balanced_accuracy,
  round(a.wok / a.wn, 6) AS weighted_accuracy, CAST(coalesce(a.n - a.ok, 0) AS BIGINT) AS errors,
  round(coalesce(a.wn - a.wok, 0e0), 6) AS weighted_errors
FROM grid g LEFT JOIN agg a USING (candidate, slice)
"""


@register("e11_slice_metrics", SLICE_METRICS_SQL)
def q_slice_metrics(spark, sf_dir):
    return rounded(slice_metrics_frame(spark, sf_dir))


# ------------------------------------------------------------------ helpers
def long_predictions(spark, sf_dir, split="train"):
    """(model, id, class, pred, p_GALAXY, p_QSO, p_STAR) — one Expand of pro."""
    from prismtab.functions.proba import argmax_class

    pro = load_pro(spark, sf_dir)
    if split is not None:
        pro = pro.where(F.col("split") == split)
    arr = F.array(
        *[
            F.struct(
                F.lit(m).alias("model"),
                argmax_class(model_cols(m)).alias("pred"),
                *[F.col(c).alias(f"p_{k}") for c, k in zip(model_cols(m), CLASSES)],
            )
            for m in MODELS
        ]
    )
    return pro.select("id", "class", "split", F.inline(arr))


LONG_PRED_SQL = "lp AS (\n" + "\nUNION ALL\n".join(
    f"  SELECT '{m}' AS model, id, class, split, {argmax_sql(m)} AS pred, "
    f"{m}__GALAXY AS p_GALAXY, {m}__QSO AS p_QSO, {m}__STAR AS p_STAR FROM pro"
    for m in MODELS
) + "\n)"

W_SQL = WEIGHT_SQL.format(c="class")


# ---------------------------------------------------------------- E-01
@register("e01_confusion_matrix", with_views(LONG_PRED_SQL, """grid AS (
  SELECT m.model, t.c AS true_class, p.c AS pred_class
  FROM (VALUES ('m1'), ('m2'), ('m3')) m(model), (VALUES ('GALAXY'), ('QSO'), ('STAR')) t(c),
       (VALUES ('GALAXY'), ('QSO'), ('STAR')) p(c)
), cnt AS (
  SELECT model, class AS true_class, pred AS pred_class, count(*) AS n FROM lp WHERE split = 'train' GROUP BY ALL
)""") + """SELECT g.model, g.true_class, g.pred_class, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM grid g LEFT JOIN cnt c USING (model, true_class, pred_class)""")
def q_confusion(spark, sf_dir):
    lp = long_predictions(spark, sf_dir, "train")
    return M.confusion(lp, "class", "pred", by=("model",))


# ---------------------------------------------------------------- E-02
_FLOW_SQL = ",\n  ".join(
    f"CAST(sum(CASE WHEN class = '{a}' AND pred = '{b}' THEN 1 ELSE 0 END) AS BIGINT) AS {n}"
    for a, b, n in M.FLOW_NAMES
)


def _metrics_sql(group: str, bal: str) -> str:
    return with_views(LONG_PRED_SQL, f"""rec AS (
  SELECT {group}, class, avg(CASE WHEN pred = class THEN 1e0 ELSE 0e0 END) AS recall
  FROM lp WHERE split = 'train' GROUP BY ALL
), bal AS (SELECT {group}, {bal} AS balanced_accuracy FROM rec GROUP BY ALL)""") + f"""SELECT {group},
  count(*) AS n,
  round(avg(CASE WHEN pred = class THEN 1e0 ELSE 0e0 END), 6) AS accuracy,
  round(any_value(b.balanced_accuracy), 6) AS balanced_accuracy,
  round(sum(CASE WHEN pred = class THEN {W_SQL} ELSE 0e0 END) / sum({W_SQL}), 6) AS weighted_accuracy,
  CAST(sum(CASE WHEN pred <> class THEN 1 ELSE 0 END) AS BIGINT) AS errors,
  {_FLOW_SQL},
  CAST(sum(CASE WHEN (class = 'STAR' AND pred = 'GALAXY') OR (class = 'GALAXY' AND pred = 'STAR') THEN 1 ELSE 0 END)
       AS BIGINT) AS star_galaxy_swaps
FROM lp JOIN bal b USING ({group}) WHERE split = 'train' GROUP BY {group}"""


@register("e02_metrics_from_confusion", _metrics_sql("model", "sum(recall) / 3e0"))
def q_metrics_from_confusion(spark, sf_dir):
    lp = long_predictions(spark, sf_dir, "train")
    cells = M.confusion(lp, "class", "pred", by=("model",))
    return rounded(M.metrics_from_cells(cells, by=("model",), absent="zero"))


# ---------------------------------------------------------------- E-03
@register("e03_prediction_metrics", _metrics_sql("model", "avg(recall)"))
def q_prediction_metrics(spark, sf_dir):
    lp = long_predictions(spark, sf_dir, "train")
    return rounded(M.prediction_metrics(lp, "class", "pred", by=("model",), absent="skip"))


# ---------------------------------------------------------------- E-04
_PC_SQL = ",\n  ".join(
    f"""round(coalesce(sum(CASE WHEN class = '{c}' AND pred = '{c}' THEN 1 ELSE 0 END)
        / nullif(sum(CASE WHEN class = '{c}' THEN 1 ELSE 0 END), 0), 0e0), 6) AS recall_{c},
  round(coalesce(sum(CASE WHEN class = '{c}' AND pred = '{c}' THEN 1 ELSE 0 END)
        / nullif(sum(CASE WHEN pred = '{c}' THEN 1 ELSE 0 END), 0), 0e0), 6) AS precision_{c},
  CAST(sum(CASE WHEN pred = '{c}' THEN 1 ELSE 0 END) AS BIGINT) AS pred_count_{c},
  CAST(sum(CASE WHEN class = '{c}' AND pred <> '{c}' THEN 1 ELSE 0 END) AS BIGINT) AS fn_{c},
  CAST(sum(CASE WHEN class <> '{c}' AND pred = '{c}' THEN 1 ELSE 0 END) AS BIGINT) AS fp_{c}"""
    for c in CLASSES
)


@register("e04_per_class_metrics",
          with_views(LONG_PRED_SQL) + f"SELECT model,\n  {_PC_SQL}\nFROM lp WHERE split = 'train' GROUP BY model")
def q_per_class(spark, sf_dir):
    lp = long_predictions(spark, sf_dir, "train")
    return rounded(M.per_class_metrics(lp, "class", "pred", by=("model",)))


# ---------------------------------------------------------------- E-05
@register("e05_log_loss", with_views(LONG_PRED_SQL) + """SELECT model, round(avg(-ln(least(greatest(
    CASE class WHEN 'GALAXY' THEN p_GALAXY WHEN 'QSO' THEN p_QSO ELSE p_STAR END / (p_GALAXY + p_QSO + p_STAR),
    1e-15), 1e0 - 1e-15))), 6) AS log_loss
FROM lp WHERE split = 'train' GROUP BY model""")
def q_log_loss(spark, sf_dir):
    lp = long_predictions(spark, sf_dir, "train")
    return rounded(M.log_loss(lp, "class", ["p_GALAXY", "p_QSO", "p_STAR"], by=("model",)))


# ---------------------------------------------------------------- E-06 / E-27
def _binary_frame(spark, sf_dir):
    """GALAXY-vs-STAR rows: label 1 for GALAXY, score = p_G / (p_G + p_S)."""
    lp = long_predictions(spark, sf_dir, "train").where(F.col("class").isin("GALAXY", "STAR"))
    return lp.select(
        "model",
        (F.col("class") == "GALAXY").cast("int").alias("y"),
        (F.col("p_GALAXY") / (F.col("p_GALAXY") + F.col("p_STAR"))).alias("score"),
    )


BIN_SQL = """bin AS (
  SELECT model, CASE WHEN class = 'GALAXY' THEN 1 ELSE 0 END AS y, p_GALAXY / (p_GALAXY + p_STAR) AS score
  FROM lp WHERE split = 'train' AND class IN ('GALAXY', 'STAR')
)"""


@register("e06_binary_metrics", with_views(LONG_PRED_SQL, BIN_SQL) + """SELECT model, count(*) AS n,
  round(avg(-(y * ln(least(greatest(score, 1e-15), 1e0 - 1e-15))
            + (1 - y) * ln(1e0 - least(greatest(score, 1e-15), 1e0 - 1e-15)))), 6) AS log_loss,
  round(avg(CASE WHEN (score >= 0.5) = (y = 1) THEN 1e0 ELSE 0e0 END), 6) AS accuracy_at_050,
  round(avg(y * 1e0), 6) AS positive_rate
FROM bin GROUP BY model""")
def q_binary(spark, sf_dir):
    return rounded(M.binary_metrics(_binary_frame(spark, sf_dir), "y", "score", by=("model",)))


@register("e27_roc_auc", with_views(LONG_PRED_SQL, BIN_SQL, """rk AS (
  SELECT model, y, rank() OVER (PARTITION BY model ORDER BY score)
      + (count(*) OVER (PARTITION BY model, score) - 1) / 2e0 AS r
  FROM bin
)""") + """SELECT model, round((sum(CASE WHEN y = 1 THEN r ELSE 0e0 END) - sum(y) * (sum(y) + 1) / 2e0)
    / (sum(y) * sum(1 - y)), 6) AS roc_auc
FROM rk GROUP BY model""")
def q_auc(spark, sf_dir):
    return rounded(M.roc_auc(_binary_frame(spark, sf_dir), "y", "score", by=("model",)))


# ---------------------------------------------------------------- E-10
@register("e10_slice_error_flows", with_views(PREDS_SQL, EVAL_SQL, SLICES_SQL, LONG_SQL) + f"""SELECT e.candidate,
  s.slice, e.class AS true_class, e.pred AS pred_class, count(*) AS n,
  CAST(sum(CASE WHEN e.class <> e.pred THEN 1 ELSE 0 END) AS BIGINT) AS errors,
  round(sum({WEIGHT_SQL.format(c='e.class')}), 6) AS weighted_n,
  round(sum(CASE WHEN e.class <> e.pred THEN {WEIGHT_SQL.format(c='e.class')} ELSE 0e0 END), 6) AS weighted_errors
FROM long e JOIN slices s ON {MASK_JOIN_SQL}
GROUP BY e.candidate, s.slice, e.class, e.pred""")
def q_slice_flows(spark, sf_dir):
    feats = eval_frame(spark, sf_dir, "train")
    preds = predictions(spark, sf_dir, "train").drop("class", "split")
    joined = feats.join(preds, "id", "inner")
    cands = {m: f"pred_{m}" for m in MODELS}
    return rounded(M.slice_error_flows(joined, "class", cands, slice_masks(joined)))


# ---------------------------------------------------------------- E-17
@register("e17_class_distribution", with_views(LONG_PRED_SQL, """grid AS (
  SELECT m.model, c.class FROM (VALUES ('m1'), ('m2'), ('m3')) m(model), (VALUES ('GALAXY'), ('QSO'), ('STAR')) c(class)
), cnt AS (SELECT model, pred AS class, count(*) AS n FROM lp WHERE split = 'test' GROUP BY ALL),
tot AS (SELECT model, sum(n) AS t FROM cnt GROUP BY model)""") + """SELECT g.model, g.class,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n, round(coalesce(c.n, 0) / t.t, 6) AS rate
FROM grid g LEFT JOIN cnt c USING (model, class) JOIN tot t USING (model)""")
def q_class_distribution(spark, sf_dir):
    lp = long_predictions(spark, sf_dir, "test")
    return rounded(M.class_distribution(lp, "pred", by=("model",)))


# ---------------------------------------------------------------- E-18
@register("e18_slice_disagreement", with_views(PREDS_SQL, EVAL_SQL, SLICES_SQL, """pairs AS (
  SELECT * FROM (VALUES ('m2', 'm1'), ('m3', 'm1')) t(candidate, reference)
), d AS (
  SELECT p.candidate, p.reference, e.*,
    CASE WHEN (CASE p.candidate WHEN 'm2' THEN q.pred_m2 ELSE q.pred_m3 END) <> q.pred_m1 THEN 1 ELSE 0 END AS ne
  FROM evf e JOIN preds q USING (id) CROSS JOIN pairs p WHERE e.split = 'test'
), agg AS (
  SELECT e.candidate, e.reference, s.slice, count(*) AS n, sum(ne) AS dis
  FROM d e JOIN slices s ON """ + MASK_JOIN_SQL.replace("e.", "e.") + """ GROUP BY ALL
)""") + """SELECT p.candidate, p.reference, s.slice, CAST(coalesce(a.n, 0) AS BIGINT) AS n,
  CAST(coalesce(a.dis, 0) AS BIGINT) AS disagreements, round(a.dis / a.n, 6) AS disagreement_rate,
  round(1e0 - a.dis / a.n, 6) AS agreement_rate
FROM pairs p CROSS JOIN slices s LEFT JOIN agg a USING (candidate, reference, slice)""")
def q_slice_disagreement(spark, sf_dir):
    feats = eval_frame(spark, sf_dir, "test")
    preds = predictions(spark, sf_dir, "test").drop("class", "split")
    joined = feats.join(preds, "id", "inner")
    pairs = {("m2", "m1"): ("pred_m2", "pred_m1"), ("m3", "m1"): ("pred_m3", "pred_m1")}
    return rounded(M.slice_disagreement(joined, pairs, slice_masks(joined)))


# ---------------------------------------------------------------- E-19
@register("e19_reference_crosstab", with_views(PREDS_SQL, """grid AS (
  SELECT r.c AS reference_class, k.c AS candidate_class
  FROM (VALUES ('GALAXY'), ('QSO'), ('STAR')) r(c), (VALUES ('GALAXY'), ('QSO'), ('STAR')) k(c)
), cnt AS (SELECT pred_m1 AS reference_class, pred_m2 AS candidate_class, count(*) AS n
  FROM preds WHERE split = 'test' GROUP BY ALL)""") + """SELECT g.reference_class, g.candidate_class,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM grid g LEFT JOIN cnt c USING (reference_class, candidate_class)""")
def q_crosstab(spark, sf_dir):
    p = predictions(spark, sf_dir, "test")
    return M.crosstab(p, "pred_m1", "pred_m2")


# ---------------------------------------------------------------- E-20
def _corr_sql() -> str:
    flat = "\nUNION ALL\n".join(
        f"SELECT id, '{c}' AS k, " + ", ".join(f"{m}__{c} AS {m}" for m in MODELS) + " FROM pro WHERE split = 'train'"
        for c in CLASSES
    )
    rows = []
    for a in MODELS:
        for b in MODELS:
            src = "" if a == b else " FROM flat"
            v = "1e0" if a == b else f"corr({a}, {b})"
            rows.append(f"SELECT '{a}' AS model_a, '{b}' AS model_b, round({v}, 6) AS corr{src}")
    return with_views(f"flat AS (\n{flat}\n)") + "\nUNION ALL\n".join(rows)


@register("e20_probability_correlation", _corr_sql())
def q_corr(spark, sf_dir):
    pro = load_pro(spark, sf_dir).where(F.col("split") == "train")
    return rounded(M.probability_correlation(pro, {m: model_cols(m) for m in MODELS}))


# ---------------------------------------------------------------- E-21
def _agree_sql() -> str:
    rows = []
    for a in MODELS:
        for b in MODELS:
            if a == b:
                rows.append(f"SELECT '{a}' AS model_a, '{b}' AS model_b, 1e0 AS agreement")
                continue
            v = f"avg(CASE WHEN pred_{a} = pred_{b} THEN 1e0 ELSE 0e0 END)"
            rows.append(f"SELECT '{a}' AS model_a, '{b}' AS model_b, round({v}, 6) AS agreement "
                        "FROM preds WHERE split = 'train'")
    return with_views(PREDS_SQL) + "\nUNION ALL\n".join(rows)


@register("e21_prediction_agreement", _agree_sql())
def q_agree(spark, sf_dir):
    p = predictions(spark, sf_dir, "train")
    return rounded(M.prediction_agreement(p, {m: f"pred_{m}" for m in MODELS}))


# ---------------------------------------------------------------- E-20 / E-21 for many models
MANY = 200


def _blend(i: int) -> tuple[int, int, int]:
    """Integer weights of the three base models in the i-th blend."""
    return 1 + i % 7, i % 11, (i * 3) % 13


#: correlations of blends follow from the covariances of the three models they are made of
MANY_SQL = with_views("""flat AS (SELECT unnest([m1__GALAXY, m1__QSO, m1__STAR]) AS x, unnest([m2__GALAXY, m2__QSO, m2__STAR]) AS y,
    unnest([m3__GALAXY, m3__QSO, m3__STAR]) AS z FROM pro WHERE split = 'train')""",
    """cv AS (SELECT covar_pop(x, x) AS xx, covar_pop(y, y) AS yy, covar_pop(z, z) AS zz, covar_pop(x, y) AS xy, covar_pop(x, z) AS xz, covar_pop(y, z) AS yz FROM flat)""",
    f"w AS (SELECT i, (1e0 + i % 7) / t AS a, (i % 11) / t AS b, ((i * 3) % 13) / t AS c FROM (SELECT range AS i, (1e0 + range % 7 + range % 11 + (range * 3) % 13) AS t FROM range({MANY})))",
    """vr AS (SELECT w.*, sqrt(a * a * xx + b * b * yy + c * c * zz + 2 * (a * b * xy + a * c * xz + b * c * yz)) AS sd FROM w CROSS JOIN cv)""",
) + """SELECT 'b' || p.i AS model_a, 'b' || q.i AS model_b, round((p.a * q.a * xx + p.b * q.b * yy + p.c * q.c * zz + (p.a * q.b + p.b * q.a) * xy
  + (p.a * q.c + p.c * q.a) * xz + (p.b * q.c + p.c * q.b) * yz) / (p.sd * q.sd), 6) AS corr FROM vr p CROSS JOIN vr q CROSS JOIN cv"""


@register("e20_correlation_of_200_models", MANY_SQL)
def q_corr_many(spark, sf_dir):
    """All pairs of 200 blends of the three base models."""
    pro = load_pro(spark, sf_dir).where(F.col("split") == "train")
    cols = {}
    for i in range(MANY):
        w = _blend(i)
        for c in CLASSES:
            cols[f"b{i}__{c}"] = sum(F.col(f"{m}__{c}") * float(x) for m, x in zip(MODELS, w)) / float(sum(w))
    wide = pro.select(*[v.alias(n) for n, v in cols.items()])
    return rounded(M.probability_correlation(wide, {f"b{i}": [f"b{i}__{c}" for c in CLASSES] for i in range(MANY)}))


# ---------------------------------------------------------------- E-22
@register("e22_model_scoreboard", with_views(LONG_PRED_SQL, """rec AS (
  SELECT model, class, avg(CASE WHEN pred = class THEN 1e0 ELSE 0e0 END) AS recall
  FROM lp WHERE split = 'train' GROUP BY ALL
), bal AS (SELECT model, avg(recall) AS b FROM rec GROUP BY model)""") + f"""SELECT model, count(*) AS n,
  round(avg(CASE WHEN pred = class THEN 1e0 ELSE 0e0 END), 6) AS accuracy,
  round(any_value(bal.b), 6) AS balanced_accuracy,
  round(sum(CASE WHEN pred = class THEN {W_SQL} ELSE 0e0 END) / sum({W_SQL}), 6) AS weighted_accuracy,
  round(avg(-ln(least(greatest(CASE class WHEN 'GALAXY' THEN p_GALAXY WHEN 'QSO' THEN p_QSO ELSE p_STAR END
      / (p_GALAXY + p_QSO + p_STAR), 1e-15), 1e0 - 1e-15))), 6) AS log_loss
FROM lp JOIN bal USING (model) WHERE split = 'train' GROUP BY model""")
def q_scoreboard(spark, sf_dir):
    pro = load_pro(spark, sf_dir).where(F.col("split") == "train")
    return rounded(M.scoreboard(pro, "class", {m: model_cols(m) for m in MODELS}))


# ---------------------------------------------------------------- E-28
@register("e28_hard_slice_metrics", with_views(LONG_PRED_SQL, EVAL_SQL, """h AS (
  SELECT l.* FROM lp l JOIN evf e USING (id)
  WHERE l.split = 'train' AND abs(e.redshift) <= 0.144 AND e.galaxy_population = 'Blue_Cloud'
    AND e.rms <= 1.30 AND e.mag_std <= 0.75 AND NOT e.wide
), rec AS (SELECT model, class, avg(CASE WHEN pred = class THEN 1e0 ELSE 0e0 END) AS r FROM h GROUP BY ALL),
bal AS (SELECT model, avg(r) AS b FROM rec GROUP BY model)""") + f"""SELECT model, count(*) AS n,
  round(avg(CASE WHEN pred = class THEN 1e0 ELSE 0e0 END), 6) AS accuracy,
  round(any_value(bal.b), 6) AS balanced_accuracy,
  round(sum(CASE WHEN pred = class THEN {W_SQL} ELSE 0e0 END) / sum({W_SQL}), 6) AS weighted_accuracy,
  round(avg(-ln(least(greatest(CASE class WHEN 'GALAXY' THEN p_GALAXY WHEN 'QSO' THEN p_QSO ELSE p_STAR END
      / (p_GALAXY + p_QSO + p_STAR), 1e-15), 1e0 - 1e-15))), 6) AS log_loss
FROM h JOIN bal USING (model) GROUP BY model""")
def q_hard_slice_metrics(spark, sf_dir):
    from prismtab.functions.features import astronomy_features, hard_slice_features
    from prismtab.sources.fixtures import load_obs

    from prismtab.session import cut_lineage

    obs = hard_slice_features(astronomy_features(load_obs(spark, sf_dir)))
    # materialise the compact (id, flag) table: a filter on the derived flag
    # would otherwise be pushed down and re-expand the feature expressions
    flags = cut_lineage(obs.select("id", "hard_slice_main"))
    hard = flags.where(F.col("hard_slice_main") == 1).select("id")
    pro = load_pro(spark, sf_dir).where(F.col("split") == "train").join(hard, "id", "left_semi")
    return rounded(M.scoreboard(pro, "class", {m: model_cols(m) for m in MODELS}))
